"""Long-format series and bands for plots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cantogram.functions.fixed_values import CONFIDENCE_Z, OPACITY_FLOOR, OPACITY_SLOPE
from cantogram.functions.scalars import band_edges, opacity
from cantogram.operators.aggregates import scale_by_max
from cantogram.operators.filters import drop_null_rows


@dataclass(frozen=True)
class Series:
    """One plotted feature: its label, the columns it reads, and its unit."""

    label: str
    value: str
    raw_value: str
    std: str | None
    unit: str


TREND_SERIES = (
    Series("Tempo", "norm_tempo", "avg_tempo", "norm_std_tempo", "BPM"),
    Series("Loudness", "norm_loudness", "avg_loudness", "norm_std_loudness", "dB"),
    Series("Duration", "norm_duration", "avg_duration", "norm_std_duration", "sec"),
    Series("Hotttnesss", "norm_hotttnesss", "avg_hotttnesss", "norm_std_hotttnesss", ""),
    Series("% Major Key", "pct_major", "pct_major", "std_mode", "pct"),
)

FINGERPRINT_SERIES = (
    Series("Tempo", "norm_tempo", "avg_tempo", None, "BPM"),
    Series("Loudness", "norm_loudness", "avg_loudness", None, "dB"),
    Series("Duration", "norm_duration", "avg_duration", None, "sec"),
    Series("Hotttnesss", "norm_hotttnesss", "avg_hotttnesss", None, ""),
    Series("% Major", "norm_pct_major", "norm_pct_major", None, "%"),
)


def feature_series(
    df: DataFrame, ids: Sequence[str], series: Sequence[Series] = TREND_SERIES
) -> DataFrame:
    """Wide to long: one row per id and feature, numbered in the order given."""
    rows = []
    for position, s in enumerate(series):
        std = F.col(s.std) if s.std else F.lit(None)
        rows.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(s.label).alias("feature"),
                F.col(s.value).cast("double").alias("value"),
                F.col(s.raw_value).cast("double").alias("raw_value"),
                std.cast("double").alias("std"),
                F.lit(s.unit).alias("unit"),
            )
        )
    return df.select(*ids, "track_count", F.inline(F.array(*rows)))


def confidence_band(
    df: DataFrame,
    mean: str = "value",
    std: str = "std",
    n: str = "track_count",
    z: float = CONFIDENCE_Z,
) -> DataFrame:
    """Rows with all three inputs, with ``lower`` and ``upper`` edges."""
    lower, upper = band_edges(mean, std, n, z)
    return (
        drop_null_rows(df, [mean, std, n]).withColumn("lower", lower).withColumn("upper", upper)
    )


def rescale(
    df: DataFrame,
    column: str,
    slope: float = OPACITY_SLOPE,
    floor: float = OPACITY_FLOOR,
    scaled: str = "norm_total",
    name: str = "opacity",
) -> DataFrame:
    """A column's share of its maximum, and that share on a scale that starts at ``floor``."""
    return scale_by_max(df, column, scaled).withColumn(name, opacity(scaled, slope, floor))
