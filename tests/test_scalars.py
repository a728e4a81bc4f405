import math

import pytest
from pyspark.sql import functions as F

from cantogram.functions import scalars as S
from cantogram.functions.fixed_values import COUNTRY_CODES, STOP_WORDS

NAN = float("nan")


def one(spark, values, kind, column):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(column).collect()]


def test_sentinel_is_null_and_null_stays(spark):
    assert one(spark, [0, 1999, None], "int", S.sentinel_to_null("v", 0)) == [None, 1999, None]


def test_nan_is_null_for_both_float_widths(spark):
    for kind in ("float", "double"):
        assert one(spark, [NAN, 0.5, None, 0.0], kind, S.nan_to_null("v")) == [
            None, 0.5, None, 0.0
        ]


def test_rounding_is_half_away_from_zero_without_negative_zero(spark):
    got = one(spark, [2.5, -2.5, -0.4, 0.5, None], "double", S.round_degrees("v"))
    assert got == [3.0, -3.0, 0.0, 1.0, None]
    assert math.copysign(1, got[2]) == 1
    assert one(spark, [12.345], "double", S.round_degrees("v", 1)) == [12.3]


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(6, 3), (1, 0), (None, 2)], "a long, b long")
    assert [r[0] for r in df.select(S.safe_div("a", "b")).collect()] == [2.0, None, None]


def test_year_ranges(spark):
    years = [0, 1919, 1920, 1987, 2029, 2030, None]
    bucket = S.range_bucket("v", 1920, 2030, 10)
    assert one(spark, years, "short", bucket) == [None, None, 1920, 1980, 2020, None, None]


def test_strip_takes_all_white_space_and_splits_on_tabs(spark):
    lines = ["  a\tb\t \r", " a\tb\tc ", "\x1ca\tb", "a b\tc"]
    got = one(spark, lines, "string", S.split_fields("v"))
    assert got == [line.strip().split("\t") for line in lines]


def test_optional_and_required_fields(spark):
    df = spark.createDataFrame([(["a", "b"],)], "f array<string>")
    assert df.select(S.optional_field(F.col("f"), 2)).first()[0] is None
    assert df.select(S.required_field(F.col("f"), 1)).first()[0] == "b"
    with pytest.raises(Exception, match="no field 3 in line"):
        df.select(S.required_field(F.col("f"), 2)).collect()


def test_decoding_is_strict(spark):
    good = spark.createDataFrame([(bytearray("né".encode()),)], "v binary")
    assert good.select(S.decode_utf8("v")).first()[0] == "né"
    bad = spark.createDataFrame([(bytearray(b"\xff\xfe"),)], "v binary")
    with pytest.raises(Exception):
        bad.select(S.decode_utf8("v")).collect()


def test_word_length_counts_characters(spark):
    assert one(spark, ["né", "", None], "string", S.word_length("v")) == [2, 0, None]


def test_band_clips_only_the_lower_edge(spark):
    df = spark.createDataFrame(
        [(0.5, 0.2, 4), (0.01, 0.5, 4), (0.99, 0.5, 4), (3.0, 0.1, 4), (0.5, None, 4),
         (NAN, 0.1, 4), (None, 0.1, 4), (0.5, 0.1, None)],
        "m double, s double, n long",
    )
    lower, upper = S.band_edges("m", "s", "n")
    got = [tuple(r) for r in df.select(lower, upper).collect()]
    for (low, high), (m, s) in zip(got, [(0.5, 0.2), (0.01, 0.5), (0.99, 0.5), (3.0, 0.1)]):
        assert low == pytest.approx(min(max(m - 1.96 * s / 2, 0), 1))
        assert high == pytest.approx(m + 1.96 * s / 2)
    assert got[1][0] == 0.0 and got[2][1] > 1 and got[3][0] == 1.0
    assert got[4:] == [(None, None)] * 4


def test_opacity_has_a_floor(spark):
    assert one(spark, [1.0, 0.0, None], "double", S.opacity("v")) == [1.0, 0.3, 0.3]


def test_fixed_values_are_whole():
    codes = [line.split(",")[0] for line in COUNTRY_CODES.splitlines()]
    assert len(codes) == len(set(codes)) == 197 and "NA" in codes
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 71
