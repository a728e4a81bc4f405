"""Column functions. Each returns a ``Column`` and stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Everything str.strip() removes: Unicode white space and the four separators.
_BLANK = r"[\s\x1c-\x1f]"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def sentinel_to_null(column: Column | str, sentinel) -> Column:
    """Null where the column holds the value that stands for "unknown"."""
    return F.nullif(_col(column), F.lit(sentinel))


def nan_to_null(column: Column | str) -> Column:
    """Null where the column is NaN; other values, and null, stay."""
    value = _col(column)
    return F.when(~F.isnan(value), value)


def decode_utf8(column: Column | str) -> Column:
    """Bytes to text; bytes that are not UTF-8 raise."""
    return F.decode(_col(column), "UTF-8")


def strip_blank(column: Column | str) -> Column:
    """Text without leading and trailing white space of any kind, not only spaces."""
    return F.regexp_replace(_col(column), f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def split_fields(column: Column | str) -> Column:
    """Fields of a tab-separated line, after stripping it."""
    return F.split(strip_blank(column), "\t")


def optional_field(fields: Column, index: int) -> Column:
    """The field at a position, null when the line is shorter."""
    return F.get(fields, F.lit(index))


def required_field(fields: Column, index: int) -> Column:
    """The field at a position; a shorter line raises, whatever the ANSI setting."""
    missing = F.raise_error(
        F.concat(F.lit(f"no field {index + 1} in line: "), F.array_join(fields, "\t"))
    )
    return F.when(F.size(fields) > index, F.get(fields, F.lit(index))).otherwise(
        missing.cast("string")
    )


def round_degrees(column: Column | str, digits: int = 0) -> Column:
    """Coordinate rounded half away from zero, computed in double."""
    return F.round(_col(column).cast("double"), digits)


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null where the denominator is zero."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def range_bucket(column: Column | str, start: int, end: int, step: int) -> Column:
    """Lower edge of the range that holds the value, null for values outside all ranges."""
    value = _col(column).cast("int")
    edge = F.floor((value - start) / step).cast("int") * step + start
    return F.when((value >= start) & (value < end), edge)


def word_length(column: Column | str) -> Column:
    return F.char_length(_col(column))


def band_edges(mean: Column | str, std: Column | str, n: Column | str, z: float = 1.96):
    """(lower, upper) of mean ± z·std/√n.

    The lower edge is held within [0, 1], the upper is not. Both are null when
    an input is null or NaN.
    """
    mean, std = _col(mean).cast("double"), _col(std).cast("double")
    count = _col(n).cast("double")
    half = z * safe_div(std, F.sqrt(count))
    known = ~F.isnan(mean) & ~F.isnan(std) & half.isNotNull() & mean.isNotNull()
    lower = F.greatest(F.least(mean - half, F.lit(1.0)), F.lit(0.0))
    return F.when(known, lower), F.when(known, mean + half)


def opacity(scaled: Column | str, slope: float = 0.7, floor: float = 0.3) -> Column:
    """Linear rescale of a 0..1 share; a missing share gets the floor."""
    return F.coalesce(_col(scaled) * slope + floor, F.lit(floor))
