"""Numeric parsing, filling, rounding and scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number texts. A plain cast would also take Java forms such as `5d` or `0x1p3`.
NUMBER_TEXT = r"(?i)^\s*[-+]?((\d+\.?\d*|\.\d+)(e[-+]?\d+)?|inf(inity)?)\s*$"
GROUPED_NUMBER = r"^[-+]?\d[\d,]*(\.\d*)?([eE]-?\d+)?$"


def round2(value: Column) -> Column:
    """Two decimals the way NumPy rounds: scale, round half to even, scale back."""
    return F.rint(value * F.lit(100.0)) / F.lit(100.0)


def parse_number(text: Column) -> Column:
    """Text to double; anything that is not a number, NaN included, becomes NULL."""
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def drop_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_number(column: Column, data_type: str) -> Column:
    """Coerce a column of any simple type to a nullable double without NaN."""
    if data_type == "string":
        return parse_number(column)
    if data_type in ("double", "float"):
        return drop_nan(column.cast("double"))
    return column.cast("double")


def to_whole(value: Column, strict: bool = False) -> Column:
    """Double to nullable long. A fractional value is NULL, or an error when ``strict``."""
    inside = (F.abs(value) < F.lit(float(2**63))) & (value == F.floor(value))
    whole = F.when(inside, value.try_cast("bigint"))
    if strict:
        fault = F.raise_error(F.concat(F.lit("not a whole number: "), value.cast("string")))
        whole = F.when(value.isNull() | inside, whole).otherwise(fault.cast("bigint"))
    return whole


def strip_thousands(text: Column) -> Column:
    """Drop the grouping commas of cells that are numbers; leave every other text alone."""
    return F.when(text.rlike(GROUPED_NUMBER), F.regexp_replace(text, ",", "")).otherwise(text)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(float(low)))
    if high is not None:
        bounded = F.least(bounded, F.lit(float(high)))
    return F.when(value.isNotNull(), bounded)


def log_positive(value: Column) -> Column:
    """log(1 + x) of the non-negative part."""
    return F.log1p(clip(value, low=0.0))


def in_millions(value: Column) -> Column:
    return round2(value / F.lit(1_000_000.0))


def mean_of(column: Column) -> Column:
    """Mean as sum / count: exact for decimal input whatever the partitioning."""
    return F.sum(column).cast("double") / F.count(column)
