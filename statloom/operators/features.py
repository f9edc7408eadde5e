"""Feature preparation: imputation, logs and weights, standardising, split, one-hot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.numeric import log_positive, to_number
from statloom.operators.median import (
    IN_MEMORY_VALUES,
    fits_in_memory,
    narrowed_medians,
    wide_medians,
)
from statloom.operators.schema import quoted, type_of
from statloom.storage import join_bounded, materialize


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: to_number(quoted(c), type_of(df, c)) for c in columns})


def impute_median(
    df: DataFrame,
    columns: list[str],
    group: str | None = None,
    in_memory: int = IN_MEMORY_VALUES,
    **limits,
) -> DataFrame:
    """Fill missing numbers by the column median, overall or per group; 0 without any value.

    The input is read for its size, its medians and the result, so it is written once.
    """
    data = materialize(_numbers(df, columns), "impute")
    if group is None:
        known = _overall_medians(data, columns, in_memory, **limits)
        return data.withColumns(
            {c: F.coalesce(quoted(c), F.lit(float(known[c] or 0.0))) for c in columns}
        )
    held = data.select(quoted(group), *[quoted(c) for c in columns])
    if fits_in_memory(held.count(), len(columns), in_memory):
        medians = held.groupBy(quoted(group)).agg(
            *[F.median(quoted(c)).alias(c) for c in columns]
        )
    else:
        medians = wide_medians(held, [group], columns, **limits)
    named = medians.select(
        quoted(group), *[quoted(c).alias(f"__median_{c}") for c in columns]
    )
    joined = join_bounded(data, named, [group], "left", sketched=True)
    filled = {
        c: F.coalesce(quoted(c), quoted(f"__median_{c}"), F.lit(0.0)) for c in columns
    }
    return joined.withColumns(filled).drop(*[f"__median_{c}" for c in columns])


def _overall_medians(
    data: DataFrame, columns: list[str], in_memory: int, **limits
) -> dict[str, float | None]:
    """One number per column."""
    if fits_in_memory(data.count(), len(columns), in_memory):
        row = data.agg(*[F.median(quoted(c)).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns}
    found = narrowed_medians(data, [], columns, **limits).collect()
    medians = {r["stat"]: r["median"] for r in found}
    return {c: medians.get(c) for c in columns}


def log_weighted(df: DataFrame, columns: list[str], weights: Mapping[str, float]) -> DataFrame:
    """log(1 + max(x, 0)), times the weight of the column where it has one."""
    return df.withColumns(
        {c: log_positive(quoted(c)) * F.lit(float(weights.get(c, 1.0))) for c in columns}
    )


def key_weights(
    keys: list[str], key_weight: float = 2.0, minutes: str = "Minutes", age: str = "Age"
) -> dict[str, float]:
    """Key attributes count double, minutes 1.5 times, age half (on top)."""
    weights = {c: key_weight for c in keys}
    weights[minutes] = weights.get(minutes, 1.0) * 1.5
    weights[age] = weights.get(age, 1.0) * 0.5
    return weights


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean 0 and population deviation 1; a column without spread becomes 0.

    One pass measures the columns (two numbers each come to the driver), the next scales them.
    """
    measures = []
    for i, c in enumerate(columns):
        measures += [F.avg(quoted(c)).alias(f"m{i}"), F.stddev_pop(quoted(c)).alias(f"s{i}")]
    row = df.agg(*measures).first()
    scaled = {}
    for i, c in enumerate(columns):
        mean, spread = row[f"m{i}"], row[f"s{i}"]
        if mean is None:
            continue
        centred = quoted(c) - F.lit(float(mean))
        scaled[c] = centred / F.lit(float(spread)) if spread else centred * F.lit(0.0)
    return df.withColumns(scaled)


def in_training(key: Column, seed: int = 42, tenths: int = 8) -> Column:
    """Stable split by a digest of the key: the same row always falls on the same side."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10 < tenths


def split_train_test(
    df: DataFrame, key: str, seed: int = 42, min_rows: int = 6
) -> tuple[DataFrame, DataFrame]:
    """80/20 split; below ``min_rows`` rows both parts are the whole table."""
    if df.limit(min_rows).count() < min_rows:
        return df, df
    chosen = in_training(quoted(key), seed)
    return df.filter(chosen), df.filter(~chosen)


#: Distinct values that a column may have to be coded one by one.
MOST_VALUES = 1_000


def known_values(df: DataFrame, column: str, most: int = MOST_VALUES) -> list[str]:
    """The distinct values of a column in order; more than ``most`` are an error."""
    found = df.select(quoted(column)).distinct().dropna().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(r[0] for r in found)


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """One 0/1 column per known value; a row with another value has zeros only."""
    hot = {
        f"{column}={v}": F.coalesce((quoted(column) == F.lit(v)).cast("int"), F.lit(0))
        for v in values
    }
    return df.withColumns(hot)
