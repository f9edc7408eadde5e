"""Top and bottom entities per statistic, leading groups, and the best group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from statloom.functions.numeric import round2
from statloom.operators.profile import group_means
from statloom.operators.schema import quoted, unpivot_stats

BUCKETS = 64


def rank_label(position: Column) -> Column:
    """1st, 2nd, 3rd, 4th, ..."""
    ending = (
        F.when((position % 100).between(11, 13), "th")
        .when(position % 10 == 1, "st")
        .when(position % 10 == 2, "nd")
        .when(position % 10 == 3, "rd")
        .otherwise("th")
    )
    return F.concat(position.cast("string"), ending)


def _limits(rows: list[Row], i: int, n: int) -> tuple[float | None, float | None]:
    """Value that at least ``n`` rows reach from above, and from below, for statistic ``i``.

    Each bucket's best is one row, so the n-th best of the buckets is reached by n rows at least.
    """
    best = sorted((r[f"hi{i}"] for r in rows if r[f"hi{i}"] is not None), reverse=True)
    least = sorted(r[f"lo{i}"] for r in rows if r[f"lo{i}"] is not None)
    return (
        best[n - 1] if len(best) >= n else None,
        least[n - 1] if len(least) >= n else None,
    )


def top_bottom_n(
    df: DataFrame, entity: str, group: str, stats: list[str], n: int = 3, tie: list[str] | None = None
) -> DataFrame:
    """The ``n`` highest and lowest entities of every statistic, in one long table.

    Columns: ``stat, direction, rank, entity, group, value``. Lowest ranks leave out values of 0
    and below unless the statistic is 0 everywhere. Ties go by ``tie`` (default: the entity).

    A first pass keeps the extremes of a fixed number of row buckets: at most ``BUCKETS`` rows
    come back and bound each statistic. The second pass ranks only rows within the bounds.
    """
    tie = tie or [entity]
    ids = list(dict.fromkeys([entity, group, *tie]))
    data = df.select(
        *[quoted(c) for c in ids], *[quoted(s).cast("double").alias(s) for s in stats]
    )
    extremes = []
    for i, s in enumerate(stats):
        v = quoted(s)
        extremes += [
            F.max(v).alias(f"hi{i}"),
            F.min(F.when(v > 0, v)).alias(f"lo{i}"),
            F.bool_and(v == 0).alias(f"zero{i}"),
        ]
    bucket = F.pmod(F.xxhash64(*[quoted(c) for c in ids]), F.lit(BUCKETS))
    rows = data.groupBy(bucket.alias("bucket")).agg(*extremes).collect()

    entries = []
    for i, s in enumerate(stats):
        v = quoted(s)
        high, low = _limits(rows, i, n)
        all_zero = bool(rows) and all(r[f"zero{i}"] in (True, None) for r in rows)
        in_top = v.isNotNull() if high is None else v >= F.lit(high)
        in_bottom = v > 0 if low is None else (v > 0) & (v <= F.lit(low))
        if all_zero:
            in_bottom = v.isNotNull()
        for direction, inside in (("Highest", in_top), ("Lowest", in_bottom)):
            entry = F.struct(
                F.lit(s).alias("stat"), F.lit(direction).alias("direction"), v.alias("value")
            )
            entries.append(F.when(inside, entry))
    # a row outside all bounds has no entry and yields nothing
    held = F.array_compact(F.array(*entries))
    cells = data.select(*[quoted(c) for c in ids], F.inline(held))

    # one signed order serves both directions
    signed = F.when(F.col("direction") == "Highest", -F.col("value")).otherwise(F.col("value"))
    spec = Window.partitionBy("stat", "direction").orderBy("__sign", *[quoted(t) for t in tie])
    ranked = cells.withColumn("__sign", signed).withColumn("__pos", F.row_number().over(spec))
    return ranked.filter(F.col("__pos") <= n).select(
        "stat",
        "direction",
        rank_label(F.col("__pos")).alias("rank"),
        quoted(entity).alias("entity"),
        quoted(group).alias("group"),
        "value",
    )


def top_k(df: DataFrame, value: str, k: int, tie: list[str], descending: bool = True) -> DataFrame:
    """The first ``k`` rows by one value; every task keeps only its own ``k``."""
    first = quoted(value).desc_nulls_last() if descending else quoted(value).asc_nulls_last()
    return df.orderBy(first, *[quoted(t) for t in tie]).limit(k)


def leader_per_stat(df: DataFrame, group: str, stats: list[str]) -> DataFrame:
    """The group with the highest mean of each statistic: ``stat, group, mean``.

    The unrounded means compete; equal means go to the first group in ascending order.
    """
    means = unpivot_stats(group_means(df, group, stats), [group], stats)
    spec = Window.partitionBy("stat").orderBy(F.desc_nulls_last("value"), quoted(group))
    best = means.withColumn("__pos", F.row_number().over(spec)).filter("__pos = 1")
    return best.select("stat", quoted(group).alias("group"), round2(F.col("value")).alias("mean"))


def leader_wins(leaders: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """How many statistics each group leads, without the excluded ones: ``group, wins``."""
    left_out = list(excluded)
    counted = leaders.filter(~F.col("stat").isin(left_out)) if left_out else leaders
    return counted.groupBy("group").agg(F.count(F.lit(1)).alias("wins"))


def best_group(wins: DataFrame) -> DataFrame:
    """The group with most wins, its wins and the number of statistics: ``group, wins, of``."""
    first = F.min(F.struct((-F.col("wins")).alias("minus"), F.col("group")))
    top = wins.agg(first.alias("first"), F.sum("wins").cast("bigint").alias("of"))
    return top.filter("first IS NOT NULL").select(
        F.col("first.group").alias("group"), (-F.col("first.minus")).alias("wins"), "of"
    )
