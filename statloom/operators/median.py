"""Exact medians whose state stays bounded however large a group is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.operators.schema import quoted, unpivot_stats
from statloom.storage import join_bounded, materialize

#: Distinct values one task may hold for one aggregation row (all its statistics together).
IN_MEMORY_VALUES = 4_000_000
#: Distinct values of one group and statistic that one task may sort.
SORTED_VALUES = 1_000_000
#: First bracket around the middle of the rows, and the accuracy of the sketch behind it.
BRACKET, ACCURACY = 0.01, 2_000
#: Pieces per later round.
PIECES = 16


def fits_in_memory(rows: int, n_stats: int, limit: int = IN_MEMORY_VALUES) -> bool:
    """Whether the built-in median (a value-count map per statistic) is safe for ``rows`` rows."""
    return rows * n_stats <= limit


def narrowed_medians(
    df: DataFrame, groups: list[str], stats: list[str], sorted_values: int = SORTED_VALUES
) -> DataFrame:
    """Median per group and statistic as ``groups, stat, median``, for groups of any size.

    A sketch brackets the middle of each group; one pass counts exactly what lies below and
    collects the distinct values inside with their counts, so about two percent of the values are
    shuffled. The counts prove that the bracket holds the middle ranks; should one not, all values
    are taken. While a group keeps too many distinct values for one task, further rounds cut them
    at approximate quantiles, count the pieces exactly and keep those with the middle ranks.
    """
    keys = [*groups, "stat"]
    by = [quoted(k) for k in keys]
    values = unpivot_stats(df, groups, stats).filter("value IS NOT NULL")

    shares = F.array(F.lit(0.5 - BRACKET), F.lit(0.5 + BRACKET))
    cuts = values.groupBy(*by).agg(F.percentile_approx("value", shares, ACCURACY).alias("cuts"))
    bracketed = join_bounded(values, cuts, keys, sketched=True)
    side = F.when(F.col("value") < F.col("cuts")[0], -1).when(F.col("value") > F.col("cuts")[1], 1)
    inside = F.when(side.isNull(), F.col("value"))
    counts = bracketed.groupBy(*by, side.alias("side"), inside.alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = materialize(counts, "counts")
    total, below = F.sum("n"), F.coalesce(F.sum(F.when(F.col("side") == -1, F.col("n"))), F.lit(0))
    held = F.sum(F.when(F.col("side").isNull(), F.col("n")))
    ranks = counts.groupBy(*by).agg(
        (F.floor((total + 1) / 2) - below).cast("bigint").alias("low"),
        (F.floor(total / 2) + 1 - below).cast("bigint").alias("high"),
        held.alias("held"),
    )
    ranks = materialize(ranks, "ranks")
    cells = counts.filter("side IS NULL").select(*by, "value", "n")
    if not ranks.filter("low < 1 OR high > held OR held IS NULL").isEmpty():
        cells, ranks = _all_cells(values, keys)
    ranks = ranks.select(*by, "low", "high")

    limit, accuracy = max(sorted_values, PIECES), ACCURACY
    largest = _largest(cells, keys)
    while largest > limit:
        cells, ranks = _narrow(cells, ranks, keys, accuracy)
        # a sketch as long as the group is exact, so raising it ends any slow progress
        before, largest = largest, _largest(cells, keys)
        accuracy = accuracy * 10 if largest > before / 2 else accuracy

    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("value"))
    ranked = join_bounded(cells.withColumn("upto", upto), ranks, keys)

    def at(rank: str) -> Column:
        reached = (F.col("upto") >= F.col(rank)) & (F.col("upto") - F.col("n") < F.col(rank))
        return F.max(F.when(reached, F.col("value")))

    return ranked.groupBy(*by).agg(((at("low") + at("high")) / 2).alias("median"))


def _all_cells(values: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    by = [quoted(k) for k in keys]
    cells = materialize(values.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n")), "cells")
    n = F.sum("n")
    ranks = cells.groupBy(*by).agg(
        F.floor((n + 1) / 2).cast("bigint").alias("low"),
        (F.floor(n / 2) + 1).cast("bigint").alias("high"),
    )
    return cells, materialize(ranks, "ranks")


def _largest(cells: DataFrame, keys: list[str]) -> int:
    sizes = cells.groupBy(*[quoted(k) for k in keys]).count()
    return sizes.agg(F.max("count")).first()[0] or 0


def _narrow(
    cells: DataFrame, ranks: DataFrame, keys: list[str], accuracy: int
) -> tuple[DataFrame, DataFrame]:
    by = [quoted(k) for k in keys]
    shares = F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)])
    cuts = cells.groupBy(*by).agg(F.percentile_approx("value", shares, accuracy).alias("cuts"))
    above = [(F.col("value") > F.col("cuts")[i]).cast("int") for i in range(PIECES - 1)]
    piece = reduce(lambda a, b: a + b, above)
    split = join_bounded(cells, cuts, keys, sketched=True).withColumn("piece", piece).drop("cuts")

    counts = split.groupBy(*by, "piece").agg(F.sum("n").alias("held"))
    upto = F.sum("held").over(Window.partitionBy(*by).orderBy("piece"))
    counts = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("held"))
    ends = (
        join_bounded(counts, ranks, keys)
        .filter("(before < low AND upto >= low) OR (before < high AND upto >= high)")
        .groupBy(*by)
        .agg(
            F.min("piece").alias("first"),
            F.max("piece").alias("last"),
            (F.max("low") - F.min("before")).alias("low"),
            (F.max("high") - F.min("before")).alias("high"),
        )
    )
    ends = materialize(ends, "ends")
    kept = join_bounded(split, ends.select(*by, "first", "last"), keys, sketched=True)
    kept = kept.filter("piece BETWEEN first AND last").select(*by, "value", "n")
    return materialize(kept, "cells"), ends.select(*by, "low", "high")


def wide_medians(df: DataFrame, groups: list[str], stats: list[str], **limits) -> DataFrame:
    """``narrowed_medians`` with one column ``median of each statistic`` per group row."""
    long = narrowed_medians(df, groups, stats, **limits)
    picked = [
        F.max(F.when(F.col("stat") == s, F.col("median"))).alias(s) for s in stats
    ]
    return long.groupBy(*[quoted(g) for g in groups]).agg(*picked)
