"""Equal-width histograms over the range of the data, last bin closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators.schema import quoted
from statloom.storage import join_bounded


def _edges(low: Column, high: Column) -> tuple[Column, Column]:
    """A range without width is taken half a unit to each side."""
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """The bin of a value; NULL for NULL. Division may land one bin beside a value that lies on an edge:
    the edges decide."""
    step = (high - low) / F.lit(float(bins))
    place = F.least(F.floor((value - low) / (high - low) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    edge, following = low + place * step, low + (place + 1) * step
    return (
        F.when(value < edge, place - 1)
        .when((place < bins - 1) & (value >= following), place + 1)
        .otherwise(place)
    )


def histogram(df: DataFrame, stats: list[str], bins: int, group: str | None = None) -> DataFrame:
    """Row counts per bin of each statistic, over all rows or per group with its own range.

    Columns: ``[group,] stat, bin (from 0), low, high, rows``; empty bins are listed with 0. The input
    is read for the ranges, one row per group, and for the counts; a task sends at most one row per
    statistic and bin (and group), whatever the number of values.
    """
    ids = [group] if group else []
    by = [quoted(k) for k in [*ids, "stat"]]
    values = df.select(*[quoted(g) for g in ids], *[quoted(s).cast("double").alias(f"v{i}") for i, s in enumerate(stats)])
    ranges = []
    for i in range(len(stats)):
        low, high = _edges(F.min(f"v{i}"), F.max(f"v{i}"))
        ranges += [low.alias(f"lo{i}"), high.alias(f"hi{i}")]
    ends = values.groupBy(*[quoted(g) for g in ids]).agg(*ranges)
    if group:
        ranged = join_bounded(values, ends, ids, sketched=True)
    else:
        row = ends.first()  # two numbers per statistic
        ranged = values.select("*", *[F.lit(row[c]).cast("double").alias(c) for c in ends.columns])
    cells = []
    for i, s in enumerate(stats):
        cells.append(F.struct(F.lit(s).alias("stat"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"), F.col(f"v{i}").alias("v")))
    # the range travels with the key, so the empty bins need no further pass over the data
    spread = ranged.select(*[quoted(g) for g in ids], F.inline(F.array(*cells))).filter("v IS NOT NULL")
    binned = spread.withColumn("bin", _bin(F.col("v"), F.col("lo"), F.col("hi"), bins))
    summed = binned.groupBy(*by, "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    filled = summed.groupBy(*by, "lo", "hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("held")
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    upper = F.col("lo") + (F.col("bin") + 1) * step
    return (
        filled.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            *by,
            "bin",
            (F.col("lo") + F.col("bin") * step).alias("low"),
            F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(upper).alias("high"),
            F.coalesce(F.try_element_at("held", F.col("bin")), F.lit(0)).cast("bigint").alias("rows"),
        )
    )
