"""Median, mean and deviation of statistics, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.numeric import mean_of, round2
from statloom.operators.median import IN_MEMORY_VALUES, fits_in_memory, wide_medians
from statloom.operators.schema import quoted
from statloom.storage import join_bounded, materialize

TOTAL = "all"


def labels(stat: str) -> tuple[str, str, str]:
    return f"Median of {stat}", f"Mean of {stat}", f"Std of {stat}"


def _moments(stats: list[str], with_median: bool) -> list[Column]:
    out = []
    for s in stats:
        median, mean, std = labels(s)
        value = quoted(s)
        if with_median:
            out.append(round2(F.median(value)).alias(median))
        out.append(round2(mean_of(value)).alias(mean))
        out.append(round2(F.stddev_samp(value)).alias(std))
    return out


def _ordered(stats: list[str]) -> list[Column]:
    return [quoted(name) for s in stats for name in labels(s)]


def _with_medians(
    profile: DataFrame, df: DataFrame, groups: list[str], stats: list[str], **limits
) -> DataFrame:
    medians = wide_medians(df, groups, stats, **limits)
    named = medians.select(
        *[quoted(g) for g in groups], *[round2(quoted(s)).alias(labels(s)[0]) for s in stats]
    )
    return join_bounded(profile, named, groups, "left")


def group_profile(
    df: DataFrame,
    group: str | None,
    stats: list[str],
    in_memory: int = IN_MEMORY_VALUES,
    **limits,
) -> DataFrame:
    """Median, mean and sample deviation (two decimals) of each statistic, per group or overall.

    The columns are computed and written once. The number of rows, which the written files tell,
    decides whether the built-in median may hold the values of a group; if not, the narrowing one is
    used, which reads them several times.
    """
    groups = [group] if group else []
    data = materialize(df.select(*[quoted(c) for c in [*groups, *stats]]), "profile")
    by = [quoted(g) for g in groups]
    if fits_in_memory(data.count(), len(stats), in_memory):
        return data.groupBy(*by).agg(*_moments(stats, with_median=True))
    return _narrowed_profile(data, group, stats, **limits)


def _narrowed_profile(data: DataFrame, group: str | None, stats: list[str], **limits) -> DataFrame:
    if group:
        by = quoted(group)
        plain = data.groupBy(by).agg(*_moments(stats, with_median=False))
        return _with_medians(plain, data, [group], stats, **limits).select(by, *_ordered(stats))
    # one row: give both parts a constant key and join on it
    plain = data.agg(F.lit(1).alias("__one"), *_moments(stats, with_median=False))
    keyed = data.withColumn("__one", F.lit(1))
    return _with_medians(plain, keyed, ["__one"], stats, **limits).select(*_ordered(stats))


def rollup_profile(
    df: DataFrame,
    group: str,
    stats: list[str],
    in_memory: int = IN_MEMORY_VALUES,
    **limits,
) -> DataFrame:
    """``group_profile`` with a first row for the whole table, then the groups ascending."""
    data = materialize(df.select(*[quoted(c) for c in [group, *stats]]), "profile")
    if fits_in_memory(data.count(), len(stats), in_memory):
        grouped = data.rollup(quoted(group)).agg(
            F.grouping(quoted(group)).alias("__total"), *_moments(stats, with_median=True)
        )
        named = F.when(F.col("__total") == 1, F.lit(TOTAL)).otherwise(quoted(group))
        return (
            grouped.withColumn(group, named)
            .orderBy(F.col("__total").desc(), quoted(group))
            .select(quoted(group), *_ordered(stats))
        )
    whole = _narrowed_profile(data, None, stats, **limits).select(
        F.lit(TOTAL).alias(group), *_ordered(stats), F.lit(1).alias("__total")
    )
    parts = _narrowed_profile(data, group, stats, **limits).withColumn("__total", F.lit(0))
    return (
        whole.unionByName(parts)
        .orderBy(F.col("__total").desc(), quoted(group))
        .drop("__total")
    )


def long_profile(profile: DataFrame, group: str, stats: list[str]) -> DataFrame:
    """Wide profile to one row per group and statistic: ``group, stat, median, mean, std``."""
    entries = [
        F.struct(
            F.lit(s).alias("stat"),
            quoted(labels(s)[0]).alias("median"),
            quoted(labels(s)[1]).alias("mean"),
            quoted(labels(s)[2]).alias("std"),
        )
        for s in stats
    ]
    return profile.select(quoted(group), F.inline(F.array(*entries)))


def group_means(df: DataFrame, group: str, stats: list[str], rounded: bool = False) -> DataFrame:
    means = [mean_of(quoted(s)) for s in stats]
    return df.groupBy(quoted(group)).agg(
        *[(round2(m) if rounded else m).alias(s) for m, s in zip(means, stats)]
    )


def distinct_groups(df: DataFrame, group: str) -> DataFrame:
    return df.select(quoted(group)).distinct().orderBy(quoted(group))


def all_zero_stats(df: DataFrame, stats: list[str]) -> DataFrame:
    """``stat, all_zero``: whether every value of a statistic is 0."""
    flags = df.agg(*[F.bool_and(quoted(s) == 0).alias(s) for s in stats])
    entries = [F.struct(F.lit(s).alias("stat"), quoted(s).alias("all_zero")) for s in stats]
    return flags.select(F.inline(F.array(*entries)))


def bucket_counts(df: DataFrame, bucket: str) -> DataFrame:
    return df.groupBy(quoted(bucket)).agg(F.count(F.lit(1)).alias("rows"))
