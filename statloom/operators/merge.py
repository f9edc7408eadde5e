"""Deduplication, key checks, the wide merge and dictionary look-ups."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.operators.schema import quoted
from statloom.storage import BROADCAST_ROWS, join_bounded


def dedup(df: DataFrame, key: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """One row per key: the first or last by ``order``.

    The rank filter is also applied before the shuffle, so a hot key sends one row per task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be first or last")
    by = [quoted(c).asc() if keep == "first" else quoted(c).desc() for c in order]
    spec = Window.partitionBy(*[quoted(k) for k in key]).orderBy(*by)
    return df.withColumn("__pos", F.row_number().over(spec)).filter("__pos = 1").drop("__pos")


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    counts = df.groupBy(*[quoted(k) for k in key]).agg(F.count(F.lit(1)).alias("count"))
    return counts.filter("count > 1")


def assert_unique(df: DataFrame, key: list[str]) -> None:
    if not key_violations(df, key).isEmpty():
        raise ValueError(f"key {key} is not unique")


def _apart(tables: list[DataFrame], key: str) -> list[DataFrame]:
    """Rename columns that two merged tables share to ``_x`` / ``_y``, step by step."""
    merged: dict[str, tuple[int, str]] = {}  # current name -> (table, own name)
    for i, table in enumerate(tables):
        incoming = [c for c in table.columns if c != key]
        clash = [c for c in incoming if c in merged]
        for c in clash:
            merged[f"{c}_x"] = merged.pop(c)
        for c in incoming:
            merged[f"{c}_y" if c in clash else c] = (i, c)
    new_names: list[dict[str, str]] = [{} for _ in tables]
    for name, (i, own) in merged.items():
        new_names[i][own] = name
    return [
        table.select(
            quoted(key), *[quoted(c).alias(new_names[i][c]) for c in table.columns if c != key]
        )
        for i, table in enumerate(tables)
    ]


def _once(table: DataFrame, key: str, label: int) -> DataFrame:
    """The table with one row per key; reading a column of a key that repeats fails.

    The rows come out partitioned by the key, as a merge needs them.
    """
    others = [c for c in table.columns if c != key]
    held = table.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("__n"), *[F.first(quoted(c)).alias(c) for c in others])
    return held.select(quoted(key), *[_checked(quoted(c), F.col("__n"), key, label).alias(c) for c in others])


def _checked(value, count, key: str, label: int):
    text = F.concat(F.lit(f"key {key} repeats in merged table {label}: "), F.col(f"`{key}`").cast("string"))
    return F.when(count > 1, F.raise_error(F.coalesce(text, F.lit(f"NULL {key} repeats")))).otherwise(value)


def merge_wide(
    tables: Mapping[str, DataFrame] | list[DataFrame],
    key: str,
    on_repeat: str = "raise",
    lead: int | None = None,
    where: Mapping[int | str, Column | str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Merge of tables that each hold a key at most once; a NULL key matches no other.

    Without ``lead`` every key stays: the tables are stacked and grouped by the key in one shuffle.
    With ``lead`` only the keys of that table stay, and the others are joined to it. Every table is then
    shuffled once, or not at all if it comes partitioned by the key.

    ``where`` names conditions on single tables (by position or name) in terms of their own columns;
    only keys whose rows meet them all stay, as if the merged rows had been filtered, but each goes to
    its table before the merge, the first of them leads, and a key that a table lacks is out.
    ``columns`` are those that are wanted besides the key, by their merged names; a table that has
    none of them, nor a condition, nor leads, is not read if it cannot add keys.

    A repeated key fails when a column of its table is read, in whichever table. With ``on_repeat``
    ``skip`` the tables are checked first, and one whose key repeats is left out; if it is the first
    one, nothing can be merged to it and it is the result. Rows that a condition drops are not checked.
    """
    frames = list(tables.values()) if isinstance(tables, Mapping) else list(tables)
    names = list(tables) if isinstance(tables, Mapping) else list(range(len(frames)))
    needed = {}
    for name, condition in (where or {}).items():
        i = names.index(name) if name in names else int(name)
        frames[i] = frames[i].filter(condition)
        needed[i] = True
    if on_repeat == "skip":
        if where:
            raise ValueError("conditions go with on_repeat raise")
        if not key_violations(frames[0], [key]).isEmpty():
            return frames[0]
        kept = [0] + [i for i in range(1, len(frames)) if key_violations(frames[i], [key]).isEmpty()]
        if lead is not None and lead not in kept:
            raise ValueError("the key of the leading table repeats")
        lead = None if lead is None else kept.index(lead)
        frames = [frames[i] for i in kept]
    elif on_repeat != "raise":
        raise ValueError("on_repeat must be raise or skip")
    if lead is None and needed:
        lead = min(needed)
    frames = _apart(frames, key)
    wanted = [c for table in frames for c in table.columns if c != key]
    if columns is not None:
        missing = set(columns) - set(wanted)
        if missing:
            raise ValueError(f"no table has {sorted(missing)}")
        wanted = [c for c in wanted if c in columns]
    if lead is not None:
        held = _once(frames[lead], key, lead)
        for i, table in enumerate(frames):
            if i == lead or not (i in needed or set(table.columns) & set(wanted)):
                continue
            other = _once(table, key, i).withColumnRenamed(key, f"__k{i}")
            held = held.join(other, quoted(key) == F.col(f"__k{i}"), "inner" if i in needed else "left")
    else:
        marked = [table.withColumn("__from", F.lit(i)) for i, table in enumerate(frames)]
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
        # sides hold a key once, so nothing is gained by combining before the shuffle
        apart = F.when(quoted(key).isNull(), F.col("__from")).alias("__apart")
        grouped = stacked.repartition(quoted(key)).groupBy(quoted(key), apart)
        held = grouped.agg(
            *[F.first(quoted(c), ignorenulls=True).alias(c) for table in frames for c in table.columns if c != key],
            *[F.count_if(F.col("__from") == i).alias(f"__n{i}") for i in range(len(frames))],
        )
        held = held.select(
            quoted(key),
            *[_checked(quoted(c), F.col(f"__n{i}"), key, i).alias(c) for i, table in enumerate(frames) for c in table.columns if c != key],
        )
    return held.select(quoted(key), *[quoted(c) for c in wanted])


def lookup(
    df: DataFrame,
    dictionary: DataFrame,
    key: str,
    value: str,
    order: list[str],
    keep: str = "first",
    default=None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``value`` from a dictionary whose keys may repeat (first or last entry counts).

    A dictionary of more than ``max_rows`` keys is joined by a shuffle that spreads hot keys of ``df``.
    """
    entries = dedup(dictionary, [key], order, keep).select(quoted(key), quoted(value))
    if default is None:
        return join_bounded(df, entries, [key], "left", max_rows, sketched=True)
    # only a key the dictionary lacks takes the default; an entry may hold NULL itself
    marked = join_bounded(df, entries.withColumn("__hit", F.lit(True)), [key], "left", max_rows, sketched=True)
    return marked.withColumn(
        value, F.when(F.col("__hit"), quoted(value)).otherwise(F.lit(default))
    ).drop("__hit")
