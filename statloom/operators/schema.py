"""Columns: rename, tolerant select, conform, coerce, fill, unpivot."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.numeric import round2, to_number, to_whole
from statloom.functions.text import first_word


def quoted(name: str) -> Column:
    """Column by its exact name (names hold dots, blanks and percent signs)."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by a dictionary. Unknown names stay; of equal new names the first column stays."""
    kept: dict[str, str] = {}
    for old in df.columns:
        kept.setdefault(names.get(old, old), old)
    return df.select(*[quoted(old).alias(new) for new, old in kept.items()])


def first_of_names(names: Iterable[str]) -> list[tuple[int, str]]:
    """Positions and names with repeated names left out, for use before a frame is named."""
    seen: dict[str, int] = {}
    for i, name in enumerate(names):
        seen.setdefault(name, i)
    return [(i, name) for name, i in seen.items()]


def select_known(df: DataFrame, known: Iterable[str]) -> DataFrame:
    """Keep the columns that are in the list, in table order."""
    wanted = set(known)
    return df.select(*[quoted(c) for c in df.columns if c in wanted])


def in_order(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """Columns in the given order; absent ones are skipped, unlisted ones dropped."""
    return df.select(*[quoted(c) for c in order if c in df.columns])


def numeric_names(df: DataFrame, excluded: Iterable[str]) -> list[str]:
    left_out = set(excluded)
    return [c for c in df.columns if c not in left_out]


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the named columns; a missing one becomes NULL, or empty text for strings."""
    columns = []
    for name, data_type in schema.items():
        if name in df.columns:
            columns.append(quoted(name))
        else:
            default = F.lit("") if data_type == "string" else F.lit(None).cast(data_type)
            columns.append(default.alias(name))
    return df.select(*columns)


def coerce(
    df: DataFrame, whole: Iterable[str] = (), decimal: Iterable[str] = (), strict: bool = False
) -> DataFrame:
    """Parse the listed columns: whole numbers to long, decimals to double with two places."""
    changed = {}
    for c in whole:
        if c in df.columns:
            changed[c] = to_whole(to_number(quoted(c), type_of(df, c)), strict)
    for c in decimal:
        if c in df.columns:
            changed[c] = round2(to_number(quoted(c), type_of(df, c)))
    return df.withColumns(changed)


def zero_fill(df: DataFrame, stats: Iterable[str]) -> DataFrame:
    """Every statistic as a number, with 0 where it is missing or does not parse."""
    return df.withColumns(
        {
            c: F.coalesce(to_number(quoted(c), type_of(df, c)), F.lit(0.0))
            for c in stats
            if c in df.columns
        }
    )


def fill_text(df: DataFrame, columns: Iterable[str], value: str) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(quoted(c), F.lit(value)) for c in columns if c in df.columns}
    )


def unpivot_stats(df: DataFrame, ids: list[str], stats: list[str]) -> DataFrame:
    """One row per entity and statistic: ``ids, stat, value``."""
    wide = df.select(*[quoted(c) for c in ids], *[quoted(c).cast("double").alias(c) for c in stats])
    return wide.unpivot(
        [quoted(c) for c in ids], [quoted(c) for c in stats], "stat", "value"
    )


def sort_by_first_word(df: DataFrame, name: str, *tie_break: str) -> DataFrame:
    """Order by the first word of the name, then the whole name, then the given columns."""
    rest = [quoted(c).asc_nulls_last() for c in tie_break]
    return df.orderBy(first_word(quoted(name)), quoted(name).asc_nulls_last(), *rest)
