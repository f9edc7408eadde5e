"""From raw pages to one wide row per player."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.numeric import parse_number
from statloom.functions.text import clean_name, last_word, parse_age
from statloom.operators.merge import dedup, merge_wide
from statloom.operators.schema import (
    coerce,
    fill_text,
    in_order,
    quoted,
    rename_columns,
    select_known,
    sort_by_first_word,
)
from statloom.plans import season
from statloom.sources.html import commented_table


def stat_table(pages: DataFrame, table_id: str, header: list[str] | None = None) -> DataFrame | None:
    """One stat table of the pages: known columns only, one row per player, first row wins."""
    named = commented_table(pages, table_id, header)
    if named is None:
        return None
    table = rename_columns(named, season.HEADERS.get(table_id, {}))
    if "Player" not in table.columns:
        return None
    changed = {"Player": clean_name(F.col("Player"))}
    if "Age" in table.columns:
        changed["Age"] = parse_age(F.col("Age"))
    table = table.withColumns(changed)
    first = dedup(table, ["Player"], ["page_id", "row_ord"])
    return select_known(first, season.REQUIRED)


def merge_stat_tables(tables: Mapping[str, DataFrame], sort: bool = True) -> DataFrame:
    """Merge stat tables by player, type the columns, keep players above the minutes limit.

    The limit keeps only players of the one table whose minutes survive the merge under their own
    name, so it is applied there, and the other tables are joined to what is left.
    """
    held = [i for i, t in enumerate(tables.values()) if "Minutes" in t.columns]
    frames = list(tables.values())
    lead = held[0] if len(held) == 1 else None
    if lead is not None:
        frames[lead] = frames[lead].filter(parse_number(quoted("Minutes")) > season.MIN_MINUTES)
    wide = in_order(merge_wide(frames, "Player", lead=lead), season.REQUIRED)
    typed = coerce(wide, season.WHOLE, season.DECIMAL)
    played = typed.filter(quoted("Minutes") > season.MIN_MINUTES)
    named = played.withColumns(
        {
            c: expr
            for c, expr in (
                ("Nation", last_word(F.col("Nation")) if "Nation" in played.columns else None),
                ("Player", clean_name(F.col("Player"))),
            )
            if expr is not None
        }
    )
    full = fill_text(named, season.TEXT, season.MISSING)
    return sort_by_first_word(full, "Player") if sort else full


def build_wide_table(
    sources: Mapping[str, DataFrame], headers: Mapping[str, list[str]] | None = None
) -> DataFrame:
    """``{table id: pages}`` to the wide table. Tables that no page holds are skipped."""
    tables = {}
    for table_id, pages in sources.items():
        table = stat_table(pages, table_id, (headers or {}).get(table_id))
        if table is not None:
            tables[table_id] = table
    if not tables:
        raise LookupError("none of the stat tables was found")
    return merge_stat_tables(tables)
