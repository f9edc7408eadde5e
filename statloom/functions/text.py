"""Text clean-up of names, ages, money, positions and page cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.functions.numeric import parse_number, round2

MISSING = "N/A"
SPACE = r"[\s\p{Z}\x1c-\x1f\x{85}]+"


def present(text: Column) -> Column:
    """NULL for the missing mark, the text otherwise."""
    return F.when(text != F.lit(MISSING), text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")


def words(text: Column) -> Column:
    """Whitespace-separated words; a blank text gives one empty word."""
    return F.split(strip(text), SPACE)


def parse_age(text: Column) -> Column:
    """``years-days`` to decimal years; plain numbers pass; everything else is NULL."""
    t = strip(present(text))
    years = F.regexp_extract(t, r"^(\d+)\s*-", 1).try_cast("double")
    days = F.regexp_extract(t, r"-\s*(\d+)$", 1).try_cast("double")
    return (
        F.when(t.rlike(r"^\d+\s*-\s*\d+$"), round2(years + days / F.lit(365.0)))
        .when(t.contains("-"), F.lit(None).cast("double"))
        .when(t.contains("."), round2(parse_number(t)))
        .when(t.rlike(r"^\d+$"), t.try_cast("double"))
    )


def last_word(text: Column) -> Column:
    """Last word, NULL when there is none."""
    t = strip(present(text))
    return F.when(t != "", F.element_at(F.split(t, SPACE), -1))


def first_word(text: Column) -> Column:
    """First word; empty for a missing name."""
    return F.coalesce(F.get(words(present(text)), F.lit(0)), F.lit(""))


def clean_name(text: Column) -> Column:
    """``Last, First`` to ``First Last`` (all comma parts reversed); otherwise collapse spaces."""
    t = present(text)
    turned = F.array_join(F.reverse(F.transform(F.split(t, ","), strip)), " ")
    spaced = F.regexp_replace(strip(t), SPACE, " ")
    return F.coalesce(F.when(t.contains(","), turned).otherwise(spaced), F.lit(MISSING))


def first_two_words(text: Column) -> Column:
    """First two words; a text of one word is left as it is; NULL becomes empty."""
    w = words(text)
    short = F.when(F.size(w) >= 2, F.array_join(F.slice(w, 1, 2), " ")).otherwise(text)
    return F.coalesce(short, F.lit(""))


def first_and_last_word(text: Column, special: dict[str, str] | None = None) -> Column:
    """Special names first; three or more words keep first and last; otherwise unchanged."""
    w = words(text)
    short = F.when(
        F.size(w) >= 3, F.concat_ws(" ", F.element_at(w, 1), F.element_at(w, -1))
    ).otherwise(text)
    if not special:
        return short
    pairs = [F.lit(item) for entry in special.items() for item in entry]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), text), short)


def parse_money(text: Column) -> Column:
    """``€41.6M`` / ``£350K`` / ``900`` to a number; other texts (``Free``) are NULL."""
    t = F.upper(strip(F.regexp_replace(text, "[€£]", "")))
    unit = F.when(t.contains("M"), 1_000_000.0).when(t.contains("K"), 1_000.0).otherwise(1.0)
    return parse_number(F.regexp_replace(t, "[MK]", "")) * unit


def main_role(text: Column) -> Column:
    """First of the roles separated by comma or slash."""
    return strip(F.get(F.split(text, "[,/]"), F.lit(0)))


def position_bucket(text: Column) -> Column:
    """Keepers anywhere in the list win; otherwise the leading position; otherwise NULL."""
    return (
        F.when(text.contains("GK"), "GK")
        .when(text.startswith("DF"), "DF")
        .when(text.startswith("MF"), "MF")
        .when(text.startswith("FW"), "FW")
    )


def first_line(text: Column) -> Column:
    return F.get(F.split(text, "\n"), F.lit(0))


def cell_name(cells: Column, index: int) -> Column:
    """Name cell: first line only, trimmed."""
    return strip(first_line(strip(F.get(cells, F.lit(index)))))


def cell_price(cells: Column) -> Column:
    """Last cell of a row with at least three cells; NULL for shorter rows."""
    return F.when(F.size(cells) >= 3, strip(F.try_element_at(cells, F.lit(-1))))
