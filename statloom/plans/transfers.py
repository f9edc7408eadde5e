"""Confirmed fees, estimated values, and the value model per role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.text import (
    cell_name,
    cell_price,
    first_and_last_word,
    first_two_words,
    first_word,
    main_role,
    parse_money,
    position_bucket,
    strip,
)
from statloom.operators.fuzzy import fuzzy_best_match, fuzzy_semi
from statloom.operators.merge import dedup, lookup
from statloom.operators.schema import quoted
from statloom.operators.value_model import value_all_roles
from statloom.plans import season
from statloom.sources.html import class_table_rows
from statloom.storage import materialize

# fixed values: least scores of the three matches, order of the position groups
FEE_SCORE, ESTIMATE_SCORE, VALUE_SCORE = 80, 70, 90
BUCKETS = ["GK", "DF", "MF", "FW"]


def regular_players(wide: DataFrame) -> DataFrame:
    return wide.filter(quoted("Minutes") > season.TRANSFER_MINUTES)


def _scraped(pages: DataFrame, css_class: str, name_cell: int) -> DataFrame:
    rows = class_table_rows(pages, css_class)
    return rows.select(
        "page_id",
        "row_ord",
        cell_name(F.col("cells"), name_cell).alias("Player"),
        cell_price(F.col("cells")).alias("Price"),
    )


def confirmed_fees(wide: DataFrame, pages: DataFrame, css_class: str = "transfer-table") -> DataFrame:
    """Scraped transfers whose player is among the regular players: ``Player, Price``."""
    scraped = _scraped(pages, css_class, 0)
    players = regular_players(wide).select(strip(F.col("Player")).alias("Known"))
    matched = fuzzy_semi(
        scraped, players, "Player", "Known", "Known", FEE_SCORE, shorten=first_two_words
    )
    return matched.orderBy("page_id", "row_ord").select("Player", "Price")


def _short_names(wide: DataFrame) -> DataFrame:
    """Short name, its first place in the table, and the entry of its last place."""
    known = wide.select(
        strip(F.col("Player")).alias("Original"),
        "Position",
        F.struct(first_word(F.col("Player")).alias("a"), F.col("Player").alias("b")).alias("ord"),
    ).withColumn("Short", first_and_last_word(F.col("Original"), season.SPECIAL_NAMES))
    last = F.max(F.struct("ord", "Original", "Position"))
    return (
        known.groupBy("Short")
        .agg(F.min("ord").alias("ord"), last.alias("last"))
        .select("Short", "ord", "last.Original", "last.Position")
    )


def estimated_values(
    wide: DataFrame | None, pages: DataFrame, css_class: str = "similar-players-table"
) -> DataFrame:
    """Scraped values with the known player and position: ``Player, Position, Price, ord``.

    Position groups come in the order keepers, defenders, midfielders, forwards; the first row of
    a player counts. Without a player table every scraped row is returned with position Unknown.
    ``ord`` is the order of the result.
    """
    scraped = _scraped(pages, css_class, 1)
    if wide is None or wide.isEmpty():
        rows = scraped.select(
            "Player",
            F.lit(season.UNKNOWN).alias("Position"),
            "Price",
            F.struct(F.lit(0).alias("bucket"), "page_id", "row_ord").alias("ord"),
        )
        return dedup(rows, ["Player"], ["ord"]).orderBy("ord")
    short = scraped.withColumn("Short", first_and_last_word(F.col("Player"), season.SPECIAL_NAMES))
    known = materialize(_short_names(wide), "short_names")
    matched = fuzzy_best_match(short, known, "Short", "Short", "ord", ESTIMATE_SCORE)
    entries = known.select(F.col("Short").alias("matched_name"), "ord", "Original", "Position")
    found = matched.filter("matched_name IS NOT NULL")
    found = lookup(found, entries, "matched_name", "Original", ["ord"])
    found = lookup(found, entries, "matched_name", "Position", ["ord"])
    bucket = position_bucket(F.col("Position"))
    place = F.array_position(F.array(*[F.lit(b) for b in BUCKETS]), bucket).cast("int")
    rows = found.filter(bucket.isNotNull()).select(
        F.col("Original").alias("Player"),
        "Position",
        "Price",
        F.struct(place.alias("bucket"), "page_id", "row_ord").alias("ord"),
    )
    return dedup(rows, ["Player"], ["ord"]).orderBy("ord")


def match_values(wide: DataFrame, values: DataFrame, order: str) -> DataFrame:
    """Players with their main role, linked name, score and value (NULL where not linked).

    ``order`` is the column of ``values`` that holds the order of its rows; it decides ties.
    """
    priced = values.select(
        F.col("Player").alias("Known"), quoted(order).alias("__ord"), F.col("Price")
    )
    roles = wide.withColumn("Main_Role", main_role(F.col("Position")))
    matched = fuzzy_best_match(
        roles, priced, "Player", "Known", "__ord", VALUE_SCORE, shorten=first_two_words
    ).withColumnsRenamed({"matched_name": "Linked_Name", "match_score": "Link_Score"})
    entries = priced.withColumnRenamed("Known", "Linked_Name")
    return lookup(matched, entries, "Linked_Name", "Price", ["__ord"]).withColumn(
        "Valuation", parse_money(F.col("Price"))
    )


def value_report(wide: DataFrame, values: DataFrame, order: str) -> dict[str, DataFrame | None]:
    """``values``: players with actual and predicted value; ``unmatched``: role and player."""
    matched = materialize(match_values(wide, values, order), "matched")
    linked = matched.filter("Linked_Name IS NOT NULL").withColumn(
        "__first", first_word(F.col("Player"))
    )
    single = materialize(
        dedup(linked, ["Main_Role", "Linked_Name"], ["__first", "Player"]).drop("__first"), "linked"
    )
    valued = value_all_roles(
        single, season.ROLES, "Main_Role", "Valuation", "Player", ["Player", "Team", "Nation"]
    )
    codes = F.create_map(*[F.lit(x) for r in season.ROLES for x in (r.code, r.role)])
    unmatched = (
        matched.filter("Linked_Name IS NULL AND Player IS NOT NULL")
        .select(F.try_element_at(codes, F.upper("Main_Role")).alias("role"), "Player")
        .filter("role IS NOT NULL")
    )
    if valued is not None:
        valued = valued.select(
            "Player", "Team", "Nation", F.col("position").alias("Position"),
            F.col("actual_m").alias("Actual_Transfer_Value_M"),
            F.col("predicted_m").alias("Predicted_Transfer_Value_M"),
        )
    return {"values": valued, "unmatched": unmatched}
