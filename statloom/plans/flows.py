"""The season flows from sources to files: pages and CSV files in, CSV and Parquet folders out.

Results are sorted here, where they are written, not in the stages that only hand rows on. A flow
returns what it has written by name, as read back from its files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from statloom.plans import reports, season, transfers
from statloom.plans.wide_table import build_wide_table
from statloom.sources.tables import load_sources, optional_source, read_csv, write_csv, write_ranking
from statloom.storage import materialize

VALUE_SCHEMA = "Player string, Position string, Price string"


def _written(df: DataFrame, path: str, missing: str) -> DataFrame:
    """One CSV file in the order of ``df``, which holds a result of a season, and its rows."""
    write_csv(df.coalesce(1), path, missing)
    return read_csv(df.sparkSession, path, df.schema, missing)


def wide_flow(loaders: Mapping[str, Callable[[], DataFrame | None]], out: str) -> dict[str, DataFrame]:
    """Pages of each stat table to the wide table; absent sources are skipped."""
    wide = build_wide_table(load_sources(loaders.items()))
    return {"result": _written(wide, f"{out}/result", season.MISSING)}


def statistics_flow(spark: SparkSession, wide_path: str, out: str) -> dict[str, DataFrame]:
    """The wide table's file to ranking, profile, leaders and histograms."""
    wide = read_csv(spark, wide_path, season.WIDE_SCHEMA, season.MISSING)
    report = reports.statistics_report(wide)
    write_ranking(report["ranking"], f"{out}/ranking")
    found = {"ranking": spark.read.parquet(f"{out}/ranking")}
    for name in ("profile", "leaders", "wins", "best"):
        found[name] = _written(report[name], f"{out}/{name}", "")
    for name in ("league_histogram", "team_histogram"):
        found[name] = _written(report[name], f"{out}/{name}", "")
    return found


def cluster_flow(spark: SparkSession, wide_path: str, out: str, **options) -> dict[str, DataFrame]:
    """The wide table's file to the clustered players and the tables beside them."""
    wide = read_csv(spark, wide_path, season.WIDE_SCHEMA, season.MISSING)
    report = reports.cluster_report(wide, **options)
    return {name: _written(table, f"{out}/{name}", "") for name, table in report.items()}


def transfer_flow(
    spark: SparkSession,
    wide_path: str,
    out: str,
    fee_pages: DataFrame | None = None,
    value_pages: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The wide table's file and the listing pages to regular players, fees, estimates and values.

    A missing player file leaves only the listings, with their positions unknown.
    """
    wide = optional_source(lambda: read_csv(spark, wide_path, season.WIDE_SCHEMA, season.MISSING))
    found = {}
    if wide is not None:
        found["regular"] = _written(transfers.regular_players(wide), f"{out}/regular", season.MISSING)
        if fee_pages is not None:
            found["fees"] = _written(transfers.confirmed_fees(wide, fee_pages), f"{out}/fees", "")
    if value_pages is not None:
        estimated = materialize(transfers.estimated_values(wide, value_pages), "estimated")
        listed = estimated.orderBy("ord").drop("ord")
        found["estimates"] = _written(listed, f"{out}/estimates", "")
        if wide is not None:
            report = transfers.value_report(wide, estimated, "ord")
            found["unmatched"] = _written(report["unmatched"].orderBy("role", "Player"), f"{out}/unmatched", "")
            if report["values"] is not None:
                found["values"] = _written(report["values"], f"{out}/values", "")
    return found
