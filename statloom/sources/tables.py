"""Delimited files, and a registry that tolerates missing sources."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statloom.functions.text import MISSING


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, missing: str = MISSING
) -> DataFrame:
    """Header CSV with a given schema; the missing mark and empty cells are NULL."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", missing)
        .option("multiLine", False)
        .option("escape", '"')
        .csv(path)
        .replace("", None)
    )


def write_csv(df: DataFrame, path: str, missing: str = MISSING, mode: str = "errorifexists") -> None:
    """Header CSV, one file per partition, NULL written as ``missing`` (empty text allowed)."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("nullValue", missing)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )


def write_ranking(ranking: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Long ranking table (see ``operators.ranking``) as Parquet, one folder per statistic."""
    ranking.repartition("stat").write.mode(mode).partitionBy("stat").parquet(path)


def page_urls(spark: SparkSession, base: str, pages: int) -> DataFrame:
    """``base1`` .. ``baseN`` as ``(page, url)``."""
    number = F.col("id")
    return spark.range(1, pages + 1).select(
        number.alias("page"), F.concat(F.lit(base), number.cast("string")).alias("url")
    )


def load_sources(
    loaders: Iterable[tuple[str, Callable[[], DataFrame | None]]], on_missing: str = "skip"
) -> dict[str, DataFrame]:
    """Call each loader in order; a source that is absent is left out, or raised for ``fail``."""
    if on_missing not in ("skip", "fail"):
        raise ValueError("on_missing must be skip or fail")
    found: dict[str, DataFrame] = {}
    for name, load in loaders:
        try:
            table = load()
        except AnalysisException:
            if on_missing == "fail":
                raise
            table = None
        if table is not None:
            found[name] = table
        elif on_missing == "fail":
            raise LookupError(f"source {name} is missing")
    return found


def optional_source(load: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None where the file does not exist."""
    return load_sources([("table", load)]).get("table")


def max_number(df: DataFrame, texts: Column, default: int) -> DataFrame:
    """Largest whole number among the texts of all rows, at least 1; ``default`` without texts."""
    top = F.transform(texts, lambda t: F.coalesce(F.trim(t).try_cast("bigint"), F.lit(1)))
    per_row = df.select(F.array_max(top).alias("top"))
    found = F.max("top")
    # greatest skips NULL, so the case without any text is asked first
    largest = F.when(found.isNull(), F.lit(default)).otherwise(F.greatest(found, F.lit(1)))
    return per_row.agg(largest.cast("bigint").alias("pages"))
