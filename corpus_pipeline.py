"""The corpus pipeline: documents in, packed training sequences out, one operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.decontaminate import decontaminate
from statloom.llm.line_templates import drop_recurring_lines
from statloom.llm.packing import pack
from statloom.llm.quality_rules import quality_rules
from statloom.llm.simhash import simhash_groups
from statloom.storage import materialize


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length of the new text."""
    length = F.char_length(F.col("text")).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return changed.select([length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality_rules(docs, keep_text=True).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines of recurring templates; no document goes."""
    return _as_documents(drop_recurring_lines(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group.

    Rows without an id stay, as no group can name them; of rows that share an id one stays.
    """
    groups = simhash_groups(docs.select("doc_id", "text"))
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id")
    kept = materialize(kept, "kept")
    # merged by sorting at every size, as the list of kept documents grows with them
    chosen = docs.join(kept.distinct().hint("merge"), "doc_id", "left_semi").select(*docs.columns)
    if kept.count() > kept.distinct().count():
        chosen = chosen.dropDuplicates(["doc_id"])
    return chosen.unionByName(docs.where(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes benchmark passages out of the texts; no document goes."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _as_documents(decontaminate(docs, bench, remove=True), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
