"""One registered query per operator, over its whole table; digests follow the query contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import remainder, table
from statloom.llm.decontaminate import decontaminate
from statloom.llm.license_scan import scan_licenses
from statloom.llm.line_templates import drop_recurring_lines
from statloom.llm.nb_svm import score_texts
from statloom.llm.packing import pack
from statloom.llm.phrase_mining import collocations
from statloom.llm.pitman_yor import score_documents
from statloom.llm.prefix_trie import prefix_trie
from statloom.llm.quality_rules import quality_rules
from statloom.llm.queries_sql import ORACLE
from statloom.llm.simhash import simhash_groups
from statloom.llm.toxic_spans import score_toxicity
from statloom.llm.training_order import materialise_order, new_path, read_slots
from statloom.llm.url_filter import url_filter


def op1_divergence(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return quality_rules(docs).select(
        *("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    )


def op2_pitman_yor(spark: SparkSession, d: str) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    docs = table(spark, d, "documents").select("doc_id", "text", (~held_out).alias("train"))
    scored = score_documents(docs, "train")
    return scored.select(
        *("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
    )


def op3_packing(spark: SparkSession, d: str) -> DataFrame:
    pieces = pack(table(spark, d, "documents").select("doc_id", "text"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def _learned_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").where(F.coalesce(remainder("doc_id", 5), F.lit(0)) != 0)


def _predicted(scored: DataFrame, limit: float, *more: str) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 5), F.lit(1)) == 0
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"), *more
    )


def op4_crf(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return _predicted(score_toxicity(docs, _learned_labels(spark, d), "toxic"), 0.5, "spans")


def op5_nb_svm(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return _predicted(score_texts(docs, _learned_labels(spark, d), "quality"), 0.3)


def op6_training_order(spark: SparkSession, d: str) -> DataFrame:
    """Where each sequence was written, and the checksum of what stands there."""
    path = new_path(spark)
    places = materialise_order(table(spark, d, "documents").select("doc_id", "text"), path, key=2026)
    written = read_slots(spark, path).select("slot", F.crc32("ids").alias("ids_crc32"))
    return places.join(written, "slot")


def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash_groups(table(spark, d, "documents").select("doc_id", "text"))


def op8_line_templates(spark: SparkSession, d: str) -> DataFrame:
    cleaned = drop_recurring_lines(table(spark, d, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.array_join("dropped", ",").alias("dropped"), "text"
    )


def op9_fm_index(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, d, "benchmark").select("item_id", "text"))
    ids = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


def op10_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url")
    return url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


def op11_son_phrases(spark: SparkSession, d: str) -> DataFrame:
    return collocations(table(spark, d, "documents").select("lang", "text"))


def op12_licenses(spark: SparkSession, d: str) -> DataFrame:
    found = scan_licenses(table(spark, d, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda b: b["start"])
    own = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    return found.select(
        *("doc_id", "n_words", F.size("base").cast("long").alias("n_base")),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(own, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_divergence": op1_divergence,
    "op2_pitman_yor": op2_pitman_yor,
    "op3_packing": op3_packing,
    "op4_crf": op4_crf,
    "op5_nb_svm": op5_nb_svm,
    "op6_training_order": op6_training_order,
    "op7_simhash": op7_simhash,
    "op8_line_templates": op8_line_templates,
    "op9_fm_index": op9_fm_index,
    "op10_url_filter": op10_url_filter,
    "op11_son_phrases": op11_son_phrases,
    "op12_licenses": op12_licenses,
    "op13_prefix_trie": op13_prefix_trie,
}

__all__ = ["ORACLE", "QUERIES"]
