"""Approximate name joins by token-sort similarity: best match, semi and anti.

The pairs come from a metric join (:mod:`statloom.operators.metric_join`), which loses no pair at or
above the threshold. Names are prepared, reduced to distinct ones, and equal ones settled before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.similarity import sorted_words
from statloom.operators.metric_join import similar_pairs
from statloom.operators.schema import quoted
from statloom.storage import join_bounded, materialize


def _prepared(df: DataFrame, name: str, shorten) -> DataFrame:
    text = quoted(name) if shorten is None else shorten(quoted(name))
    return df.withColumn("__text", sorted_words(text))


def best_text_matches(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """Best right text per left text: ``text, r_ord, r_name, score``.

    ``right`` holds ``text, r_ord, r_name``. Equal texts score 100 and, up to 98 letters, nothing
    else does, so those names are settled by a plain join and skip the search.
    """
    same = left.join(right, "text").withColumn("score", F.lit(100))
    settled = same.filter(F.length("text") <= 98)
    rest = materialize(left.join(settled.select("text"), "text", "left_anti"), "names")
    pairs = similar_pairs(rest, right, threshold)
    named = pairs.join(right.withColumnRenamed("text", "r_text"), "r_text").select(
        F.col("l_text").alias("text"), "r_ord", "r_name", "score"
    )
    spec = Window.partitionBy("text").orderBy(F.desc("score"), "r_ord")
    best = named.withColumn("__pos", F.row_number().over(spec)).filter("__pos = 1").drop("__pos")
    return settled.select("text", "r_ord", "r_name", "score").unionByName(best)


def fuzzy_best_match(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    right_order: str,
    threshold: int,
    shorten=None,
) -> DataFrame:
    """Left rows with ``matched_name`` and ``match_score`` of the best right name, or NULLs.

    The best right name has the highest score; equal scores go to the smallest ``right_order``.
    ``shorten`` is applied to both names before they are compared. Repeated names are compared
    once, so copies of a hot name cost nothing in the search.
    """
    l_rows = _prepared(left, left_name, shorten)
    options = _prepared(right.filter(quoted(right_name).isNotNull()), right_name, shorten)
    first = F.min(F.struct(quoted(right_order).alias("r_ord"), quoted(right_name).alias("r_name")))
    r_texts = (
        options.filter("__text <> ''")
        .groupBy(F.col("__text").alias("text"))
        .agg(first.alias("first"))
        .select("text", "first.r_ord", "first.r_name")
    )
    l_texts = l_rows.filter("__text <> ''").select(F.col("__text").alias("text")).distinct()
    # the names are prepared and reduced to distinct ones in one pass over each side
    l_texts, r_texts = materialize(l_texts, "names"), materialize(r_texts, "names")
    best = best_text_matches(l_texts, r_texts, threshold).select(
        F.col("text").alias("__text"),
        F.col("r_name").alias("matched_name"),
        F.col("score").alias("match_score"),
    )
    return join_bounded(l_rows, best, ["__text"], "left").drop("__text")


def fuzzy_semi(left: DataFrame, right: DataFrame, *args, **kwargs) -> DataFrame:
    """Left rows whose best match reaches the threshold, as they are."""
    matched = fuzzy_best_match(left, right, *args, **kwargs)
    return matched.filter("matched_name IS NOT NULL").select(*[quoted(c) for c in left.columns])


def fuzzy_anti(left: DataFrame, right: DataFrame, *args, **kwargs) -> DataFrame:
    """Left rows without a match."""
    matched = fuzzy_best_match(left, right, *args, **kwargs)
    return matched.filter("matched_name IS NULL").select(*[quoted(c) for c in left.columns])
