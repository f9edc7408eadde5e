"""Distribution divergence: documents whose characters or common words are unlike their language.

Each document has two histograms, one over character classes and one over the common words of its
language. The reference of a language is the sum over its documents that pass the base rule; every
language that occurs has one, and documents without a language have one of their own. A
document is rejected when the Jensen-Shannon distance (square root of the divergence to base 2, so
0 to 1) to its reference passes a limit; documents too short for a histogram are not judged by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import chunks, flat_words, numbered, texts_of
from statloom.storage import join_bounded, materialize

# Common words of the languages that have a list of their own. Other languages are
# measured with all of them together.
COMMON_WORDS = {
    "de": "aber als auch auf aus bei das dem den der des die ein eine einer er es für hat ich im in ist mit nicht sich sie sind und von werden wie wir zu",
    "en": "a an and are as at be but by for from had has have he in is it not of on or that the they this to was we were which with you",
    "es": "a al con como de del el en es este ha la las lo los más no o para pero por que se sin sobre su sus un una y",
    "fr": "a au aux ce dans de des du elle en est et il je la le les mais ne nous ou pas par plus pour que qui se son sur un une vous",
}
ALL_WORDS = sorted({w for words in COMMON_WORDS.values() for w in words.split()})

# Character classes; what is in none of them counts as other.
CLASSES = {
    "vowel": "aeiou",
    "consonant": "bcdfghjklmnpqrstvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "space": " ",
    "line": "\n",
    "stop": ".,;:!?",
    "symbol": "#*$%&|<>",
}
SYMBOLS = CLASSES["symbol"].encode()

#: Limits of the distances, and the least characters or words of a document to be judged. n words drawn
#: from the reference itself lie at a distance that falls with the root of n: the word limit has a
#: part for that noise.
CHAR_LIMIT, CHAR_LEAST = 0.3, 200
WORD_LIMIT, WORD_NOISE, WORD_LEAST = 0.17, 1.2, 50
#: Words that the passing documents of a language must have in all for it to be judged by distances.
REFERENCE_LEAST = 1_000

_FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "chars array<long>, commons array<long>"
)


def repeated_words(numbers: np.ndarray, counts: np.ndarray, size: int = 3) -> np.ndarray:
    """Per text: its words that lie in a window of ``size`` words found twice or more in it.

    Windows get a number each, one word after the other, so that equal numbers are equal windows.
    """
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(len(counts), np.int64)
    code, base = numbers[:n].astype(np.int64), int(numbers.max()) + 1
    for k in range(1, size):
        code = code * base + numbers[k : n + k]
        code = np.unique(code, return_inverse=True)[1]
    inside = np.flatnonzero(text[:n] == text[size - 1 :])
    code = code[inside] + text[inside] * (int(code.max()) + 1)
    _, where, found = np.unique(code, return_inverse=True, return_counts=True)
    start = inside[found[where] >= 2]
    hit = np.zeros(len(numbers), bool)
    for k in range(size):
        hit[start + k] = True
    return np.bincount(text[hit], minlength=len(counts))


def _class_table() -> np.ndarray:
    """256 bytes x classes: the class of each byte; bytes inside a character belong to none."""
    classes = list(CLASSES.values())
    out = np.zeros((256, len(classes) + 1), np.int64)
    for byte in range(256):
        own = next((i for i, c in enumerate(classes) if bytes([byte]) in [x.encode() for x in c]), len(classes))
        out[byte, own] = not 0x80 <= byte < 0xC0
    return out


def _features(lang_column: str, text_column: str, keep_text: bool):
    lists = {lang: [w.encode() for w in words.split()] for lang, words in COMMON_WORDS.items()}
    every = [w.encode() for w in ALL_WORDS]
    inside = bytes(range(0x80, 0xC0)) + b" \t\n\r\x0b\x0c"
    table = _class_table()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_column):
            texts = texts_of(batch, text_column)
            words, counts = flat_words(texts)
            distinct, numbers = numbered(words)
            repeats = repeated_words(numbers, counts)
            ends = np.cumsum(counts)
            # number of each listed word among this chunk's words, in lower case
            spelled: dict[bytes, list[int]] = {}
            for i, w in enumerate(distinct):
                if len(w) <= 8:
                    spelled.setdefault(w.lower(), []).append(i)
            bins = {}
            for lang, listed in [*lists.items(), (None, every)]:
                bins[lang] = np.full(max(len(distinct), 1), len(listed))
                for k, w in enumerate(listed):
                    bins[lang][spelled.get(w, [])] = k
            out: list[tuple] = []
            for i, (text, lang) in enumerate(zip(texts, batch.column(lang_column).to_pylist(), strict=True)):
                lang = lang if lang in lists else None
                size = len(lists.get(lang, every)) + 1
                lines = [x for x in text.split(b"\n") if x.strip()]
                own = numbers[ends[i] - counts[i] : ends[i]]
                out.append(
                    (
                        int(counts[i]),
                        len(text.translate(None, inside)),
                        len(text) - len(text.translate(None, SYMBOLS)),
                        len(lines) - len(set(lines)),
                        int(repeats[i]),
                        np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ table,
                        np.bincount(bins[lang][own], minlength=size),
                    )
                )
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
            names = [x.split()[0] for x in _FEATURES.split(", ")]
            made = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            kept = [c for c in batch.schema.names if keep_text or c != text_column]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], [*kept, *names])

    return measure


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms given as arrays of counts."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    def part(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        half = lambda x: F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)
        return (half(p) + half(q)) / 2

    p = F.transform(counts, lambda x: x / F.greatest(total(counts), F.lit(1.0)))
    q = F.transform(reference, lambda x: x / F.greatest(total(reference), F.lit(1.0)))
    return F.sqrt(F.greatest(total(F.zip_with(p, q, part)), F.lit(0.0)))


def _summed(column: str, group: DataFrame, by: list[str]) -> DataFrame:
    """Element-wise sums of an array column, back as one array per group."""
    cells = group.select(*by, F.posexplode(column).alias("pos", "n"))
    sums = cells.groupBy(*by, "pos").agg(F.sum("n").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "n")))  # one entry for each class
    return sums.groupBy(*by).agg(F.transform(ordered, lambda x: x["n"]).alias(f"ref_{column}"))


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    char_limit: float = CHAR_LIMIT,
    char_least: int = CHAR_LEAST,
    word_limit: float = WORD_LIMIT,
    word_noise: float = WORD_NOISE,
    word_least: int = WORD_LEAST,
    keep_text: bool = False,
    reference_least: int = REFERENCE_LEAST,
) -> DataFrame:
    """One row per input row: its columns, the base measures, distances and verdict.

    The text is left out unless ``keep_text`` is set. A document of n words is rejected beyond the
    character limit or beyond ``word_limit + word_noise / sqrt(n)``.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance,
    word_distance, kept``. A NULL or empty text has no words and fails the base rule. A document is
    compared with those of its language only, one of NULL language with the others of NULL language;
    where these have fewer than ``reference_least`` words in all, it is not judged by distances (NULL).
    An empty table gives an empty result; equal rows get equal verdicts. Input columns that bear the name of an
    added one are replaced by it.
    """
    added = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "commons"}
    added |= {"base_failed", "char_distance", "word_distance", "kept", "ref_chars", "ref_commons", "ref_lang"}
    lower = {c.lower() for c in (text, lang)}
    carried = [c for c in docs.columns if c.lower() not in added | lower]
    source = docs.select(*carried, F.col(lang).cast("string").alias("__lang"), F.col(text).cast("string").alias("__text"))
    plain = source.schema if keep_text else source.drop("__text").schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain)
    measured = source.mapInArrow(_features("__lang", "__text", keep_text), f"{schema}, {_FEATURES}")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = materialize(measured.withColumn("base_failed", failed), "quality")

    # summed up per language before any row moves, as is the look-up of common languages
    passed = measured.where(~F.col("base_failed"))
    chars = _summed("chars", passed, ["__lang"]).withColumnRenamed("__lang", "ref_lang")
    commons = _summed("commons", passed, ["__lang"])
    refs = chars.join(commons, F.col("ref_lang").eqNullSafe(F.col("__lang"))).drop("ref_lang")
    # a reference holds all words of its documents: the listed ones and the others
    held = F.aggregate("ref_commons", F.lit(0).cast("long"), lambda a, b: a + b)
    joined = join_bounded(measured, refs.where(held >= reference_least), ["__lang"], "left")
    judged = F.col("ref_chars").isNotNull()
    char_total = F.aggregate("chars", F.lit(0).cast("long"), lambda a, b: a + b)
    joined = joined.withColumn("char_distance", F.when((char_total >= char_least) & judged, _distance(F.col("chars"), F.col("ref_chars"))))
    joined = joined.withColumn(
        "word_distance", F.when((F.col("n_words") >= word_least) & judged, _distance(F.col("commons"), F.col("ref_commons")))
    )
    far = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > char_limit) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > word_limit + word_noise / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    )
    return joined.withColumn("kept", ~F.col("base_failed") & ~far).select(
        *carried,
        F.col("__lang").alias(lang),
        *([F.col("__text").alias(text)] if keep_text else []),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "char_distance", "word_distance", "kept"),
    )
