"""Phrase collocations, mined by partitioning (SON).

A shard is what a task reads. It goes through memory in slices of bounded size; each slice is mined
completely, level by level, at the support lowered in proportion to its share of a language's bytes,
and what its slices report bounds a phrase's count in the shard (a slice that does not report it holds
less than its bar). A shard reports the phrases that may reach its own bar: one that is frequent in
all reaches it in some shard. In the same way all reports bound the count in all, and the phrases
whose bound reaches the support are the candidates. The second pass counts them everywhere, exactly:
a bit filter of bounded size tells which phrases may be candidates; what it lets through by chance
is counted like the others and fails the support.

With an absolute support the bars fall as shards multiply. From one occurrence on the first pass
reports every phrase, with its count; results stay the same.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.common import chunks, mixed, texts_of
from statloom.storage import join_bounded, materialize

SUPPORT, LONGEST, TOP, COVERED = 100, 5, 2_000, 100
#: Bytes of text that a shard has if there are enough for all cores, those of its slices (or one longer
#: text), and positions that are numbered at once.
SHARD_BYTES, SLICE_BYTES, PART = 256 << 20, 32 << 20, 1_000_000
#: Bytes of text that are cut into words at once.
CUT_BYTES = 4 << 20
#: Phrases that a shard holds before it ends early, and bytes of counts that are summed up before they are sent.
REPORTS, COUNTED_BYTES = 4_000_000, 64 << 20
#: Bits of the filter for each candidate, and its bytes at most; a fuller one lets more through.
FILTER_BITS, FILTER_BYTES = 16, 16 << 20

#: One byte that no UTF-8 text has stands for the ends of pieces.
_END = b"\xff"
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else 0xFF if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else b for b in range(256)
)


def bar_of(support: int, size: int, total: int) -> int:
    """Occurrences that make a phrase frequent in ``size`` of ``total`` bytes."""
    return max(1, -(-support * size // max(total, 1)))


class Slice:
    """Texts of one language in a task: word numbers in a row, 0 between pieces."""

    def __init__(self, lang: str, total: int):
        self.lang, self.total, self.bytes = lang, total, 0
        numbers = count(1)
        self.number: defaultdict[bytes, int] = defaultdict(numbers.__next__)
        self.number[_END] = 0
        self.parts: list[np.ndarray] = []

    def add(self, texts: list[bytes]) -> None:
        self.bytes += sum(map(len, texts))
        plain, a = (_END.join(texts) + _END).translate(_TABLE), 0
        while a < len(plain):  # long texts are cut into words part by part, between words
            b = plain.find(b" ", a + CUT_BYTES)
            b = len(plain) if b < 0 else b
            words = plain[a:b].replace(_END, b" \xff ").split()
            self.parts.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
            a = b

    def close(self) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The numbers in a row, and the hash and the text of each number; the slice is emptied."""
        hashes = word_hashes(self.lang, self.number)
        words = pa.array(list(self.number), pa.binary())  # the end of a piece first, as it was numbered first
        self.number.clear()
        ids, self.parts = np.concatenate(self.parts), []
        return ids, hashes, words

    def bar(self, support: int) -> int:
        return bar_of(support, self.bytes, self.total)


def word_hashes(lang: str, words: Iterable[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64)


def phrases(ids: np.ndarray, hashes: np.ndarray, longest: int, keep: Callable) -> Iterator[tuple]:
    """``k, first, hashes, counts`` of the kept phrases of k words, for k from 1 on.

    ``keep(hashes, counts)`` tells which of some phrases go on; a phrase is looked at only where the
    two shorter ones in it were kept.
    """
    size = len(hashes)
    first = np.zeros(size, np.int64)
    first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
    counts = np.bincount(ids, minlength=size)
    kept = keep(hashes, counts) & (counts > 0)
    kept[0] = False
    yield 1, first[kept], hashes[kept], counts[kept]
    alive, gram, own = kept[ids], ids, hashes
    with np.errstate(over="ignore"):
        for k in range(1, longest):
            at = np.flatnonzero(alive[:-1] & alive[1:]).astype(np.int32)
            if not len(at):
                return
            alive, longer, made, size_now = np.zeros(len(ids), bool), np.zeros(len(ids), np.int32), [], 0
            parts = len(at) // PART + 1
            for part in range(parts):  # pairs with one shorter phrase meet in one part
                here = at[gram[at] % parts == part] if parts > 1 else at
                code, pairs = pd.factorize(gram[here].astype(np.int64) * size + ids[here + k])
                counts = np.bincount(code, minlength=len(pairs))
                mine = mixed(mixed(own[pairs // size] + np.uint64(0x9E3779B97F4A7C15)) + hashes[pairs % size])
                kept = keep(mine, counts)
                first = np.zeros(len(pairs), np.int64)
                first[code[::-1]] = here[::-1]
                made.append((first[kept], mine[kept], counts[kept]))
                near = kept[code]
                alive[here[near]] = True
                longer[here[near]] = (np.cumsum(kept) - 1 + size_now)[code[near]]
                size_now += len(made[-1][0])
            first, own, counts = (np.concatenate(x) for x in zip(*made, strict=True))
            yield k + 1, first, own, counts
            gram = longer


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[Slice]]:
    """The task's rows as slices of at most ``most`` bytes (or one longer text), by language."""
    held: dict[str, Slice] = {}
    size = 0
    for batch in chunks(batches, "text", 4 << 20):
        texts, langs = texts_of(batch, "text"), batch.column("lang").to_pylist()
        by_lang: dict[str, list[bytes]] = defaultdict(list)
        for lang, text in zip(langs, texts, strict=True):
            by_lang[lang].append(text)
        totals = dict(zip(langs, batch.column("total").to_pylist(), strict=True))
        more = sum(map(len, texts))
        if size and size + more > most:
            yield list(held.values())
            held, size = {}, 0
            pa.default_memory_pool().release_unused()
        size += more
        for lang, own in by_lang.items():
            if lang not in held:
                held[lang] = Slice(lang, totals[lang])
            held[lang].add(own)
    if held:
        yield list(held.values())


_REPORT = "lang string, h long, c long, slack long"


class Reports:
    """What the slices of a shard report of one language."""

    def __init__(self) -> None:
        self.bytes = self.words = self.slack = self.total = 0
        self.h, self.c, self.reported = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slice: Slice, support: int, longest: int) -> None:
        bar = slice.bar(support)
        ids, hashes, _ = slice.close()
        found = list(phrases(ids, hashes, longest, lambda h, c: c >= bar))
        self.bytes, self.total = self.bytes + slice.bytes, slice.total
        self.words, self.slack = self.words + int((ids > 0).sum()), self.slack + bar - 1
        h = np.concatenate([self.h, *(x[2].view(np.int64) for x in found)])
        c = np.concatenate([self.c, *(x[3].astype(np.int64) for x in found)])
        reported = np.concatenate([self.reported, np.full(len(h) - len(self.h), bar - 1)])
        order = np.argsort(h, kind="stable")
        starts = np.flatnonzero(np.diff(h[order], prepend=h[order[:1]] - 1))
        self.h = h[order][starts]
        if len(starts):
            self.c, self.reported = np.add.reduceat(c[order], starts), np.add.reduceat(reported[order], starts)

    def rows(self, lang: str, support: int) -> Iterator[pa.RecordBatch]:
        """The phrases that may be frequent in the shard, by the most they can count there; the shard itself."""
        bar = bar_of(support, self.bytes, self.total)
        most = self.c + self.slack - self.reported
        kept = most >= bar
        h, most = self.h[kept], most[kept]
        for k in range(0, len(h), 100_000):
            own = pa.array(h[k : k + 100_000]), pa.array(most[k : k + 100_000])
            n = len(own[0])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), *own, pa.array(np.full(n, bar - 1))], ["lang", "h", "c", "slack"])
        told = zip([[lang], [None], [self.words], [bar - 1]], (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in told], ["lang", "h", "c", "slack"])


def _mine(support: int, longest: int, most: int):
    """Pass one: by hash the phrases that are frequent in a shard, and one row without hash for the shard itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, Reports] = defaultdict(Reports)
        for slices in _slices(batches, most):
            for slice in slices:
                held[slice.lang].add(slice, support, longest)
            if sum(len(x.h) for x in held.values()) > REPORTS:
                for lang, reports in held.items():
                    yield from reports.rows(lang, support)
                held.clear()
        for lang, reports in held.items():
            yield from reports.rows(lang, support)

    return run


def _mask(h: np.ndarray) -> np.ndarray:
    bits = [(h >> np.uint64(6 * k)) & np.uint64(63) for k in range(4)]
    return np.bitwise_or.reduce([np.uint64(1) << b for b in bits])


def bit_filter(candidates: DataFrame, n: int) -> np.ndarray:
    """The filter of the candidates' hashes ``h``: four bits in one of its 64-bit blocks each.

    Blocks are joined on the cluster; at most ``FILTER_BYTES`` come to the driver.
    """
    blocks = 1 << max(4, min((max(n, 1) * FILTER_BITS // 64).bit_length(), (FILTER_BYTES // 8).bit_length() - 1))
    bits = " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned(h, {6 * k}) & 63 AS INT))" for k in range(4))
    joined = candidates.select(F.expr(f"shiftrightunsigned(h, 32) & {blocks - 1}").alias("block"), F.expr(bits).alias("mask"))
    rows = joined.groupBy("block").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(blocks, np.uint64)
    out[rows.column("block").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return out


def _count(sent, longest: int, most: int):
    """Pass two: the counts of all phrases that the filter lets through, summed up over a task's slices."""

    def counted(slice: Slice, listed: Callable) -> Iterator[pa.Table]:
        ids, hashes, words = slice.close()
        for k, first, _, counts in phrases(ids, hashes, longest, listed):
            said = words.take(pa.array(ids[first]))
            for j in range(1, k):
                said = pc.binary_join_element_wise(said, words.take(pa.array(ids[first + j])), b" ")
            lang = pa.array([slice.lang]).take(pa.array(np.zeros(len(first), np.int32)))
            length, a = pa.array(np.full(len(first), k, np.int32)), pa.array(counts.astype(np.int64))
            yield pa.table([lang, said.cast(pa.string()), length, a], ["lang", "phrase", "k", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sent.value

        def listed(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
            mask = _mask(h)
            return blocks[((h >> np.uint64(32)) & np.uint64(len(blocks) - 1)).astype(np.int64)] & mask == mask

        held: list[pa.Table] = []
        for slices in _slices(batches, most):
            for slice in slices:
                held += counted(slice, listed)
            summed = pa.concat_tables(held).group_by(["lang", "phrase", "k"]).aggregate([("a", "sum")])
            held = [summed.select(["lang", "phrase", "k", "a_sum"]).rename_columns(["lang", "phrase", "k", "a"])]
            if held[0].nbytes > COUNTED_BYTES:
                yield from held.pop().to_batches(100_000)
        for rest in held:
            yield from rest.to_batches(100_000)

    return run


def frequent_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", support: int = SUPPORT, longest: int = LONGEST, slice_bytes: int = SLICE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, a`` of all phrases of up to ``longest`` words with ``support`` or more
    occurrences in their language, and ``lang, n``: the words of each language."""
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    totals = materialize(source.groupBy("lang").agg(F.sum(F.octet_length("text")).cast("long").alias("total")), "language-bytes")
    size = totals.agg(F.sum("total")).first()[0] or 0
    source = join_bounded(source, totals, ["lang"]).select("lang", "text", "total")

    # small partitions are read together, as long as all cores have work
    shards = source.coalesce(max(spark.sparkContext.defaultParallelism, -(-size // SHARD_BYTES)))
    reports = materialize(shards.mapInArrow(_mine(support, longest, slice_bytes), _REPORT), "local-phrases")
    told = reports.where(F.col("h").isNull()).groupBy("lang").agg(F.sum("c").alias("n"), F.sum("slack").alias("all_slack"))
    told = materialize(told, "language-words")
    bound = reports.where(F.col("h").isNotNull()).groupBy("lang", "h").agg(F.sum("c").alias("c"), F.sum("slack").alias("slack"))
    bound = join_bounded(bound, told.select("lang", "all_slack"), ["lang"])
    candidates = materialize(bound.where(F.col("c") + F.col("all_slack") - F.col("slack") >= support).select("h"), "candidates")
    sent = spark.sparkContext.broadcast(bit_filter(candidates, candidates.count()))
    counted = shards.mapInArrow(_count(sent, longest, slice_bytes), "lang string, phrase string, k int, a long")
    counted = counted.groupBy("lang", "phrase", "k").agg(F.sum("a").alias("a")).where(F.col("a") >= support)
    return materialize(counted, "frequent-phrases"), told.select("lang", "n")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    support: int = SUPPORT,
    longest: int = LONGEST,
    covered: int = COVERED,
    top: int = TOP,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of 2 to ``longest`` words with ``a >= support`` is cut in two where its score
    ``floor(1000 * a * n / (l * r))`` is lowest, the first such place. One that lies in a longer phrase
    with ``100 * f(longer) >= covered * a`` is left out. Phrases go by falling score, falling ``a``,
    rising bytes. A NULL language is ``und``, a NULL text empty; a text of any length is read whole;
    repeated rows count each; an empty table gives no rows. Other columns are not read.
    """
    found, words = frequent_phrases(docs, lang, text, support, longest, slice_bytes)
    long = found.where("k > 1").withColumn("w", F.split("phrase", " "))
    said = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = long.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", said(1, F.col("cut")).alias("left"), said(F.col("cut") + 1, F.col("k")).alias("right"))
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    cuts = join_bounded(cuts, words, ["lang"])
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"({wide('a')} * {wide('n')} * CAST(1000 AS DECIMAL(4, 0))) DIV ({wide('l')} * {wide('r')})")
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "cut", "a", "l", "r", "n")).alias("best"))
    best = best.select("lang", "phrase", "best.*")
    # what covers a phrase covers it with one more word already, as counts fall with length
    longer = long.where("k > 2").withColumn("part", F.explode(F.array(said(1, F.col("k") - 1), said(2, F.col("k") - 1))))
    longer = longer.groupBy("lang", F.col("part").alias("phrase")).agg(F.max("a").alias("longer"))
    left = best.join(longer, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {int(covered)} * a")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the first of each of some parts of a language, then the first of all
    dealt = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    dealt = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
