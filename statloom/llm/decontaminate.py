"""Benchmark decontamination with an FM-index per training shard.

The texts of one step of a task form a shard. Its words become numbers (words that no benchmark item
has are separators, and stretches too short for the shortest window are left out, as no window can
lie in them). Over this sequence an FM-index is built: suffix order, Burrows-Wheeler transform, a
wavelet matrix for ranks, and the suffix positions of every eighth place. All windows of all items
are searched backwards at once; occurrences are located by walking to the next sampled place.

Benchmark items are sent to the tasks in blocks of bounded size; with more than one block the
documents are passed once for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import chunks, ragged, texts_of
from statloom.storage import materialize

WINDOW = 10
#: Text of the benchmark items that are searched for in one pass over the documents, in bytes.
ITEM_BLOCK = 4 << 20
#: Every so many places the index keeps the position of its suffix.
SAMPLE = 8

_WORDS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def bench_words(text: bytes) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z."""
    return text.translate(_WORDS).split()


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last code point of each word."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], np.frombuffer(text.translate(_WORDS), np.uint8) != 0x20, [False]])
    point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return point[np.flatnonzero(inside[1:] & ~inside[:-1])], point[np.flatnonzero(~inside[1:] & inside[:-1])]


class Phrases:
    """The distinct windows of a block of items, as word numbers from 1, grouped by length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = bench_words(text)
            numbers = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                found.setdefault(tuple(numbers[i : i + size]), set()).add(item)
        self.shortest = min(map(len, found), default=0)
        self.groups = []
        for size in sorted({len(w) for w in found}):
            own = [(w, sorted(items_)) for w, items_ in found.items() if len(w) == size]
            self.groups.append((np.array([w for w, _ in own], np.int32), [x for _, x in own]))


class FmIndex:
    """Backward search over a sequence of numbers in which 0 separates; its last entry is 0."""

    def __init__(self, sequence: np.ndarray, sample: int = SAMPLE):
        n = len(sequence)
        order = self._suffixes(sequence)
        self.before = sequence[order - 1]  # the transform; position -1 is the closing separator
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=int(sequence.max()) + 2))])
        kept = (order % sample == 0) | (self.before == 0)  # walks end at separators at the latest
        self.kept, self.kept_upto, self.kept_at = kept, np.cumsum(kept) - kept, order[kept]
        self.levels = []  # wavelet matrix: per bit, the ones before each place, and the zeros in all
        rest = self.before
        for level in reversed(range(max(1, int(sequence.max()).bit_length()))):
            bit = (rest >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int32)
            self.levels.append((level, ones, n - int(ones[-1])))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])

    @staticmethod
    def _suffixes(sequence: np.ndarray) -> np.ndarray:
        """Order of all suffixes, by prefix doubling; each separator is a letter of its own."""
        n, zero = len(sequence), sequence == 0
        rank = np.where(zero, np.cumsum(zero) - 1, sequence.astype(np.int64) + int(zero.sum()))
        width = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:] + 1 if width < n else 0
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                return order
            width *= 2

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        start, place = np.zeros_like(place), place.copy()
        for level, ones, zeros in self.levels:
            one = (symbol >> level) & 1 == 1
            start = np.where(one, zeros + ones[start], start - ones[start])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return place - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``phrases`` that occur, and the bounds of their suffixes."""
        which = np.arange(len(phrases))
        phrases = phrases.astype(np.int64)
        known = (phrases < len(self.first) - 1).all(axis=1)
        which = which[known]
        low, high = np.zeros(len(which), np.int64), np.full(len(which), len(self.before), np.int64)
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[which, column]
            low = self.first[symbol] + self.rank(symbol, low)
            high = self.first[symbol] + self.rank(symbol, high)
            some = low < high
            which, low, high = which[some], low[some], high[some]
        return which, low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions in the sequence of these suffixes."""
        row, steps, open_ = row.copy(), np.zeros(len(row), np.int64), np.arange(len(row))
        while len(open_):
            open_ = open_[~self.kept[row[open_]]]
            symbol = self.before[row[open_]].astype(np.int64)
            row[open_] = self.first[symbol] + self.rank(symbol, row[open_])
            steps[open_] += 1
        return self.kept_at[self.kept_upto[row]] + steps


def occurrences(numbers: np.ndarray, phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, int, list[list[str]]]]:
    """Per window length: window and place of each occurrence in ``numbers`` (0 is no window's word)."""
    inside = np.concatenate([[False], numbers != 0, [False]])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    long = ends - starts >= max(phrases.shortest, 1)
    starts, ends = starts[long], ends[long]
    if not len(starts) or not phrases.groups:
        return
    place = ragged(starts, ends - starts + 1)  # each stretch with the separator behind it
    sequence = np.where(np.isin(place, ends), 0, numbers[np.minimum(place, len(numbers) - 1)]).astype(np.int64)
    index = FmIndex(sequence)
    for windows, items in phrases.groups:
        which, low, high = index.search(windows)
        at = index.locate(ragged(low, high - low))
        yield np.repeat(which, high - low), place[at], windows.shape[1], items


def _search(text: str, items, window: int, remove: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(items.value, window)
        for batch in chunks(batches, text):
            texts = texts_of(batch, text)
            counts = np.zeros(len(texts), np.int64)
            parts, gap = [], np.zeros(1, np.int32)
            for i, t in enumerate(texts):
                words = bench_words(t)
                counts[i] = len(words)
                parts += [np.fromiter(map(phrases.number.get, words, repeat(0)), np.int32, len(words)), gap]
            numbers = np.concatenate(parts) if parts else gap
            begin = np.concatenate([[0], np.cumsum(counts + 1)])
            hit, found = np.zeros(len(numbers) + 1, np.int64), [set(x or ()) for x in batch.column("items").to_pylist()]
            for i, runs in enumerate(batch.column("__runs").to_pylist()):
                for run_ in runs or ():
                    hit[begin[i] + run_["a"]] += 1
                    hit[begin[i] + run_["b"]] -= 1
            for which, at, size, owners in occurrences(numbers, phrases):
                np.add.at(hit, at, 1)
                np.add.at(hit, at + size, -1)
                doc = np.searchsorted(begin, at, "right") - 1
                for i, w in set(zip(doc.tolist(), which.tolist(), strict=True)):
                    found[i].update(owners[w])
            covered = np.cumsum(hit) > 0
            runs, spans, hits = [], [], []
            for i, t in enumerate(texts):
                own = covered[begin[i] : begin[i] + counts[i]]
                if not own.any():
                    runs.append([]), spans.append([]), hits.append(0)
                    continue
                edge = np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))
                a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                first, last = word_spans(t)
                runs.append([{"a": int(x), "b": int(y)} for x, y in zip(a, b, strict=True)])
                spans.append([{"start": int(first[x]), "end": int(last[y - 1])} for x, y in zip(a, b, strict=True)])
                hits.append(int(own.sum()))
            made = {"n_words": counts, "n_hit": hits, "items": [sorted(x) for x in found], "spans": spans, "__runs": runs}
            if remove:
                made[text] = [_without(t, s) if s else t for t, s in zip(batch.column(text).to_pylist(), spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name) for f in schema], schema=schema
            )

    return run


def _without(text: str, spans: list[dict]) -> str:
    """The text without the spans."""
    starts = [0, *(s["end"] for s in spans)]
    ends = [*(s["start"] for s in spans), len(text)]
    return "".join(text[a:b] for a, b in zip(starts, ends, strict=True))


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    remove: bool = False,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """One row per input row, with ``n_words, n_hit, n_items, items, spans, contaminated``.

    A window is ``window`` consecutive words of an item, or a shorter item's words. ``items`` are
    the sorted ids (as strings) of the items with a window in the text, ``spans`` the merged ranges
    of code points (start, past the end) of the words inside any occurrence. With ``remove`` the
    text comes back without these ranges, otherwise it is left out. A NULL text has no words and
    stays NULL; items without id, text or words are ignored, repeated ones count once. Empty tables
    give no rows, or no hits. Input columns that bear an added name are replaced.
    """
    spark = docs.sparkSession
    bench = bench.select(F.col(item).cast("string").alias("i"), F.col(item_text).cast("string").alias("t")).dropna()
    total = bench.agg(F.sum(F.octet_length("t") + F.octet_length("i"))).first()[0] or 0
    blocks = max(1, -(-int(total) // item_block))
    added = ("n_words", "n_hit", "n_items", "items", "spans", "contaminated", "__runs")
    carried = [c for c in docs.columns if c.lower() not in (*added, text.lower())]
    runs = "array<struct<a:bigint,b:bigint>>"
    out = docs.select(
        *carried,
        F.col(text).cast("string").alias(text),
        F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast(runs).alias("__runs"),
    )
    plain = out.select(*carried, text).schema
    for block in range(blocks):
        mine = bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        held = [(r["i"], r["t"].encode()) for r in mine.distinct().collect()]  # about item_block bytes
        last = block == blocks - 1
        names = [*carried, *([text] if remove or not last else [])]
        fields = [f"`{c}` {plain[c].dataType.simpleString()}" for c in names]
        made = f"n_words long, n_hit long, items array<string>, spans array<struct<start:bigint,end:bigint>>, __runs {runs}"
        sent = spark.sparkContext.broadcast(held)
        schema = ", ".join([*fields, made])
        arrow = _arrow_schema(spark, schema)
        out = out.select(*carried, text, "items", "__runs").mapInArrow(_search(text, sent, window, remove and last, arrow), schema)
        if not last:
            out = materialize(out, "decontaminate")
    return out.select(
        *[c for c in out.columns if c in {*carried, text}],
        *("n_words", "n_hit"),
        F.size("items").cast("long").alias("n_items"),
        *("items", "spans"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)
