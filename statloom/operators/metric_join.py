"""Similarity join of names as a metric join.

A score of t means a distance: with n and m letters and a longest common subsequence of s letters, the
insertions and deletions that turn one name into the other are d = n + m - 2 s, and the score reaches t
only if d <= (1 - t)(n + m). That distance is a metric, so for any pivot name p the distances to p of
two names differ by d at most. Each name carries its distances to a set of pivots, which grows with
the square root of the names. In a block of names a list per pivot is sorted by distance; a name of
the other side takes the list in which fewest lie within its reach, holds them against its other
pivots, and only what is left is scored. The empty name is one of the pivots, which bounds lengths.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.similarity import common_length, pair_scores

#: Names of the two sides that meet in one group.
LEFT_BLOCK, RIGHT_BLOCK = 2_000, 8_000
#: Pivots at least and at most, and their letters at most (bits of a word) while shorter names exist.
LEAST_PIVOTS, MOST_PIVOTS, PIVOT_LETTERS = 8, 512, 63
#: A name's pivots by how few names they leave, as they are tried one step after the other, and pairs
#: that are scored at once. What further pivots would still drop costs more than its score.
PIVOT_STEPS, SCORED = ((0, 6), (6, 18), (18, 40), (40, 96)), 200_000


class Part(NamedTuple):
    """Names of ``low`` to ``high`` letters, dealt over ``parts`` blocks numbered from ``first``."""

    low: int
    high: int
    parts: int
    first: int


def parts_of(lengths: dict[int, int], block: int) -> list[Part]:
    """Runs of lengths with about ``block`` names each; a crowded length has several blocks."""
    out: list[Part] = []
    low, held, first = None, 0, 0
    for n in sorted(lengths):
        low = n if low is None else low
        held += lengths[n]
        if held >= block or n == max(lengths):
            parts = -(-held // block)
            out.append(Part(low, n, parts, first))
            low, held, first = None, 0, first + parts
    return out


def reach(n: int | np.ndarray, m: int | np.ndarray, share: float):
    """Distance up to which two names of these lengths may reach the score."""
    return (n + m) * (1.0 - share) + 1e-9


def may_meet(a: Part, b: Part, share: float) -> bool:
    """Whether any lengths of the two runs are near enough."""
    gap = max(a.low - b.high, b.low - a.high, 0)
    if not gap:
        return True
    n, m = (a.low, b.high) if a.low > b.high else (a.high, b.low)
    return gap <= reach(n, m, share)


def distances(pivots: list[str], texts: list[str]) -> np.ndarray:
    """Insertions and deletions between each text and each pivot, all texts in one step per letter."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), len(pivots)), np.uint16)
    longest = max(int(lengths.max()), 1)
    codes = np.array(texts, dtype=f"<U{longest}").view(np.uint32).reshape(len(texts), longest)
    letters, place = np.unique(codes, return_inverse=True)
    place = place.reshape(codes.shape)
    where = {chr(c): k for k, c in enumerate(letters.tolist()) if c}
    one = np.uint64(1)
    for j, pivot in enumerate(pivots):
        if len(pivot) > PIVOT_LETTERS:
            common = np.array([common_length(pivot, t) for t in texts])
        else:
            masks = np.zeros(len(letters), np.uint64)
            for i, ch in enumerate(pivot):
                if ch in where:
                    masks[where[ch]] |= one << np.uint64(i)
            full = np.uint64((1 << len(pivot)) - 1)
            rest = np.full(len(texts), full)
            for k in range(longest):
                met = rest & masks[place[:, k]]
                rest = (rest + met) | (rest - met)
            common = len(pivot) - np.bitwise_count(rest & full).astype(np.int64)
        out[:, j] = np.minimum(len(pivot) + lengths - 2 * common, 0xFFFF)
    return out


def _blocks(pivots: list[str], mine: list[Part], others: list[list[int]], stride: int, left: bool):
    """Each name with its distances, once for every block of the other side that it may meet."""
    highs = np.array([p.high for p in mine])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1_000):
                texts = batch.column("text").slice(a, 1_000).to_pylist()
                own = distances(pivots, texts).astype("<u2")
                keys, rows = [], []
                for i, (t, k) in enumerate(zip(texts, np.searchsorted(highs, [len(t) for t in texts]).tolist(), strict=True)):
                    part = mine[k]
                    block = part.first + xxhash.xxh64_intdigest(t) % part.parts
                    meets = others[k]
                    keys += [block * stride + o if left else o * stride + block for o in meets]
                    rows += [i] * len(meets)
                if not rows:
                    continue
                taken = pa.array(rows, pa.int64())
                vectors = pa.array([v.tobytes() for v in own], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(texts, pa.string()).take(taken), vectors.take(taken)], ["key", "text", "v"]
                )

    return run


def near_pairs(xs: list[str], ys: list[str], x_far: np.ndarray, y_far: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that no pivot keeps apart, in portions; ``x_far`` and ``y_far`` hold the distances."""
    n, m = (np.array([len(t) for t in side], np.int64) for side in (xs, ys))
    x_far, y_far = (np.column_stack([own, far]).clip(max=0x7FFF).astype(np.int16) for own, far in ((n, x_far), (m, y_far)))
    top, pivots = int(max(x_far.max(), y_far.max())), np.arange(x_far.shape[1])
    upto = np.zeros((len(pivots), top + 2), np.int64)
    for j in pivots:
        upto[j, 1:] = np.cumsum(np.bincount(y_far[:, j], minlength=top + 1))
    order = np.argsort(y_far, axis=0, kind="stable")
    found_x, found_y, held = [], [], 0
    for i in range(len(xs)):
        most = min(int(m.max()), int(n[i] * (2 - share) / share + 1e-9))
        far = int(reach(int(n[i]), most, share))
        own = x_far[i].astype(np.int64)
        low, high = np.maximum(own - far, 0), np.minimum(own + far, top) + 1
        low = np.minimum(low, high)
        inside = upto[pivots, high] - upto[pivots, low]
        j = int(np.argmin(inside))
        near = order[upto[j, low[j]] : upto[j, high[j]], j]
        if not len(near):
            continue
        allowed = np.minimum(reach(n[i], m[near], share), 0x7FFF).astype(np.int16)[:, None]
        few = np.argsort(inside, kind="stable")
        for a, b in PIVOT_STEPS:
            some = few[a:b]
            stay = (np.abs(y_far[near[:, None], some] - x_far[i, some]) <= allowed).all(axis=1)
            near, allowed = near[stay], allowed[stay]
            if not len(near):
                break
        found_x.append(np.full(len(near), i)), found_y.append(near)
        held += len(near)
        if held >= SCORED:
            yield np.concatenate(found_x), np.concatenate(found_y)
            found_x, found_y, held = [], [], 0
    if held:
        yield np.concatenate(found_x), np.concatenate(found_y)


def _scored(threshold: int, share: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        if left.num_rows and right.num_rows:
            xs, ys = (side.column("text").to_pylist() for side in (left, right))
            far = [np.frombuffer(b"".join(side.column("v").to_pylist()), "<u2").reshape(side.num_rows, -1) for side in (left, right)]
            for i, k in near_pairs(xs, ys, *far, share):
                x, y = pd.Series([xs[r] for r in i]), pd.Series([ys[r] for r in k])
                score = pair_scores(x, y).to_numpy()
                good = score >= threshold
                made.append(pa.table([pa.array(x[good], pa.string()), pa.array(y[good], pa.string()), pa.array(score[good], pa.int32())], ["l_text", "r_text", "score"]))
        schema = pa.schema([("l_text", pa.string()), ("r_text", pa.string()), ("score", pa.int32())])
        return pa.concat_tables([schema.empty_table(), *made]).combine_chunks()

    return run


def similar_pairs(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """All pairs of prepared texts that score at least ``threshold``: ``l_text, r_text, score``.

    Both sides are written tables with a column ``text`` of distinct, non-empty, prepared names. Only
    the numbers of names per length and the pivots come to the driver. Names are grouped by length and
    then dealt, so that a group holds at most about ``LEFT_BLOCK`` and ``RIGHT_BLOCK`` names.
    """
    if not 1 <= threshold <= 100:
        raise ValueError("threshold must be between 1 and 100")
    # the score is rounded, so anything from half a point below may reach the threshold
    share = max(threshold - 0.5, 1.0) / 100.0
    sides = left.select("text", F.lit(True).alias("l")).unionByName(right.select("text", F.lit(False).alias("l")))
    counted = sides.groupBy("l", F.length("text").alias("n")).agg(F.count(F.lit(1)).alias("c")).collect()
    lengths = [{r.n: r.c for r in counted if r.l is side} for side in (True, False)]
    if not all(lengths):
        return left.select(F.col("text").alias("l_text"), F.lit(None).cast("string").alias("r_text"), F.lit(0).alias("score")).limit(0)
    mine, theirs = parts_of(lengths[0], LEFT_BLOCK), parts_of(lengths[1], RIGHT_BLOCK)
    some = min(max(LEAST_PIVOTS, int(2 * math.sqrt(sum(lengths[1].values())))), MOST_PIVOTS)
    short_first = [F.length("text") > PIVOT_LETTERS, F.xxhash64("text"), F.col("text")]
    pivots = [r.text for r in right.select("text").orderBy(*short_first).limit(some).collect()]
    blocks = lambda p: range(p.first, p.first + p.parts)
    meets_l = [[o for b in theirs if may_meet(a, b, share) for o in blocks(b)] for a in mine]
    meets_r = [[o for a in mine if may_meet(a, b, share) for o in blocks(a)] for b in theirs]
    stride = theirs[-1].first + theirs[-1].parts
    schema = "key long, text string, v binary"
    l_side = left.select("text").mapInArrow(_blocks(pivots, mine, meets_l, stride, True), schema)
    r_side = right.select("text").mapInArrow(_blocks(pivots, theirs, meets_r, stride, False), schema)
    met = l_side.groupBy("key").cogroup(r_side.groupBy("key"))
    return met.applyInArrow(_scored(threshold, share), "l_text string, r_text string, score int")
