"""Near duplicates by SimHash, compared bit-sliced.

Fingerprints that differ in at most r bits agree in at least two of r + 2 bands of their bits, so
they meet under the key of that pair of bands. Under a key the fingerprints are cut into blocks, and
a block stores its bits vertically: one plane per bit position, one lane per fingerprint. A
fingerprint is compared with a whole block plane by plane; carry-save counters hold, per lane, the
number of differing bits so far, and the block is given up as soon as no lane is within the radius.
The links become components in the usual alternation of large and small stars, or in one task if
they are few.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import chunks, shuffle_partitions, texts_of
from statloom.storage import materialize

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Fingerprints of one block; under a key every pair of blocks is a group of its own.
BLOCK = 2048
#: Edges (of 16 bytes) that one task joins up; more go through rounds of stars.
TOGETHER = 100_000

_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the hashes of all word shingles, repeats included; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    hashes = np.array([digest(view[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def _fingerprints(text: str, shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            marks = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch, text)], np.uint64)
            names = [c for c in batch.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(_signed(marks))], [*names, "__fp"])

    return run


def planes_of(marks: np.ndarray) -> np.ndarray:
    """64 x words: bit b of the fingerprints of a block, one lane (bit) per fingerprint."""
    lanes = -len(marks) % 64
    bits = np.unpackbits(marks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    packed = np.packbits(np.pad(bits, ((0, 0), (0, lanes))), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")


def beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose binary count (lowest digit first) passes the radius."""
    above, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same &= counters[k]
        else:
            above |= same & counters[k]
            same &= ~counters[k]
    return above


def within(marks: np.ndarray, block: np.ndarray, radius: int) -> np.ndarray:
    """marks x block: whether each fingerprint of ``block`` lies within the radius of each mark."""
    planes = planes_of(block)
    lanes = np.zeros(planes.shape[1] * 64, np.uint8)
    lanes[: len(block)] = 1
    alive = np.repeat(np.packbits(lanes, bitorder="little").view("<u8")[None], len(marks), 0)
    counters = [np.zeros_like(alive) for _ in range(max(1, radius.bit_length()))]
    open_, result = np.arange(len(marks)), np.zeros_like(alive)
    # planes that split the block most evenly come first: they end hopeless comparisons soonest
    ones = np.bitwise_count(planes).sum(1, dtype=np.int64)
    for step, plane in enumerate(np.argsort(np.abs(2 * ones - len(block)), kind="stable")):
        wanted = -((marks[open_] >> np.uint64(plane)) & np.uint64(1)).view(np.int64)  # no or all bits
        carry = planes[plane][None] ^ wanted.view(np.uint64)[:, None]
        for counter in counters:  # adds one bit to the counts of all lanes at once
            counter ^= carry
            carry = carry & ~counter
        alive &= ~(carry | beyond(counters, radius))
        if step % 8 == 7:
            still = alive.any(axis=1)  # the other marks have no lane left in this block
            open_, alive, counters = open_[still], alive[still], [c[still] for c in counters]
            if not len(open_):
                break
    result[open_] = alive
    return np.unpackbits(result.view(np.uint8), axis=1, bitorder="little")[:, : len(block)].astype(bool)


def _roots(size: int, linked: Iterable[tuple[int, int]]) -> list[int]:
    """For each number below ``size`` the least one that the links lead to."""
    parent = list(range(size))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in linked:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(size)]


def _stars(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that span the components of the linked pairs left x right (left x left if the same)."""
    marks = np.unique(np.concatenate([left, right]))
    at, to = np.searchsorted(marks, left).tolist(), np.searchsorted(marks, right).tolist()
    linked = ((at[k + i], to[j]) for k in range(0, len(left), 256) for i, j in np.argwhere(within(left[k : k + 256], right, radius)))
    return [(int(marks[i]), int(marks[r])) for i, r in enumerate(_roots(len(marks), linked)) if r != i]


def _links(radius: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by group, so that a group is complete when the next one begins."""
        rest, found = None, []

        def compare(g: pd.DataFrame) -> None:
            marks, side = g["__fp"].to_numpy().view(np.uint64), g["side"].to_numpy()
            left, right = marks[side != 1], marks[side != 0]
            found.extend(_stars(left, right, radius))

        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if rest.empty:
                continue
            keys = rest[["band", "key", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
                compare(rest.iloc[a:b])
            rest = rest.iloc[cuts[-1] :] if len(cuts) else rest
            if found:
                pairs = np.array(found, np.uint64).view(np.int64)
                yield pd.DataFrame({"hi": pairs.max(1), "lo": pairs.min(1)})
                found.clear()
        if rest is not None and not rest.empty:
            compare(rest)
        if found:
            pairs = np.array(found, np.uint64).view(np.int64)
            yield pd.DataFrame({"hi": pairs.max(1), "lo": pairs.min(1)})

    return run


def links(marks: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(hi, lo)`` pairs of distinct fingerprints (column ``__fp``) that join all linked ones."""
    bands = radius + 2
    edges = np.linspace(0, 64, bands + 1).astype(int)
    part = [F.expr(f"shiftrightunsigned(__fp, {a}) & {(1 << int(b - a)) - 1}L") for a, b in zip(edges, edges[1:], strict=False)]
    keys = [
        F.struct(F.lit(n).alias("band"), F.shiftleft(part[i], 64 // 2).bitwiseOR(part[j]).alias("key"))
        for n, (i, j) in enumerate(combinations(range(bands), 2))
    ]
    keyed = marks.select("__fp", F.inline(F.array(*keys)))
    # a key that only one fingerprint has links nothing; a large one is cut into blocks
    counts = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = materialize(counts, "simhash-keys")
    met = keyed.join(counts, ["band", "key"])
    cut = met.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("__fp"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    pairs = cut.select(
        "band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "__fp"
    )
    group = ["band", "key", "i", "j"]
    # a fixed number of tasks: the rows are few bytes, the comparisons many
    sorted_pairs = pairs.repartition(shuffle_partitions(marks.sparkSession), *group).sortWithinPartitions(*group)
    return sorted_pairs.mapInPandas(_links(radius), "hi long, lo long").distinct()


def _joined_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The result of :func:`components` for the edges of one task."""
    frame = pd.concat([*frames, pd.DataFrame({"hi": [], "lo": []}, dtype="int64")], ignore_index=True)
    nodes, number = np.unique(frame[["hi", "lo"]].to_numpy("int64").ravel(), return_inverse=True)
    root = np.array(_roots(len(nodes), number.reshape(-1, 2).tolist()), np.int64)
    other = np.flatnonzero(root != np.arange(len(nodes)))
    yield pd.DataFrame({"hi": nodes[other], "lo": nodes[root[other]]})


def components(edges: DataFrame, together: int = TOGETHER) -> DataFrame:
    """``(hi, lo)``: every node of ``edges`` that is not the least of its component, with the least.

    Up to ``together`` edges are joined up by one task; the rounds of more take some ten jobs each,
    whose tasks would have next to nothing to do.
    """

    def seal(df: DataFrame) -> tuple[DataFrame, tuple]:
        kept = materialize(df, "simhash-stars")
        return kept, tuple(kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    edges, state = seal(edges)
    if state[0] <= together:
        return edges.coalesce(1).mapInPandas(_joined_up, "hi long, lo long")
    while state[0]:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = materialize(both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m")), "simhash-least")
        large = both.join(least, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = materialize(large.where("hi <> lo").distinct(), "simhash-large")
        least = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "simhash-least")
        small = large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        edges, after = seal(small.unionByName(least.withColumnRenamed("m", "lo")).distinct())
        if after == state:
            break
        state = after
    return edges


def simhash_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED
) -> DataFrame:
    """One row per input row: its columns but the text, ``fingerprint`` and ``component_id``.

    ``fingerprint`` has 16 hexadecimal digits; ``component_id`` is the smallest id whose fingerprint
    is reachable over links of at most ``radius`` differing bits. NULL and empty texts have
    fingerprint zero and are linked like any other. A NULL id is never the smallest; a component
    without any id has NULL. Equal rows stay apart and get equal results; an empty table gives an
    empty result. Input columns that bear an added name are replaced.
    """
    added = {"fingerprint", "component_id", "__fp", "__text"}
    carried = [c for c in docs.columns if c.lower() not in added | {text.lower()}]
    source = docs.select(*carried, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("__text").schema)
    marked = materialize(
        source.mapInArrow(_fingerprints("__text", shingle, seed), f"{schema}{', ' if carried else ''}__fp long"), "simhash-marks"
    )
    marks = materialize(marked.groupBy("__fp").agg(F.min(id).alias("least_id")), "simhash-distinct")
    stars = components(links(marks, radius))
    rooted = marks.join(stars, marks["__fp"] == stars["hi"], "left").select(
        "__fp", "least_id", F.coalesce("lo", "__fp").alias("root")
    )
    rooted = materialize(rooted, "simhash-roots")
    least = materialize(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-ids")
    named = materialize(rooted.join(least, "root").select("__fp", "component_id"), "simhash-names")
    digits = F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint")
    return marked.join(named, "__fp").select(*carried, digits, "component_id")
