"""K-means for many cluster counts and starts at once.

Every pass over the data serves all models: seeding takes one pass per centre, each later pass
moves the centres of every model that is still changing. Tasks reduce their rows to one partial
sum per centre; only these are shuffled, and the driver holds the centres alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from statloom.storage import materialize

#: Rows whose distances to all centres a task holds at once; parts of the rows per core.
SLICE, PARTS = 1024, 2


@dataclass
class Clusters:
    """Centres of one model, the rows of each and the within-cluster sum of squares."""

    centres: np.ndarray
    sizes: np.ndarray
    cost: float


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as the bytes of their numbers, which a pass reads faster than lists."""
    for batch in batches:
        x = batch.column("x")
        values = np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False))
        ends = np.linspace(0, values.nbytes, len(x) + 1).astype(np.int32)
        made = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(values)])
        yield pa.RecordBatch.from_arrays([made, batch.column("digest")], ["x", "digest"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x").cast(pa.binary())
    ends = np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1]
    return np.frombuffer(x.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(float).reshape(len(x), -1)


def _squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2.0 * x @ centres.T + (centres * centres).sum(1)
    return np.maximum(d, 0.0)


def _least(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Over the second of three axes: the least value, and where it stands first."""
    value, label = block[:, 0].copy(), np.zeros((len(block), block.shape[2]), np.int64)
    for k in range(1, block.shape[1]):
        np.copyto(label, k, where=block[:, k] < value)
        np.minimum(value, block[:, k], out=value)
    return value, label


def _uniform(digest: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the row and the salt only, so a repeated task agrees."""
    with np.errstate(over="ignore"):
        z = digest.astype(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _seed_pass(rows: DataFrame, chains: list[np.ndarray], seed: int) -> list[np.ndarray]:
    """The next centre of every chain, drawn in proportion to the squared distance to the last
    ones: the row with the largest log(u) / distance wins, in every task and over all tasks."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[float, np.ndarray | None]] = [(-np.inf, None)] * len(chains)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, digest = _matrix(batch), batch.column("digest").to_numpy()
            for c, chain in enumerate(chains):
                weight = _squared_distances(x, chain).min(1) if len(chain) else np.ones(len(x))
                salt = (seed * 1009 + c) * 1009 + len(chain) + 1
                with np.errstate(divide="ignore"):
                    key = np.log(_uniform(digest, salt)) / weight
                top = int(key.argmax())
                if key[top] > best[c][0]:
                    best[c] = (float(key[top]), x[top])
        found = [(c, key, list(row)) for c, (key, row) in enumerate(best) if row is not None]
        yield pa.RecordBatch.from_pydict(
            {
                "chain": pa.array([f[0] for f in found], pa.int32()),
                "key": pa.array([f[1] for f in found], pa.float64()),
                "x": pa.array([f[2] for f in found], pa.list_(pa.float64())),
            }
        )

    drawn = rows.mapInArrow(draw, "chain int, key double, x array<double>")
    picked = drawn.groupBy("chain").agg(F.max_by("x", "key").alias("x")).collect()
    new = {r.chain: np.array(r.x) for r in picked}
    return [
        np.vstack([chain, new[c]]) if c in new else chain for c, chain in enumerate(chains)
    ]


def _tally(rows: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per model: rows and vector sum of each centre, and the cost."""
    centres = np.vstack(models)
    offsets = np.cumsum([0] + [len(m) for m in models])
    width = centres.shape[1] + 2
    # models in a row with equally many centres are looked at side by side
    alike = [(size, len(list(some))) for size, some in groupby(len(m) for m in models)]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centres), np.zeros(len(centres), np.int64)
        costs = np.zeros(len(centres))
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                x = _matrix(batch.slice(start, SLICE))
                distance = _squared_distances(centres, x)
                hit, at = np.zeros_like(distance), 0
                for size, n in alike:
                    block = distance[at : at + size * n].reshape(n, size, len(x))
                    cost, label = _least(block)
                    slot = label + (at + size * np.arange(n))[:, None]
                    hit[slot, np.arange(len(x))] = 1.0
                    counts += np.bincount(slot.ravel(), minlength=len(centres))
                    costs += np.bincount(slot.ravel(), cost.ravel(), len(centres))
                    at += size * n
                sums += hit @ x
        used = np.flatnonzero(counts)
        slots = used[:, None] * width + np.arange(width)
        filled = np.column_stack([sums, counts, costs])[used]
        yield pa.RecordBatch.from_pydict(
            {"slot": pa.array(slots.ravel(), pa.int64()), "value": pa.array(filled.ravel())}
        )

    # one slot per centre and dimension, then its row count and its cost
    partial = rows.mapInArrow(add_up, "slot bigint, value double")
    total = partial.groupBy("slot").agg(F.sum("value").alias("value")).toPandas()
    table = np.zeros(len(centres) * width)
    table[total["slot"].to_numpy()] = total["value"].to_numpy()
    table = table.reshape(len(centres), width)
    sums, counts, costs = table[:, :-2], table[:, -2].astype(np.int64), table[:, -1]
    return [
        (sums[a:b], counts[a:b], float(costs[a:b].sum())) for a, b in zip(offsets[:-1], offsets[1:])
    ]


def fit_kmeans(
    vectors: DataFrame,
    ks: list[int],
    starts: int = 10,
    seed: int = 42,
    max_iter: int = 300,
    tolerance: float = 1e-4,
    column: str = "features",
    first: np.ndarray | None = None,
) -> dict[int, Clusters]:
    """The cheapest model of several starts for every number of clusters.

    With ``first`` nothing is drawn: a model of k clusters starts from the first k of these centres.
    The rows are written once, as every pass reads them, in equal parts for all cores. Iteration of a model ends when its centres move less than ``tolerance`` times the mean
    variance of the data. A centre without rows stays where it is.
    """
    x = vector_to_array(column)
    rows = vectors.select(x.alias("x"), F.xxhash64(x).alias("digest"))
    rows = rows.mapInArrow(_packed, "x binary, digest long")
    rows = materialize(rows.repartition(PARTS * vectors.sparkSession.sparkContext.defaultParallelism), "kmeans")
    if first is not None:
        chains = [np.asarray(first, float)]
    else:
        chains = [np.empty((0, len(rows.first().x) // 8))] * starts
        for _ in range(max(ks)):
            chains = _seed_pass(rows, chains, seed)
    models = [chain[:k].copy() for k in ks for chain in chains]
    names = [k for k in ks for _ in chains]
    # the spread of the data is the cost of a single cluster, per value
    spread = _tally(rows, [chains[0][:1] * 0.0])[0]
    size = max(int(spread[1][0]), 1)
    variance = max(spread[2] / size - float(((spread[0][0] / size) ** 2).sum()), 0.0)
    least = tolerance * variance / max(models[0].shape[1], 1)

    moving = list(range(len(models)))
    for _ in range(max_iter):
        still = []
        for i, (sums, counts, _) in zip(moving, _tally(rows, [models[i] for i in moving])):
            moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], models[i])
            if float(((moved - models[i]) ** 2).sum()) > least:
                still.append(i)
            models[i] = moved
        moving = still
        if not moving:
            break
    best: dict[int, Clusters] = {}
    for k, model, (_, counts, cost) in zip(names, models, _tally(rows, models)):
        if k not in best or cost < best[k].cost:
            best[k] = Clusters(model, counts, cost)
    return best


def nearest_centre(vector: Column, centres: np.ndarray) -> Column:
    """Index of the nearest centre of a vector column."""

    def label(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="int32")
        return pd.Series(_squared_distances(np.vstack(x), centres).argmin(1).astype("int32"))

    return F.pandas_udf(label, IntegerType())(vector_to_array(vector))
