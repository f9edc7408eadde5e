"""Naive Bayes support vectors: a text classifier.

The features of a text are indicators of its n-grams (words, word pairs, characters) in a fixed
number of hashed slots. Each slot is scaled by the log ratio of its shares in the two classes; on the
scaled features, at unit length, a linear hinge-loss model is fitted by dual coordinate descent. Its
margins become probabilities through a logistic curve fitted on rows that the model has not seen.

The fit uses at most ``sample`` labelled rows per class, the first in the order of a hash of their
ids; every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import chunks, flat_words, mixed, numbered, texts_of

#: Slots of the hashed features, the labelled rows per class that the fit sees at most, and their bytes each.
SLOTS, SAMPLE, MOST_BYTES = 1 << 18, 3000, 1 << 16
#: Added to the counts of each slot; price of a violated margin; rounds of the descent.
SMOOTHING, COST, ROUNDS = 1.0, 1.0, 15


def slots_of_texts(texts: list[bytes], slots: int = SLOTS) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct slots of its words, word pairs, and runs of one to three bytes."""
    lower = [t.lower() for t in texts]  # of bytes: A-Z only
    words, counts = flat_words(lower)
    distinct, which = numbered(words)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))[which]
    with np.errstate(over="ignore"):
        pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
    one, two = (hashes % slots).astype(np.int64), (pairs % slots).astype(np.int64)
    mark, end = np.zeros(slots, bool), np.cumsum(counts)
    many = np.array([0, 1, 2, 4, 8, 16, 32])
    for text, a, b in zip(lower, (end - counts).tolist(), end.tolist(), strict=True):
        raw = np.frombuffer(text, np.uint8).astype(np.int64)
        mark[one[a:b]] = True
        mark[two[a : b - 1] if b > a else two[:0]] = True
        for n in (1, 2, 3):
            code = np.zeros(max(len(raw) - n + 1, 0), np.int64)
            for k in range(n):
                code = code * 256 + raw[k : k + len(code)]
            mark[(mixed(code + (n << 32)) % np.uint64(slots)).astype(np.int64)] = True
        # how often the commonest word and line come back, as indicators of their own
        again = np.array([b - a - len(np.unique(which[a:b])), *_repeats(text)])
        share = np.searchsorted(many, 100 * again // max(b - a, 1), "right") + 10 * np.arange(len(again))
        mark[(mixed(share + (9 << 32)) % np.uint64(slots)).astype(np.int64)] = True
        mark[int(mixed(np.array([(8 << 32) + max(b - a, 1).bit_length()]))[0] % np.uint64(slots))] = True
        found = np.flatnonzero(mark)
        mark[found] = False
        yield found


def _repeats(text: bytes) -> tuple[int]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(lines) - len(set(lines)),)


def descend(
    rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = COST, rounds: int = ROUNDS, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights (on scaled features) and intercept that minimise hinge loss, one dual variable at a time."""
    random = np.random.default_rng(seed)
    values = [scale[r] / max(np.sqrt((scale[r] ** 2).sum()), 1e-12) for r in rows]
    weights, intercept, dual = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    sign = 2.0 * labels - 1
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            slope = sign[i] * (weights[rows[i]] @ values[i] + intercept) - 1
            new = min(max(dual[i] - slope / 2.0, 0.0), cost)  # |x|^2 is 1, and 1 for the intercept
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                weights[rows[i]] += step * values[i]
                intercept += step
                dual[i] = new
    return weights, intercept


def margins(rows: list[np.ndarray], scale: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    return np.array(
        [scale[r] @ weights[r] / max(np.sqrt((scale[r] ** 2).sum()), 1e-12) + intercept for r in rows], float
    )


def logistic_curve(evidence: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients (the last is the offset) of the probability of label 1, by Newton steps.

    ``evidence`` has one row per observation; the labels are drawn in a little from 0 and 1.
    """
    x = np.column_stack([evidence, np.ones(len(labels))])
    target = np.where(labels == 1, 1 - 1e-3, 1e-3)
    found, ridge = np.zeros(x.shape[1]), np.diag([1e-3] * (x.shape[1] - 1) + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -35, 35)))
        slope = x.T @ (weight * (p - target)) + ridge @ found
        bend = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        found = found - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return found


def sampled_labels(labels: DataFrame, id: str, label: str, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``sample`` ids of each class with their label, and the number of labelled ids per class."""
    clean = labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1))
    clean = clean.groupBy(F.col(id).alias("__id")).agg(F.min(label).cast("int").alias("__label"))
    sizes = {r["__label"]: r["count"] for r in clean.groupBy("__label").count().collect()}
    parts = [clean.where(F.col("__label") == k).orderBy(F.xxhash64("__id"), "__id").limit(sample) for k in (0, 1)]
    return parts[0].unionByName(parts[1]), sizes


def score_texts(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    id: str = "doc_id",
    text: str = "text",
    slots: int = SLOTS,
    sample: int = SAMPLE,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """The input columns but the text, with ``score``: the probability of label 1.

    ``labels`` holds the ids to learn from, of which at most ``sample`` per label and no text above
    ``most_bytes`` bytes are used, so that what comes to the driver is bounded; ids without a text, and labels other than 0 and 1, are
    ignored, and of several labels of an id the smallest counts. With only one class, or none, every
    score is that class's share (0.5 without any). NULL and empty texts are scored by the features
    of an empty text. Equal texts get equal scores; an empty table gives an empty result. An input
    column ``score`` is replaced.
    """
    spark = docs.sparkSession
    chosen, sizes = sampled_labels(labels, id, label, sample)  # at most 2 * sample rows
    source = docs.select(F.col(id).alias("__id"), F.col(text).cast("string").alias("__text"))
    picked = source.join(F.broadcast(chosen), "__id").where(F.coalesce(F.octet_length("__text"), F.lit(0)) <= most_bytes)
    # of several texts of an id the one with the smallest hash, so that the sample does not depend on tasks
    picked = picked.groupBy("__id", "__label").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text")).select("__label", "__text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text", 4 << 20):
            found = [x.astype("<u4").tobytes() for x in slots_of_texts(texts_of(batch, "__text"), slots)]
            yield pa.RecordBatch.from_arrays([batch.column("__label"), pa.array(found, pa.binary())], ["y", "slots"])

    taken = sorted((r["y"], bytes(r["slots"])) for r in picked.mapInArrow(extract, "y int, slots binary").collect())
    y = np.array([k for k, _ in taken], int)
    rows = [np.frombuffer(x, "<u4").astype(np.int64) for _, x in taken]
    model = _fit(rows, y, sizes, slots)
    sent = spark.sparkContext.broadcast(model)  # two numbers per slot
    carried = [c for c in docs.columns if c.lower() not in ("score", text.lower())]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, weights, intercept, a, b = sent.value
        for batch in chunks(batches, "__text", 4 << 20):
            margin = margins(list(slots_of_texts(texts_of(batch, "__text"), slots)), scale, weights, intercept)
            p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(p)], [*carried, "score"])

    plain = docs.select(*carried)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema), "score double"])
    return docs.select(*carried, F.col(text).cast("string").alias("__text")).mapInArrow(score, schema)


def _fit(rows: list[np.ndarray], y: np.ndarray, sizes: dict[int, int], slots: int):
    """Scale per slot, weights, intercept, and the logistic curve."""
    total = sum(sizes.values())
    if len(set(y.tolist())) < 2:
        share = sizes.get(1, 0) / total if total else 0.5
        share = min(max(share, 1e-9), 1 - 1e-9)
        return np.zeros(slots), np.zeros(slots), 0.0, 0.0, float(np.log(share / (1 - share)))
    counts = np.full((2, slots), SMOOTHING)
    for r, k in zip(rows, y, strict=True):
        counts[k, r] += 1
    scale = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    # every fifth row of a class is left out of a first fit, and calibrates
    order = np.concatenate([np.arange((y == k).sum()) for k in (0, 1)])  # rows are sorted by class
    held = order % 5 == 4
    a, b = 1.0, 0.0
    if held.any() and len(set(y[held].tolist())) == 2:
        part = np.full((2, slots), SMOOTHING)
        for r, k, h in zip(rows, y, held, strict=True):
            part[k, r] += not h
        own = np.log(part[1] / part[1].sum()) - np.log(part[0] / part[0].sum())
        w, c = descend([r for r, h in zip(rows, held, strict=True) if not h], y[~held], own)
        m = margins([r for r, h in zip(rows, held, strict=True) if h], own, w, c)
        weight = np.array([sizes[k] / max((y == k).sum(), 1) for k in (0, 1)])[y[held]]
        a, b = map(float, logistic_curve(m, y[held], weight / weight.mean()))
    weights, intercept = descend(rows, y, scale)
    return scale, weights, intercept, max(a, 1e-3), b
