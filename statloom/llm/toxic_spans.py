"""Toxic spans by a linear-chain conditional random field.

Only documents carry labels. Words, and beginnings of words, that come in many different contexts in
toxic documents and in hardly any elsewhere label the tokens: such a word in a toxic document is
toxic, every other token is not. A chain over each line, with indicators of the word, its first and
last letters and its length, is fitted to these tokens by gradient ascent on the likelihood. Forward-backward marginals of all
lines give each document its expected number of toxic tokens, a logistic curve of that and of the
number of all tokens makes it a score, and tokens that are more likely toxic than not are the offending spans.

The fit uses at most ``sample`` labelled documents per class (none longer than ``most_bytes``).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import chunks, texts_of
from statloom.llm.nb_svm import logistic_curve, sampled_labels

SLOTS, SAMPLE, MOST_BYTES = 1 << 17, 800, 1 << 18
#: A word or beginning labels tokens if it comes in so many contexts in toxic documents (at least
#: that share of their number) and this share of its contexts, both classes weighing the same, is there.
CONTEXTS, CONTEXT_SHARE, PURITY = 4, 0.02, 0.9
ROUNDS, PENALTY, STEP = 40, 1e-4, 0.5
_EDGE = ".,;:!?\"'()[]"
_BEGINNINGS = (4, 5, 6, 7)


def word_units(word: bytes) -> list[str]:
    """The word in lower case without marks at its ends, and its beginnings."""
    w = word.decode().lower().strip(_EDGE)
    return [f"w{w}", *(f"b{w[:n]}" for n in _BEGINNINGS if len(w) >= n)] if w else []


def word_slots(word: bytes, slots: int = SLOTS) -> list[int]:
    """Feature slots of a token; features that it lacks share the last slot, whose weight stays 0."""
    w = word.decode().lower().strip(_EDGE)
    named = [*word_units(word), f"z{w[-3:]}", f"n{min(len(w), 20)}"]
    own = [xxhash.xxh64_intdigest(f) % (slots - 1) for f in named]
    return own + [slots - 1] * (len(_BEGINNINGS) + 3 - len(own))


class Lines:
    """The tokens of some texts, as one chain per line, laid out position by position."""

    def __init__(self, texts: list[bytes]):
        words: list[bytes] = []
        sizes, docs = [], []
        for i, text in enumerate(texts):
            for line in text.split(b"\n"):
                own = line.split()
                if own:
                    words += own
                    sizes.append(len(own)), docs.append(i)
        number = dict.fromkeys(words)
        self.words = list(number)
        number.update(zip(self.words, range(len(self.words)), strict=True))
        which = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        size, doc = np.array(sizes, np.int64), np.array(docs, np.int64)
        rank = np.empty(len(size), np.int64)
        rank[np.argsort(-size, kind="stable")] = np.arange(len(size))
        longest = int(size.max()) if len(size) else 0
        # lines that have a token at each position; longer lines come first
        self.active = len(size) - np.searchsorted(np.sort(size), np.arange(longest), "right")
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        position = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        self.place = self.first[position] + np.repeat(rank, size)  # of each token, in text order
        self.which = np.empty(len(which), np.int64)
        self.which[self.place] = which
        self.doc = np.empty(len(which), np.int64)
        self.doc[self.place] = np.repeat(doc, size)

    def messages(self, emission: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """exp(emission), and the ratios toxic : clean of the forward and backward sums.

        ``step[i, j]`` is the factor of label j after label i.
        """
        factor = np.exp(np.clip(emission, -30, 30))
        ahead, back = np.empty_like(factor), np.ones_like(factor)
        for t, n in enumerate(self.active):
            here = slice(self.first[t], self.first[t] + n)
            if t:
                r = ahead[self.first[t - 1] : self.first[t - 1] + n]
                ahead[here] = factor[here] * (step[0, 1] + step[1, 1] * r) / (step[0, 0] + step[1, 0] * r)
            else:
                ahead[here] = factor[here]
        for t in range(len(self.active) - 2, -1, -1):
            n, after = self.active[t + 1], self.first[t + 1]
            x = factor[after : after + n] * back[after : after + n]
            back[self.first[t] : self.first[t] + n] = (step[1, 0] + step[1, 1] * x) / (step[0, 0] + step[0, 1] * x)
        return factor, ahead, back

    def marginals(self, emission: np.ndarray, step: np.ndarray) -> np.ndarray:
        _, ahead, back = self.messages(emission, step)
        both = ahead * back
        return both / (1 + both)

    def pairs(self, emission: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals, and the expected number of each pair of neighbouring labels."""
        factor, ahead, back = self.messages(emission, step)
        both = ahead * back
        if len(self.active) < 2:
            return both / (1 + both), np.zeros((2, 2))
        later = np.arange(self.first[1], len(factor))
        earlier = later - np.repeat(self.active[:-1], self.active[1:])
        x, r = factor[later] * back[later], ahead[earlier]
        parts = np.array([np.full(len(x), step[0, 0]), step[0, 1] * x, step[1, 0] * r, step[1, 1] * r * x])
        return both / (1 + both), (parts / parts.sum(0)).sum(1).reshape(2, 2)

    def label_pairs(self, labels: np.ndarray) -> np.ndarray:
        out = np.zeros((2, 2))
        if len(self.active) > 1:
            later = np.arange(self.first[1], len(labels))
            earlier = later - np.repeat(self.active[:-1], self.active[1:])
            np.add.at(out, (labels[earlier], labels[later]), 1)
        return out


def toxic_units(texts: list[bytes], toxic: np.ndarray, contexts: int = CONTEXTS, purity: float = PURITY) -> set[str]:
    """Units that come behind many different words in toxic texts, and hardly any in the others."""
    behind = (defaultdict(set), defaultdict(set))
    units: dict[bytes, list[str]] = {}
    for text, label in zip(texts, toxic, strict=True):
        before = b""
        for word in text.split():
            if word not in units:
                units[word] = word_units(word)
            for unit in units[word]:
                behind[label][unit].add(before)
            before = word
    tokens = [sum(len(t.split()) for t, y in zip(texts, toxic, strict=True) if y == k) or 1 for k in (0, 1)]
    least = max(contexts, CONTEXT_SHARE * int(toxic.sum()))
    out = set()
    for unit, own in behind[1].items():
        here, there = len(own) / tokens[1], len(behind[0].get(unit, ())) / tokens[0]
        if len(own) >= least and here >= purity * (here + there):
            out.add(unit)
    return out


def fit_chain(
    texts: list[bytes], toxic: np.ndarray, slots: int = SLOTS, rounds: int = ROUNDS, penalty: float = PENALTY
) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights per slot, bias, and the factors of neighbouring labels."""
    lines = Lines(texts)
    bad = toxic_units(texts, toxic)
    labelled = np.array([not bad.isdisjoint(word_units(w)) for w in lines.words], bool)
    y = (labelled[lines.which] & (toxic[lines.doc] == 1)).astype(np.int64) if len(lines.which) else np.zeros(0, np.int64)
    features = np.array([word_slots(w, slots) for w in lines.words], np.int64).reshape(len(lines.words), -1)
    weights, bias, step = np.zeros(slots), -4.0, np.zeros((2, 2))
    seen, bias_seen, step_seen = np.full(slots, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    wanted, n = lines.label_pairs(y), max(int(y.sum()), 1)
    for _ in range(rounds if len(lines.which) else 0):
        emission = (weights[features].sum(1) + bias)[lines.which]
        p, expected = lines.pairs(emission, np.exp(step))
        wrong = p - y
        per_word = np.bincount(lines.which, wrong, minlength=len(lines.words)) / n
        slope = np.bincount(features.ravel(), np.repeat(per_word, features.shape[1]), minlength=slots) + penalty * weights
        slope[-1] = 0.0
        step_slope = (expected - wanted) / n + penalty * step
        step_slope[0, 0] = 0.0  # the others are relative to it
        seen += slope**2
        step_seen += step_slope**2
        bias_seen += (wrong.sum() / n) ** 2
        weights -= STEP * slope / np.sqrt(seen)
        step -= STEP * step_slope / np.sqrt(step_seen)
        bias -= STEP * wrong.sum() / n / np.sqrt(bias_seen)
    return weights, float(bias), np.exp(step)


def toxic_evidence(texts: list[bytes], model) -> tuple[np.ndarray, Lines, np.ndarray]:
    """Per text the logarithms of its expected toxic and of all tokens; the lines and their marginals."""
    weights, bias, step = model
    lines = Lines(texts)
    if not lines.words:
        return np.log(np.full((len(texts), 2), [1e-3, 1.0])), lines, np.zeros(0)
    features = np.array([word_slots(w, len(weights)) for w in lines.words], np.int64)
    p = lines.marginals((weights[features].sum(1) + bias)[lines.which], step)
    expected, all_ = np.bincount(lines.doc, p, minlength=len(texts)), np.bincount(lines.doc, minlength=len(texts))
    return np.log(np.column_stack([expected + 1e-3, all_ + 1.0])), lines, p


def _spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Code point ranges of the words that are hit."""
    raw = np.frombuffer(text, np.uint8)
    blank = (raw == 0x20) | ((raw >= 9) & (raw <= 13))
    inside = np.concatenate([[False], ~blank, [False]])
    point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    return [{"start": int(point[a]), "end": int(point[b])} for a, b in zip(starts[hit], ends[hit], strict=True)]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """The input columns but the text, with ``score`` (0 to 1) and ``spans`` of toxic words.

    ``spans`` are ranges of code points (start, past the end). NULL and empty texts have no tokens,
    hence the lowest score. Labels of unknown ids or other than 0 and 1 are ignored, and of several labels
    of an id the smallest counts; without both
    classes no word is toxic and every score is the share of label 1 (0 without labels). Equal texts
    get equal scores; an empty table gives an empty result. Input columns that bear an added name
    are replaced.
    """
    spark = docs.sparkSession
    chosen, sizes = sampled_labels(labels, id, label, sample)  # at most 2 * sample rows
    source = docs.select(F.col(id).alias("__id"), F.col(text).cast("string").alias("__text"))
    picked = source.join(F.broadcast(chosen), "__id").where(F.octet_length("__text") <= most_bytes)
    # of several texts of an id the one with the smallest hash, so that the sample does not depend on tasks
    picked = picked.groupBy("__id", "__label").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))
    taken = sorted((r["__label"], r["__text"].encode()) for r in picked.collect())
    y, texts = np.array([k for k, _ in taken], np.int64), [t for _, t in taken]
    model, curve = (np.zeros(SLOTS), -30.0, np.ones((2, 2))), np.array([0.0, 0.0, -35.0])
    if len(set(y.tolist())) == 2:
        model = fit_chain(texts, y)
        weight = np.array([sizes[k] / max((y == k).sum(), 1) for k in (0, 1)])[y]
        curve = logistic_curve(toxic_evidence(texts, model)[0], y, weight / weight.mean())
    elif sum(sizes.values()):
        share = min(max(sizes.get(1, 0) / sum(sizes.values()), 1e-9), 1 - 1e-9)
        curve = np.array([0.0, 0.0, np.log(share / (1 - share))])
    sent = spark.sparkContext.broadcast(model)  # one number per slot
    added = ("score", "spans")
    carried = [c for c in docs.columns if c.lower() not in (*added, text.lower())]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text", 8 << 20):
            own = texts_of(batch, "__text")
            evidence, lines, p = toxic_evidence(own, sent.value)
            hit = p[lines.place] >= 0.5 if len(p) else np.zeros(0, bool)
            counts = np.bincount(lines.doc, minlength=len(own)) if len(p) else np.zeros(len(own), np.int64)
            end = np.cumsum(counts)
            some = np.flatnonzero(np.bincount(lines.doc[lines.place][hit], minlength=len(own))) if len(p) else []
            spans: list[list[dict]] = [[] for _ in own]
            for i in some:
                spans[i] = _spans(own[i], hit[end[i] - counts[i] : end[i]])
            scores = 1 / (1 + np.exp(-np.clip(evidence @ curve[:2] + curve[2], -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(scores), pa.array(spans, span)], [*carried, *added]
            )

    plain = docs.select(*carried).schema
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain]
    schema = ", ".join([*fields, "score double", "spans array<struct<start:bigint,end:bigint>>"])
    return docs.select(*carried, F.col(text).cast("string").alias("__text")).mapInArrow(score, schema)
