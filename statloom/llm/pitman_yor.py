"""Language-model scores by a hierarchical Pitman-Yor model.

A token's context is the word before it, or the end before a text's first word. Every context word has
a restaurant of its own; all of them share the unigram restaurant as their parent, whose own base is
uniform over the vocabulary. Customers are the training tokens. Their seating is sampled by Gibbs, a
dish at a time: all customers of a dish in a restaurant are taken out and seated given everybody else,
first in the context restaurants, then, one customer for each of their tables, in the parent. Dishes of a
round are seated side by side, given the round before. Up to 16 customers the draw is that of the
conditional distribution, beyond that it is made forward from the first customer. The predictive
probabilities of the last rounds are averaged.

Work is split by dish: a part owns the counts of its words in all contexts, in one bucket of a table
that never moves again. What a dish needs to know of a restaurant is the number of its tables. These
numbers are split by context: after each round every part sends the tables it has in each of its
contexts to the part of that context, which adds them up and sends back the sums. Only six sums and
the totals of the parent pass the driver. Each round is written, so that no round is repeated. Words of
held-out texts are counted as zero, so that a part knows every pair it will be asked for. To be scored,
tokens travel to the parts of their words, packed in arrays; very common words are dealt over several
parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import chunks, flat_words, mixed, numbered, ragged, release, shuffle_partitions, texts_of
from statloom.storage import discard, scratch_path, write_buckets

#: Rounds before the first and rounds that are averaged; concentrations.
BURN_IN, SAMPLES = 2, 3
THETA, ROOT_THETA = 1.0, 1.0
#: Customers up to which a dish is drawn from its conditional distribution; dishes drawn at once.
EXACT, DISHES = 16, 4096
#: Bytes and texts of a chunk; a text's number within its chunk takes two bytes.
CHUNK, CHUNK_TEXTS = 12 << 20, 1 << 16
END = xxhash.xxh64_intdigest(b"")

_COUNTS = "p int, words binary, sizes binary, ctx binary, contexts binary, last binary"
_PACKET = "p int, uid long, kind int, words binary, sizes binary, ctx binary, contexts binary, last binary, n_docs int"
#: What parts send each other: addressee, sender, kind, arrays, sums for the driver.
_MAIL = "p int, sender int, kind int, v array<binary>, sums array<double>"
STATE, OPEN, PLACES, TABLES, FIRST, TOTALS, HOT, TOKENS, LISTED = range(9)


def _packed(a: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def _numbers(b: bytes, kind: str) -> np.ndarray:
    size, kind = int.from_bytes(b[:8], "little"), np.dtype(kind)
    if not size:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.Codec("zstd").decompress(b[8:], size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def _listed(hashes: np.ndarray) -> bytes:
    """Ascending hashes as compressed differences."""
    return _packed(np.diff(hashes.astype("<u8"), prepend=np.zeros(1, "<u8")))


def _hashes(b: bytes) -> np.ndarray:
    return np.cumsum(_numbers(b, "<u8"), dtype="<u8")


class _Tokens:
    """The tokens of some texts: number of the word, number of the word before, text."""

    def __init__(self, texts: list[bytes]):
        words, counts = flat_words([t.lower() for t in texts])
        distinct, which = numbered(words)
        self.hashes = np.fromiter((*map(xxhash.xxh64_intdigest, distinct), END), np.uint64, len(distinct) + 1)
        ends = np.cumsum(counts)
        self.token = np.insert(which, ends, len(distinct)).astype(np.int32)
        self.counts = counts + 1
        self.context = np.concatenate([np.array([len(distinct)], np.int32), self.token[:-1]])
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), self.counts)


def _part(hashes: np.ndarray, parts: int, salt: np.ndarray | int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mixed(hashes + np.asarray(salt, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(parts)).astype(np.int64)


def _packets(hashes, part, sizes, contexts, last, ascending=False) -> Iterator[tuple]:
    """Splits entries sorted by word into one packet per part, words in order of their hash.

    ``sizes`` counts the entries of each word; ``contexts`` (numbers of words) and ``last`` hold the
    entries. A packet lists the hashes of its contexts and numbers them. ``last`` goes as differences if
    it is ``ascending`` within a word.
    """
    order = np.lexsort((hashes, part))
    order = order[sizes[order] > 0]
    start = np.cumsum(sizes) - sizes
    at = ragged(start[order], sizes[order])
    contexts, last = contexts[at], last[at]
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    upto = np.concatenate([[0], np.cumsum(sizes[order])])
    for a, b in zip([0, *cuts], [*cuts, len(order)], strict=True):
        if a < b:
            own = order[a:b]
            entries = slice(upto[a], upto[b])
            listed, number = np.unique(hashes[contexts[entries]], return_inverse=True)
            yield (
                int(part[own[0]]),
                _listed(hashes[own]),
                _packed(sizes[own].astype("<u4")),
                _listed(listed),
                _packed(number.astype("<u4")),
                _packed(np.diff(last[entries], prepend=last.dtype.type(0)) if ascending else last[entries]),
            )


def _counting(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            if not batch.num_rows:
                continue
            tokens = _Tokens(texts_of(batch, "text"))
            train = np.array([bool(k) for k in batch.column("train").to_pylist()])
            size = len(tokens.hashes)
            code, n = np.unique((tokens.token.astype(np.int64) * size + tokens.context) * 2 + train[tokens.text], return_counts=True)
            n *= code & 1
            code >>= 1
            first = np.flatnonzero(np.diff(code, prepend=-1))
            code, n = code[first], np.add.reduceat(n, first)
            sizes = np.bincount(code // size, minlength=size)
            rows = list(_packets(tokens.hashes, _part(tokens.hashes, parts), sizes, code % size, n.astype("<u4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 6))],
                [x.split()[0] for x in _COUNTS.split(", ")],
            )
        release()

    return run


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    """One row per part: its words, their contexts, and counts."""
    words = np.concatenate([_hashes(b) for b in frame["words"]])
    sizes = np.concatenate([_numbers(b, "<u4") for b in frame["sizes"]]).astype(np.int64)
    distinct, number = np.unique(words, return_inverse=True)
    lists = [_hashes(b) for b in frame["ctx"]]
    ctx, place = np.unique(np.concatenate(lists), return_inverse=True)
    base = np.cumsum([0, *map(len, lists)])
    at = np.concatenate([place[a + _numbers(b, "<u4")] for a, b in zip(base, frame["contexts"])])
    code = np.repeat(number, sizes) * len(ctx) + at
    del at, words, place, lists
    code, place = np.unique(code, return_inverse=True)
    counts = np.bincount(place, np.concatenate([_numbers(b, "<u4") for b in frame["last"]])).astype("<i8")
    row = {
        "p": int(frame["p"].iloc[0]),
        "words": _listed(distinct),
        "sizes": _packed(np.bincount(code // len(ctx), minlength=len(distinct)).astype("<u4")),
        "ctx": _listed(ctx),
        "contexts": _packed((code % len(ctx)).astype("<u4")),
        "last": _packed(counts),
    }
    return pd.DataFrame([row])


def _conditional(customers: int, weight: np.ndarray, base: np.ndarray, discount: float, random) -> np.ndarray:
    """Tables of dishes with equally many customers, drawn from their distribution given everybody else.

    Customer n + 1 counts (weight + discount * t) * base for a new table and n - discount * t for the t
    tables there; a seating counts the product. Sums over all seatings of the later customers, from
    the last one back, turn these into the probabilities of each step.
    """
    t = np.arange(1, customers + 1)
    new = (weight[:, None] + discount * t) * base[:, None]
    later = {customers: np.ones((len(weight), customers))}
    for n in range(customers - 1, 0, -1):
        taken = later[n + 1][:, :n] * (n - discount * t[:n])
        later[n] = new[:, :n] * later[n + 1][:, 1 : n + 1] + taken
    rows, tables = np.arange(len(weight)), np.ones(len(weight), np.int64)
    for n in range(1, customers):
        opens = new[rows, tables - 1] * later[n + 1][rows, tables]
        tables += random.random(len(rows)) * later[n][rows, tables - 1] < opens
    return tables


def reseat(customers: np.ndarray, weight: np.ndarray, base: np.ndarray, discount: float, random) -> np.ndarray:
    """Tables after all customers of each dish were taken out and seated anew, given everybody else.

    ``weight`` is concentration plus discount times all other tables of the restaurant, ``base`` the
    parent's probability of the dish. Dishes of up to ``EXACT`` customers are drawn from their
    conditional distribution. Beyond that customers enter one after the other, with odds
    (weight + discount * t) * base : n - discount * t, and from the 16th on in runs of up to an eighth
    of those seated, with the odds at the middle of the run.
    """
    out = np.ones(len(customers))
    order = np.argsort(-customers, kind="stable")
    many = int(np.searchsorted(-customers[order], -EXACT, "left"))
    out[order[:many]] = _forward(customers[order[:many]].astype(np.int64), weight[order[:many]], base[order[:many]], discount, random)
    for n in range(2, EXACT + 1):
        own = np.flatnonzero(customers == n)
        for k in range(0, len(own), DISHES):
            at = own[k : k + DISHES]
            out[at] = _conditional(n, weight[at], base[at], discount, random)
    return out


def _forward(left: np.ndarray, weight: np.ndarray, base: np.ndarray, discount: float, random) -> np.ndarray:
    """Tables of dishes, most customers first, that are seated customer by customer or in runs."""
    tables, n = np.ones(len(left)), 1
    upto = len(left)
    while True:
        upto = int(np.searchsorted(-left[:upto], -n, "left"))  # dishes with more than n customers
        if not upto:
            return tables
        run = max(1, n // 8) if n >= 16 else 1
        t = tables[:upto]
        new = (weight[:upto] + discount * t) * base[:upto]
        p = new / (new + np.maximum(n + (run - 1) / 2 - discount * t, 1 - discount))
        if run == 1:
            t += random.random(upto) < p
        else:
            t += random.binomial(np.minimum(run, left[:upto] - n), p)
        n += run


class Seating:
    """The restaurants' customers of one part's dishes, and how they are seated."""

    def __init__(self, r, settings: dict):
        self.p, self.settings = int(r.p), settings
        self.words = _hashes(r.words)
        self.sizes = _numbers(r.sizes, "<u4").astype(np.int64)
        self.ctx = _hashes(r.ctx)
        self.contexts = _numbers(r.contexts, "<u4").astype(np.int64)
        self.counts = _numbers(r.last, "<i8")
        self.word = np.repeat(np.arange(len(self.words)), self.sizes)
        self.many = np.flatnonzero(self.counts > 1)
        # before the first round every dish has one table wherever it is served
        self.tables = np.minimum(self.counts, 1).astype(float)
        self.root = np.minimum(self.customers(), 1)
        #: tables of the averaged rounds, summed up; customers, tables of the parent and all tables, each
        self.sums, self.kept = np.zeros(len(self.many), np.int64), []

    def customers(self) -> np.ndarray:
        """Of the parent: one for each table of a context restaurant."""
        return np.bincount(self.word, self.tables, minlength=len(self.words))

    def parent(self, customers: np.ndarray, root: np.ndarray, totals: tuple) -> np.ndarray:
        """The parent's probability of each word, given all customers and tables there."""
        s = self.settings
        theta, d = s["root_theta"], s["root_discount"]
        return (customers - d * root + (theta + d * totals[1]) / (s["vocabulary"] + 1)) / (theta + totals[0])

    def round(self, number: int, at_contexts: np.ndarray, totals: tuple) -> None:
        """Reseats everybody, given the tables per context and in the parent of the round before."""
        s, many, random = self.settings, self.many, np.random.default_rng([self.settings["seed"], self.p, number])
        own, word = self.tables[many], self.word[many]
        others = s["theta"] + s["discount"] * np.maximum(at_contexts[self.contexts[many]] - own, 0)
        # the dish's own customers leave the parent, too
        left = self.customers()[word] - own
        base = self.parent(left, np.minimum(self.root[word], left), (totals[0] - own, totals[1]))
        self.tables[many] = reseat(self.counts[many], others, base, s["discount"], random)
        customers = self.customers()
        seen = np.flatnonzero(customers > 0)
        others = s["root_theta"] + s["root_discount"] * np.maximum(totals[1] - self.root[seen], 0)
        flat = np.full(len(seen), 1 / (s["vocabulary"] + 1))
        self.root[seen] = reseat(customers[seen], others, flat, s["root_discount"], random)

    def keep(self, at_contexts: np.ndarray) -> None:
        """Takes the present round into the average, given all its tables per context."""
        self.sums += self.tables[self.many].astype(np.int64)
        self.kept.append((self.customers(), self.root.copy(), at_contexts))

    def slices(self, parts: int) -> Iterator[tuple[int, np.ndarray]]:
        """The contexts of this part by the part that adds up their tables, in order of their hash."""
        owner = _part(self.ctx, parts)
        order = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[order])) + 1
        for own in np.split(order, cuts):
            if len(own):
                yield int(owner[own[0]]), own

    def at_contexts(self, mail: pd.DataFrame, kind: int, parts: int, which: int = 0) -> np.ndarray:
        """The sums that the contexts' parts have sent."""
        found, out = dict(self.slices(parts)), np.zeros(len(self.ctx))
        for r in mail[mail["kind"] == kind].itertuples(index=False):
            out[found[int(r.sender)]] = _numbers(r.v[which], "<i8")
        return out

    def state(self) -> list[bytes]:
        whole = [self.tables[self.many], self.root, self.sums, *(a for row in self.kept for a in row)]
        return [_packed(a.astype("<i8")) for a in whole]

    def resume(self, mail: pd.DataFrame) -> Seating:
        for r in mail[mail["kind"] == STATE].itertuples(index=False):
            tables, root, sums, *kept = (_numbers(b, "<i8") for b in r.v)
            self.tables[self.many], self.root, self.sums = tables, root.astype(float), sums.copy()
            self.kept = [tuple(kept[k : k + 3]) for k in range(0, len(kept), 3)]
        return self


def _mail(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in _MAIL.split(", ")])


def _opening(parts: int):
    """The tables and customers of each part's contexts before the first round, and sums of the part."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                s = Seating(r, {})
                tables = np.bincount(s.contexts, s.tables, minlength=len(s.ctx)).astype("<i8")
                customers = np.bincount(s.contexts, s.counts, minlength=len(s.ctx)).astype("<i8")
                n, w = s.counts, s.customers()
                sums = [n.sum(), (w > 0).sum(), w.sum(), (n == 1).sum(), (n == 2).sum(), (w == 1).sum(), (w == 2).sum()]
                rows = [(s.p, s.p, STATE, [], [float(x) for x in sums])]
                for q, own in s.slices(parts):
                    rows.append((q, s.p, OPEN, [_listed(s.ctx[own]), _packed(tables[own]), _packed(customers[own])], None))
                yield _mail(rows)

    return run


def _meeting(frame: pd.DataFrame) -> pd.DataFrame:
    """Numbers the contexts of one part, for each sender; adds up their tables and customers."""
    rows, q = [], int(frame["p"].iloc[0])
    listed = [_hashes(v[0]) for v in frame["v"]]
    _, place = np.unique(np.concatenate(listed), return_inverse=True)
    sums = [np.bincount(place, np.concatenate([_numbers(v[k], "<i8") for v in frame["v"]])).astype("<i8") for k in (1, 2)]
    upto = np.cumsum([0, *map(len, listed)])
    for k, sender in enumerate(frame["sender"]):
        at = place[upto[k] : upto[k + 1]]
        rows.append((q, int(sender), PLACES, [_packed(np.diff(at, prepend=0).astype("<i8"))], None))
        rows.append((int(sender), q, FIRST, [_packed(x[at]) for x in sums], None))
    return _mail(rows)


def _adding_up(frame: pd.DataFrame) -> pd.DataFrame:
    """The tables of all parts in the contexts of one part, sent back to each of them."""
    places = {int(r.sender): np.cumsum(_numbers(r.v[0], "<i8")) for r in frame[frame["kind"] == PLACES].itertuples(index=False)}
    total = np.zeros(max(int(at.max()) for at in places.values()) + 1, "<i8")
    for r in frame[frame["kind"] == TABLES].itertuples(index=False):
        total[places[int(r.sender)]] += _numbers(r.v[0], "<i8")  # a sender names a context once
    q = int(frame["p"].iloc[0])
    return _mail([(sender, q, TOTALS, [_packed(total[at])], None) for sender, at in places.items()])


def _advancing(number: int, settings: dict, totals: tuple, burn_in: int, parts: int):
    def run(counts: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in counts.itertuples(index=False):
            s = Seating(r, settings).resume(mail)
            before = s.at_contexts(mail, FIRST if number == 1 else TOTALS, parts)
            if number - 1 > burn_in:
                s.keep(before)
            s.round(number, before, totals)
            tables = np.bincount(s.contexts, s.tables, minlength=len(s.ctx)).astype("<i8")
            rows.append((s.p, s.p, STATE, s.state(), [float(s.tables.sum()), float(s.root.sum())]))
            rows += [(q, s.p, TABLES, [_packed(tables[own])], None) for q, own in s.slices(parts)]
        return _mail(rows)

    return run


class Model:
    """Counts by part, and what the parts know after the last round."""

    def __init__(self, counts: DataFrame, parts: int, burn_in: int, samples: int, seed: int):
        self.counts, self.parts = counts, parts
        spark = counts.sparkSession

        def written(mail: DataFrame, *used: str) -> tuple[DataFrame, str]:
            """``mail`` as a table; those it was made from go, if nothing else reads them."""
            place = scratch_path(spark, "pitman-yor")
            mail.write.parquet(place)
            for old in used:
                discard(spark, old)
            return spark.read.schema(_MAIL).parquet(place), place

        opened, last = written(counts.mapInPandas(_opening(parts), _MAIL))
        tokens, vocabulary, pairs, n1, n2, w1, w2 = _summed(opened, 7)
        self.tokens, self.vocabulary = int(tokens), int(vocabulary)
        share = lambda a, b: float(np.clip(a / max(a + 2 * b, 1), 0.1, 0.95))
        self.settings = {
            "tokens": self.tokens,
            "vocabulary": self.vocabulary,
            "theta": THETA,
            "root_theta": ROOT_THETA,
            "discount": share(n1, n2),
            "root_discount": share(w1, w2),
            "seed": seed,
            "kept": [],
        }
        asked = opened.where(F.col("kind") == OPEN).groupBy("p").applyInPandas(_meeting, _MAIL)
        met, numbered_at = written(asked, last)
        numbering, first = met.where(F.col("kind") == PLACES), met.where(F.col("kind") == FIRST)
        self.ends, totals = first, (pairs, vocabulary)
        rounds = burn_in + max(samples, 1) if self.tokens else 0
        for k in range(1, rounds + 1):
            step = _advancing(k, self.settings, totals, burn_in, parts)
            mail = first if k == 1 else self.ends
            moved = counts.groupBy("p").cogroup(mail.groupBy("p")).applyInPandas(step, _MAIL)
            made, last = written(moved, *([last] if k > 1 else []))
            totals = tuple(_summed(made, 2))
            if k > burn_in:
                self.settings["kept"].append(totals)
            sent = made.where(F.col("kind") == TABLES).unionByName(numbering)
            added = sent.groupBy("p").applyInPandas(_adding_up, _MAIL)
            self.ends = added.unionByName(made.where(F.col("kind") == STATE))
        if rounds:
            self.ends, _ = written(self.ends.unionByName(first), last, numbered_at)

    def hot(self) -> dict[int, int]:
        """Words with more than a quarter of a part's share of the tokens, at most 4 * parts, and
        over how many parts each is dealt."""
        least = max(self.tokens / (4 * self.parts), 1)

        def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for r in frame.itertuples(index=False):
                    sizes, words = _numbers(r.sizes, "<u4"), _hashes(r.words)
                    n = np.bincount(np.repeat(np.arange(len(sizes)), sizes), _numbers(r.last, "<i8"), len(sizes))
                    own = n > least
                    yield pd.DataFrame({"w": words[own].view(np.int64), "salts": np.ceil(n[own] / least).astype(np.int64)})

        rows = self.counts.mapInPandas(pick, "w long, salts long").collect()
        return {r["w"] & 0xFFFFFFFFFFFFFFFF: r["salts"] for r in rows}


def _summed(mail: DataFrame, size: int) -> list[float]:
    """The parts' sums, added up by Spark."""
    rows = mail.where(F.col("kind") == STATE)
    got = rows.agg(*(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(size))).first()
    return [float(x or 0) for x in got]


def _prediction(r, mail: pd.DataFrame, settings: dict, parts: int) -> tuple[Seating, np.ndarray]:
    """The part's seating, and the averaged probability of each of its pairs."""
    s = Seating(r, settings).resume(mail)
    if not settings["tokens"]:
        return s, np.ones(len(s.counts))
    s.keep(s.at_contexts(mail, TOTALS, parts))
    customers = s.at_contexts(mail, FIRST, parts, 1)
    d, theta, rounds = settings["discount"], settings["theta"], len(s.kept)
    p = s.counts.astype(float) * rounds
    p[s.counts == 1] -= d * rounds
    p[s.many] -= d * s.sums
    for (seated, root, tables), totals in zip(s.kept, settings["kept"], strict=True):
        p += (theta + d * tables)[s.contexts] * s.parent(seated, root, totals)[s.word]
    return s, p / rounds / (theta + customers)[s.contexts]


def _hot_rows(model: Model, salts: dict[int, int]):
    settings, parts = model.settings, model.parts

    def run(counts: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in counts.itertuples(index=False):
            words = _hashes(r.words)
            own = [i for i, w in enumerate(words.tolist()) if w in salts]
            if not own:
                continue
            s, p = _prediction(r, mail, settings, parts)
            upto = np.concatenate([[0], np.cumsum(s.sizes)])
            for i in own:
                at, word = slice(upto[i], upto[i + 1]), words[i : i + 1]
                row = {
                    "uid": -1,
                    "kind": HOT,
                    "words": _listed(word),
                    "sizes": b"",
                    "ctx": _listed(s.ctx[s.contexts[at]]),
                    "contexts": b"",
                    "last": np.concatenate([[s.counts[at].sum()], p[at]]).astype("<f8").tobytes(),
                    "n_docs": 0,
                }
                # salts may meet in one part, and the part that owns the word knows it already
                to = set(_part(word, parts, np.arange(1, salts[int(word[0])])).tolist()) - {s.p}
                out += [row | {"p": q} for q in sorted(to)]
        return pd.DataFrame(out, columns=[x.split()[0] for x in _PACKET.split(", ")])

    return run


def _sending(parts: int, salts: dict[int, int], kind: pa.DataType):
    """Per chunk: a packet for each part, and the list of its documents."""
    hot = np.array(sorted(salts), np.uint64)
    dealt = np.array([salts[int(w)] for w in hot], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 24
        for batch in chunks(batches, "text", CHUNK, CHUNK_TEXTS):
            if not batch.num_rows:
                continue
            tokens = _Tokens(texts_of(batch, "text"))
            order = np.argsort(tokens.token, kind="stable")
            sizes = np.bincount(tokens.token, minlength=len(tokens.hashes))
            # chunk ids count from a multiple of a power of two in each task
            deal = int(mixed(np.array([uid]))[0] >> np.uint64(1))
            salt = np.zeros(len(tokens.hashes), np.int64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, tokens.hashes), len(hot) - 1)
                salt = np.where(hot[at] == tokens.hashes, deal % dealt[at], 0)
            part = _part(tokens.hashes, parts, salt)
            rows = list(_packets(tokens.hashes, part, sizes, tokens.context[order], tokens.text[order].astype("<u2"), ascending=True))
            n, none = len(rows), [None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows] + [deal % parts], pa.int32()),
                    pa.array([uid] * (n + 1), pa.int64()),
                    pa.array([TOKENS] * n + [LISTED], pa.int32()),
                    *(pa.array([r[k] for r in rows] + none, pa.binary()) for k in range(1, 6)),
                    pa.array([batch.num_rows] * (n + 1), pa.int32()),
                    pa.array([None] * n + [batch.column("id").to_pylist()], pa.list_(kind)),
                    pa.array([None] * n + [tokens.counts.tolist()], pa.list_(pa.int64())),
                ],
                [*(x.split()[0] for x in _PACKET.split(", ")), "ids", "n_tokens"],
            )
            uid += 1
        release()

    return run


_SUMS = ("scores", "logs", "known")
#: Documents of a chunk whose sums of all parts meet in one group.
DOC_BLOCK = 256


def _scoring(model: Model):
    settings, parts = model.settings, model.parts

    def run(own: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        words, counts, ctx, keys, logs = [], [], [], [], []
        for r in own.itertuples(index=False):
            s, p = _prediction(r, frame, settings, parts)
            words.append(s.words), ctx.append(s.ctx), logs.append(np.log10(p))
            counts.append(np.bincount(s.word, s.counts, minlength=len(s.words)))
            keys.append((s.word, s.contexts))
            del s, p
        for r in frame[frame["kind"] == HOT].itertuples(index=False):
            v, listed = np.frombuffer(r.last, "<f8"), _hashes(r.ctx)
            words.append(_hashes(r.words)), ctx.append(listed), logs.append(np.log10(v[1:]))
            counts.append(v[:1])
            keys.append((np.zeros(len(listed), np.int64), np.arange(len(listed))))
        out, nothing = [], dict.fromkeys(("ids", "n_tokens", *_SUMS))

        def blocks(r) -> Iterator[tuple[dict, slice]]:
            for k in range(0, r.n_docs, DOC_BLOCK):
                yield nothing | {"uid": r.uid, "block": k // DOC_BLOCK}, slice(k, k + DOC_BLOCK)

        for r in frame[frame["kind"] == LISTED].itertuples(index=False):
            out += [row | {"ids": r.ids[at], "n_tokens": r.n_tokens[at]} for row, at in blocks(r)]
        if words:
            # words and contexts numbered by their hashes, pairs sorted
            known, number = np.unique(np.concatenate(words), return_inverse=True)
            listed, place = np.unique(np.concatenate(ctx), return_inverse=True)
            counts = np.bincount(number, np.concatenate(counts))
            w, c = np.cumsum([0, *map(len, words)]), np.cumsum([0, *map(len, ctx)])
            key = np.concatenate([number[a + i] * len(listed) + place[b + j] for a, b, (i, j) in zip(w, c, keys)])
            logs = np.concatenate(logs)
            if np.any(key[1:] < key[:-1]):
                order = np.argsort(key)
                key, logs = key[order], logs[order]
            del keys, number, place, words, ctx
        for r in frame[frame["kind"] == TOKENS].itertuples(index=False):
            at = np.searchsorted(known, _hashes(r.words))
            number = np.repeat(at, _numbers(r.sizes, "<u4"))
            context = np.searchsorted(listed, _hashes(r.ctx))[_numbers(r.contexts, "<u4")]
            score = logs[np.searchsorted(key, number * len(listed) + context)]
            text, n = np.cumsum(_numbers(r.last, "<u2"), dtype="<u2"), counts[number]
            made = [np.bincount(text, x, minlength=r.n_docs) for x in (score, np.log10(n + 1), (n > 0).astype(float))]
            made[2] = made[2].astype("<u4")
            out += [row | {name: x[at].tobytes() for name, x in zip(_SUMS, made, strict=True)} for row, at in blocks(r)]
        return pd.DataFrame(out, columns=["uid", "block", "ids", "n_tokens", *_SUMS])

    return run


def _adding(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums of all parts for one block of documents."""
    listed = frame[frame["ids"].notna()].iloc[0]
    parts = frame[frame["scores"].notna()]
    out = {"id": list(listed["ids"]), "n_tokens": list(listed["n_tokens"])}
    for name, kind in zip(_SUMS, ("<f8", "<f8", "<u4"), strict=True):
        total = np.zeros(len(out["id"]))
        for v in parts[name]:
            total += np.frombuffer(v, kind)
        out[name] = total
    out["known"] = out["known"].astype(np.int64)
    return pd.DataFrame(out)


def count_by_part(source: DataFrame, parts: int) -> DataFrame:
    """Counts of all pairs of ``source`` (``text, train``), zero for those of held-out texts alone:
    one row per part, each in the bucket of its part."""
    sent = source.select("text", "train").mapInArrow(_counting(parts), _COUNTS)
    return write_buckets(sent.groupBy("p").applyInPandas(_joined, _COUNTS), "pitman-yor", "p", parts)


def score_documents(
    docs: DataFrame,
    train: str,
    id: str = "doc_id",
    text: str = "text",
    burn_in: int = BURN_IN,
    samples: int = SAMPLES,
    seed: int = 11,
) -> DataFrame:
    """One row per input row: ``id, n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    The boolean column ``train`` says which rows are learned from (NULL: not). Tokens are the words
    of the text, A-Z in lower case, and one end. ``score`` is the model's log10 probability of the
    text, ``base_score`` that of add-one unigrams. A NULL or empty text is its end alone; a NULL id
    stays NULL. A very long text is one chunk. Without training rows every token is the one unknown word, of probability 1. Equal
    texts get scores equal but for the order of summation; an empty table gives no rows. No other
    column is used.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    source = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), F.col(train).alias("train"))
    model = Model(count_by_part(source, parts), parts, burn_in, samples, seed)
    by_part = model.counts.groupBy("p")

    salts = model.hot()
    kind = source.schema["id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    schema = f"{_PACKET}, ids array<{kind}>, n_tokens array<long>"
    tokens = source.select("id", "text").mapInArrow(_sending(parts, salts, to_arrow_type(source.schema["id"].dataType)), schema)
    hot = by_part.cogroup(model.ends.groupBy("p")).applyInPandas(_hot_rows(model, salts), _PACKET)
    known = model.ends.drop("sums").withColumns({"uid": F.lit(-1).cast("long"), "n_docs": F.lit(0)})
    asked = tokens.unionByName(hot, allowMissingColumns=True).unionByName(known, allowMissingColumns=True)
    sums = "uid long, block int, ids array<{0}>, n_tokens array<long>, scores binary, logs binary, known binary".format(kind)
    partial = by_part.cogroup(asked.groupBy("p")).applyInPandas(_scoring(model), sums)
    added = partial.groupBy("uid", "block").applyInPandas(_adding, f"id {kind}, n_tokens long, scores double, logs double, known long")
    share = float(np.log10(model.tokens + model.vocabulary + 1))
    return added.select(
        F.col("id").alias(id),
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * share).alias("base_score"),
        F.col("scores").alias("score"),
        F.pow(F.lit(10.0), -F.col("scores") / F.col("n_tokens")).alias("perplexity"),
    )
