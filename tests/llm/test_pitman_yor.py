import math
from collections import Counter
from itertools import product

import numpy as np
import pytest
import xxhash
from llm_data import low, words
from pyspark.sql import functions as F

from statloom.llm import pitman_yor as py


def tokens(text):
    return [w.encode() for w in words(low(text))] + [b""]


@pytest.fixture(scope="module")
def split(docs):
    return docs.withColumn("train", F.coalesce(F.col("doc_id") % 4 != 1, F.lit(False)))


@pytest.fixture(scope="module")
def scored(split):
    return py.score_documents(split, "train").collect()


def is_train(i):
    return i is not None and i % 4 != 1


def test_counts_and_base(rows, scored):
    counts = Counter(t for r in rows if is_train(r[0]) for t in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        own = tokens(r[1])
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        want.append((str(r[0]), len(own), sum(counts[t] > 0 for t in own), n, round(base, 6)))
    made = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored]
    assert sorted(made) == sorted(want)


def test_scores_follow_the_seating(split, rows, scored):
    """Every context word has its own restaurant, whose tables are those of all parts together; the
    scores are those of the averaged predictive probabilities, summed up one by one; for every
    context these add up to 1 over the vocabulary and the unknown word."""
    parts = py.shuffle_partitions(split.sparkSession)
    model = py.Model(py.count_by_part(split.select("text", "train"), parts), parts, py.BURN_IN, py.SAMPLES, 11)
    s, mail = model.settings, model.ends.toPandas()
    theta, d, rounds = s["theta"], s["discount"], range(py.SAMPLES)
    pair, parent, told, known, last = {}, {}, {}, {}, Counter()
    for r in model.counts.toPandas().itertuples(index=False):
        own = mail[mail["p"] == r.p]
        seating, p = py._prediction(r, own, s, parts)
        assert ((seating.tables >= np.minimum(seating.counts, 1)) & (seating.tables <= seating.counts)).all()
        words_, ctx = seating.words.tolist(), seating.ctx.tolist()
        for w, c, x, n, t in zip(seating.word, seating.contexts, p, seating.counts, seating.tables, strict=True):
            pair[words_[w], ctx[c]] = x
            last[ctx[c]] += t
            known[words_[w], ctx[c]] = n
        up = [seating.parent(a, b, t) for (a, b, _), t in zip(seating.kept, s["kept"], strict=True)]
        parent |= {w: [up[k][i] for k in rounds] for i, w in enumerate(words_)}
        customers = seating.at_contexts(own, py.FIRST, parts, 1)
        for i, c in enumerate(ctx):
            row = ([seating.kept[k][2][i] for k in rounds], customers[i])
            assert told.setdefault(c, row) == row
    name = lambda t: xxhash.xxh64_intdigest(t)
    counts, served = Counter(), Counter()
    for r in rows:
        own = tokens(r[1])
        for before, t in zip([b"", *own], own):
            counts[name(t), name(before)] += is_train(r[0])
            served[name(before)] += is_train(r[0])
    assert known == counts
    assert {c: n for c, (_, n) in told.items()} == served and {c: t[-1] for c, (t, _) in told.items()} == last
    assert len(told) > 100

    def p(word, context):
        if (word, context) in pair:
            return pair[word, context]
        tables, n = told[context]
        unseen = [(s["root_theta"] + s["root_discount"] * b) / (s["vocabulary"] + 1) / (s["root_theta"] + a) for a, b in s["kept"]]
        up = parent.get(word, unseen)
        return sum((theta + d * tables[k]) * up[k] for k in rounds) / len(rounds) / (theta + n)

    seen = [w for w in parent if any(known.get((w, c), 0) for c in told)]
    assert len(seen) == s["vocabulary"]
    for context in (name(b""), *list(told)[:5]):
        assert sum(p(w, context) for w in [*seen, -1]) == pytest.approx(1, abs=1e-9)
    want = []
    for r in rows:
        own = [name(t) for t in tokens(r[1])]
        want.append((str(r[0]), len(own), sum(math.log10(p(w, c)) for c, w in zip([name(b""), *own], own))))
    made = sorted((str(r.doc_id), r.n_tokens, r.score) for r in scored)
    for a, b in zip(made, sorted(want), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9)


def test_contexts_are_told_apart(spark):
    """Whatever the number of context words, what follows each of them is learned by itself."""
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat('a', id % 3000, ' b', id % 3000) AS text", "true AS train")
    last = docs.limit(0).unionByName(
        spark.createDataFrame([(-1, "a7 b7", False), (-2, "a7 b8", False)], "doc_id long, text string, train boolean")
    )
    got = {r.doc_id: r.score for r in py.score_documents(docs.unionByName(last), "train").where("doc_id < 0").collect()}
    assert got[-1] - got[-2] > 2


def test_packed_numbers():
    for a in (np.arange(5, dtype="<u4"), np.zeros(0, "<i8"), np.array([2**40, -3], "<i8"), np.arange(70000, dtype="<u2")):
        assert (py._numbers(py._packed(a), a.dtype.str) == a).all()


def test_better_than_unigrams(rows, scored):
    held = [r for r in scored if not is_train(r.doc_id)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    for r in scored:
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def test_common_words_are_dealt_over_parts(spark, split, scored, monkeypatch):
    """Dealing every word over several parts changes nothing."""
    many = lambda self: {int(w): 3 for r in self.counts.collect() for w in py._hashes(r.words)}
    monkeypatch.setattr(py.Model, "hot", many)
    again = py.score_documents(split.repartition(5), "train").collect()
    key = lambda r: (str(r.doc_id), r.n_tokens)
    for a, b in zip(sorted(scored, key=key), sorted(again, key=key), strict=True):
        assert a.doc_id == b.doc_id and a.score == pytest.approx(b.score, rel=1e-9) and a.n_known == b.n_known


def test_a_part_counts_a_common_word_once(spark):
    """More salts than parts, so that several of a word's salts meet in one part."""
    texts = ["the " * 9 + f"w{i % 5}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("train", F.lit(True))
    got = py.score_documents(docs.repartition(4), "train").collect()
    counts = Counter(t for x in texts for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(texts)
    for r in got:
        want = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(texts[r.doc_id]))
        assert r.base_score == pytest.approx(want, rel=1e-9)


def test_reseating_is_a_restaurant():
    """The mean number of tables of many customers is that of seating one after the other."""
    random, trials = np.random.default_rng(1), 3000
    for customers, weight, base, d in ((60, 20.0, 0.05, 0.8), (60, 0.5, 0.9, 0.2)):
        plain = []
        for _ in range(trials):
            t = 1
            for n in range(1, customers):
                new = (weight + d * t) * base
                t += random.random() < new / (new + n - d * t)
            plain.append(t)
        fast = py.reseat(np.full(trials, customers), np.full(trials, weight), np.full(trials, base), d, random)
        assert fast.min() >= 1 and fast.max() <= customers
        assert fast.mean() == pytest.approx(np.mean(plain), rel=0.06)


@pytest.mark.parametrize("customers, weight, base, d", [(2, 0.7, 0.3, 0.5), (5, 8.0, 0.2, 0.7), (7, 0.5, 0.9, 0.2), (9, 3.0, 0.4, 0.8)])
def test_few_customers_are_drawn_from_their_conditional(customers, weight, base, d):
    """All seatings of the customers at tables, each with the product of what its steps count."""
    exact = Counter()
    for steps in product((0, 1), repeat=customers - 1):
        t, share = 1, 1.0
        for n, opens in enumerate(steps, 1):
            share *= (weight + d * t) * base if opens else n - d * t
            t += opens
        exact[t] += share
    trials = 40_000
    mixed = np.where(np.arange(2 * trials) % 2, customers, 1)  # among dishes of one customer
    same = lambda x: np.full(2 * trials, x)
    drawn = py.reseat(mixed, same(weight), same(base), d, np.random.default_rng(5))
    assert (drawn[::2] == 1).all()
    made, total = Counter(drawn[1::2].tolist()), sum(exact.values())
    for t in range(1, customers + 1):
        assert made[t] / trials == pytest.approx(exact[t] / total, abs=0.012)


def test_without_training_rows_and_without_rows(docs, no_docs):
    alone = py.score_documents(docs.withColumn("train", F.lit(None).cast("boolean")), "train").collect()
    assert len(alone) == docs.count()
    assert all(r.score == r.base_score == 0 and r.n_known == r.train_tokens == 0 for r in alone)
    assert py.score_documents(no_docs.withColumn("train", F.lit(True)), "train").count() == 0


def test_many_texts_in_one_batch(spark):
    """More texts than two bytes number, in one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100_000)
    try:
        docs = spark.range(70_000, numPartitions=1).selectExpr("id AS doc_id", "concat('w', id % 7, ' the') AS text", "true AS train")
        got = py.score_documents(docs, "train").groupBy("n_tokens", "n_known").agg({"score": "max", "*": "count"}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.n_tokens, r.n_known, r["count(1)"]) for r in got] == [(3, 3, 70_000)] and got[0]["max(score)"] < 0
