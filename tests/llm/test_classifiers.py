import random
from itertools import product

import numpy as np
import pytest

from statloom.llm import nb_svm, toxic_spans

TOXIC = ["idiot", "moron", "scum"]


def corpus(n=300, seed=2):
    rnd = random.Random(seed)
    calm = ["".join(rnd.choice("aeioulrnst") for _ in range(rnd.randint(2, 8))) for _ in range(150)]
    texts, toxic, good = [], [], []
    for i in range(n):
        own = [rnd.choice(calm) for _ in range(rnd.randint(5, 60))]
        if i % 4 == 0:
            for _ in range(1 + len(own) // 12):
                own.insert(rnd.randrange(len(own)), rnd.choice(TOXIC).upper() + rnd.choice(["", ".", ","]))
        if i % 5 == 0:
            own = [w + rnd.choice(["###", "$$$", "&&&"]) for w in own]
        texts.append(" ".join(own).replace(" ", "\n", 1))
        toxic.append(int(i % 4 == 0)), good.append(int(i % 5 != 0))
    return texts, toxic, good


@pytest.fixture(scope="module")
def labelled(spark):
    texts, toxic, good = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(list(zip(range(len(texts)), good, toxic)), "doc_id long, quality int, toxic int")
    return docs, labels, texts, toxic, good


ODD = [(900, None), (901, ""), (902, " \n "), (None, "calm words"), (903, "x" * 300_000), (903, "x" * 300_000), (904, "\0 odd\x7f")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 as score", "2 as Spans", "3 as other")


def test_quality_on_held_out_rows(labelled):
    docs, labels, _, _, good = labelled
    got = {r.doc_id: r.score for r in nb_svm.score_texts(docs, labels.where("doc_id % 3 > 0"), "quality").collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert np.mean([(s >= 0.3) == bool(good[i]) for i, s in got.items() if i % 3 == 0]) > 0.95


def test_toxicity_on_held_out_rows(labelled):
    docs, labels, texts, toxic, _ = labelled
    rows = toxic_spans.score_toxicity(docs, labels.where("doc_id % 3 > 0")).collect()
    held = [r for r in rows if r.doc_id % 3 == 0]
    assert np.mean([(r.score >= 0.5) == bool(toxic[r.doc_id]) for r in held]) > 0.95
    wrong = 0
    for r in rows:
        said = [texts[r.doc_id][s.start : s.end].strip(".,#$&").lower() for s in r.spans]
        wrong += said != [w for x in texts[r.doc_id].split() if (w := x.strip(".,#$&").lower()) in TOXIC]
    assert wrong < 0.05 * len(rows)


@pytest.mark.parametrize("which", ["quality", "toxic"])
def test_odd_rows(spark, labelled, which):
    _, labels, *_ = labelled
    docs = labelled[0].selectExpr("*", "1 as score", "2 as Spans", "3 as other").unionByName(odd(spark))
    bad = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 7, 7), (99999, 1, 1), (3, 1, 1), (3, 0, 0)], labels.schema)
    if which == "quality":
        got = nb_svm.score_texts(docs, labels.unionByName(bad), "quality")
    else:
        got = toxic_spans.score_toxicity(docs, labels.unionByName(bad))
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows) and got.columns.count("score") == 1
    scores = {r.doc_id: r.score for r in rows}
    assert scores[900] == scores[901] and len({r.score for r in rows if r.doc_id == 903}) == 1


@pytest.mark.parametrize("classes", [[], [1], [0]])
def test_without_both_classes(spark, labelled, classes):
    docs, labels, *_ = labelled
    some = labels.where(labels["toxic"].isin(classes or [5])).withColumn("quality", labels["toxic"])
    for rows in (
        nb_svm.score_texts(docs, some, "quality").collect(),
        toxic_spans.score_toxicity(docs, some).collect(),
    ):
        wanted = {(): None, (1,): 1.0, (0,): 0.0}[tuple(classes)]
        assert len({r.score for r in rows}) == 1
        assert wanted is None or rows[0].score == pytest.approx(wanted, abs=1e-6)
    assert nb_svm.score_texts(docs.limit(0), labels, "quality").count() == 0
    assert toxic_spans.score_toxicity(docs.limit(0), labels).count() == 0


def test_descent_reaches_the_optimum():
    """Hinge loss and half the squared norm, against a plain subgradient search."""
    random_ = np.random.default_rng(3)
    rows = [np.sort(random_.choice(12, 5, False)) for _ in range(40)]
    labels = np.array([int(0 in r or 1 in r) for r in rows])
    labels[:4] = 1 - labels[:4]
    scale = random_.normal(size=12)

    def loss(w, b):
        m = (2 * labels - 1) * nb_svm.margins(rows, scale, w, b)
        return 0.5 * (w @ w + b * b) + np.maximum(1 - m, 0).sum()

    w, b = nb_svm.descend(rows, labels, scale, rounds=400)
    best = loss(w, b)
    for _ in range(300):
        assert best <= loss(w + random_.normal(size=12) * 0.02, b + random_.normal() * 0.02) + 1e-6


def test_features_are_indicators():
    first, second, empty = nb_svm.slots_of_texts([b"Ab cd ab", b"ab cd ab", b""])
    assert (first == second).all() and (np.diff(first) > 0).all() and len(empty) < len(first)


def test_marginals_against_all_labellings():
    random_ = np.random.default_rng(4)
    lines = toxic_spans.Lines([b"a b c\nd e", b"", b"f"])
    emission, step = random_.normal(size=6), np.exp(random_.normal(size=(2, 2)))
    p = lines.marginals(emission, step)[lines.place]
    q, expected = lines.pairs(emission, step)
    assert np.allclose(q[lines.place], p)
    at, wanted_pairs = 0, np.zeros((2, 2))
    for size in (3, 2, 1):
        own = emission[lines.place][at : at + size]
        total, marginal, pairs = 0.0, np.zeros(size), np.zeros((2, 2))
        for y in product((0, 1), repeat=size):
            weight = np.exp(sum(e for e, k in zip(own, y) if k)) * np.prod([step[a, b] for a, b in zip(y, y[1:])])
            total += weight
            marginal += weight * np.array(y)
            for a, b in zip(y, y[1:]):
                pairs[a, b] += weight
        assert np.allclose(p[at : at + size], marginal / total)
        wanted_pairs += pairs / total
        at += size
    assert np.allclose(expected, wanted_pairs)


def test_samples_do_not_depend_on_tasks(spark):
    """Ids that repeat with other texts give the same scores however the rows are dealt."""
    rnd = random.Random(12)
    good, bad = ["river", "stone", "light", "tree"], ["zzz", "qqq", "stone", "light"]
    prose = lambda stems: " ".join(rnd.choice(stems) for _ in range(30))
    rows = [(i % 40, prose(bad if i % 2 else good)) for i in range(160)] + [(3, None), (5, "")]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(7, 0, 0)], "doc_id long, quality int, toxic int")
    for operator, label in ((nb_svm.score_texts, "quality"), (toxic_spans.score_toxicity, "toxic")):
        found = []
        for order in (rows, rows[::-1]):
            docs = spark.createDataFrame(order, "doc_id long, text string").repartition(len(found) + 2)
            got = operator(docs.selectExpr("*", "text AS own"), labels, label, sample=15).collect()
            found.append(sorted((r.doc_id, r.own or "", r.score) for r in got))
        assert found[0] == found[1]
