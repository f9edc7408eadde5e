"""Name matching against a brute-force comparison of all pairs."""

import random
from itertools import product

import pytest
from test_functions import brute_common

from statloom.functions.text import first_two_words
from statloom.operators import fuzzy
from statloom.operators import metric_join as metric


def score(x, y):
    if not x or not y:
        return 0
    return int(round(100 * (2.0 * brute_common(x, y) / (len(x) + len(y)))))


def names(n, seed):
    rng = random.Random(seed)
    firsts = ["ben", "bruno", "manuel", "igor", "joao", "son", "li", "virgil"]
    lasts = ["mee", "fernandes", "ugarte", "silva", "felix", "van dijk", "heung min", "neto"]
    out = []
    for _ in range(n):
        text = f"{rng.choice(firsts)} {rng.choice(lasts)}"
        for _ in range(rng.choice([0, 1, 2, 4])):
            i = rng.randrange(len(text))
            text = text[:i] + rng.choice(["", "x", "e", "é"]) + text[i + rng.choice([0, 1]) :]
        if rng.random() < 0.3:
            text = " ".join(reversed(text.split()))
        out.append(text)
    return out + ["", "a", "!!", "o o o", "x" * 70, "x" * 69 + "y"]


def prepared(text):
    kept = "".join(c for c in text if not 0x80 <= ord(c) <= 0xFF)
    cleaned = "".join(c if c.isalnum() or c == "_" else " " for c in kept).lower()
    return " ".join(sorted(cleaned.split()))


def distance(x, y):
    return len(x) + len(y) - 2 * brute_common(x, y)


def test_distances_are_those_of_the_table():
    texts = ["ben mee", "", "größe \u0142 x", "a" * 200, "é", "ab" * 40, "fernandes bruno"]
    pivots = ["mee ben", "x", "fernandes bruno", "ab" * 31 + "a", "ba" * 50]
    got = metric.distances(pivots, texts)
    assert got.tolist() == [[distance(t, p) for p in pivots] for t in texts]


def test_runs_of_lengths():
    lengths = {1: 3, 2: 4, 5: 40, 9: 1, 12: 1}
    parts = metric.parts_of(lengths, 7)
    assert parts == [(1, 2, 1, 0), (5, 5, 6, 1), (9, 12, 1, 7)]
    for share in (0.01, 0.5, 0.695, 0.895, 0.995):
        for a, b in product(parts, parts):
            near = any(abs(n - m) <= metric.reach(n, m, share) for n in range(a.low, a.high + 1) for m in range(b.low, b.high + 1))
            assert metric.may_meet(a, b, share) == near


@pytest.mark.parametrize("threshold", [1, 50, 70, 80, 90, 100])
def test_pivots_lose_no_pair(threshold):
    """Whatever the pivots, pairs that reach the threshold stay, each once."""
    left, right = ({prepared(t) for t in names(60, seed)} - {""} for seed in (1, 2))
    left, right = sorted(left), sorted(right)
    share = max(threshold - 0.5, 1.0) / 100
    for pivots in ([], right[:1], right[::9], ["zzz", "x" * 70]):
        far = [metric.distances(pivots, side) for side in (left, right)]
        near = [(left[i], right[k]) for x, y in metric.near_pairs(left, right, *far, share) for i, k in zip(x, y, strict=True)]
        assert len(near) == len(set(near))
        assert {p for p in product(left, right) if score(*p) >= threshold} <= set(near)


def made_up(n, seed):
    rng = random.Random(seed)
    syllables = "ma ri jo an el ka ne to lu ce son ber vi do ha san mi ra le ti go fer nan des sil va bru no".split()
    word = lambda most: "".join(rng.choice(syllables) for _ in range(rng.randint(2, most)))
    found = set()
    while len(found) < n:
        found.add(" ".join(sorted([word(3), word(4)])))
    return sorted(found)


@pytest.mark.parametrize(("threshold", "most"), [(70, 0.5), (80, 0.35)])
def test_candidates_per_pair_fall_with_the_names(threshold, most):
    """The share of pairs that are scored falls as names, and with them pivots, multiply."""
    shares = []
    for n in (1_000, 16_000):
        right = made_up(n, 2)
        left = made_up(n, 1)[:: max(1, n // 150)]
        pivots = random.Random(5).sample(right, min(int(2 * n**0.5), metric.MOST_PIVOTS))
        far = [metric.distances(pivots, side) for side in (left, right)]
        scored = sum(len(x) for x, _ in metric.near_pairs(left, right, *far, (threshold - 0.5) / 100))
        shares.append(scored / (len(left) * len(right)))
    assert shares[1] < most * shares[0], shares


@pytest.mark.parametrize("threshold", [60, 75])
def test_pairs_over_several_blocks(spark, monkeypatch, threshold):
    monkeypatch.setattr(metric, "LEFT_BLOCK", 7)
    monkeypatch.setattr(metric, "RIGHT_BLOCK", 11)
    monkeypatch.setattr(metric, "SCORED", 5)
    left, right = (sorted({prepared(t) for t in names(70, seed)} - {""}) for seed in (5, 6))
    frames = [spark.createDataFrame([(t,) for t in side], "text string") for side in (left, right)]
    got = [tuple(r) for r in metric.similar_pairs(*frames, threshold).collect()]
    assert sorted(got) == sorted((x, y, score(x, y)) for x, y in product(left, right) if score(x, y) >= threshold)
    empty = frames[0].limit(0)
    assert metric.similar_pairs(empty, frames[1], 70).collect() == metric.similar_pairs(frames[0], empty, 70).collect() == []


@pytest.mark.parametrize("threshold", [70, 90])
def test_best_match_equals_all_pairs(spark, threshold):
    left, right = names(80, 3), names(60, 4)
    l_rows = spark.createDataFrame(list(enumerate(left)) + [(999, None)], "i int, name string")
    r_rows = spark.createDataFrame(list(enumerate(right)) + [(999, None)], "o int, known string")
    got = {
        r.i: (r.matched_name, r.match_score)
        for r in fuzzy.fuzzy_best_match(l_rows, r_rows, "name", "known", "o", threshold).collect()
    }
    assert len(got) == len(left) + 1 and got[999] == (None, None)
    for i, name in enumerate(left):
        scores = [score(prepared(name), prepared(r)) for r in right]
        top = max(scores)
        expected = (right[scores.index(top)], top) if top >= threshold else (None, None)
        assert got[i] == expected, name


def test_semi_and_anti_split_the_left_side(spark):
    left = spark.createDataFrame(
        [(1, "Sepp van den Berg"), (2, "Sepp Van"), (3, "Someone Else"), (4, "SEPP VAN DIJK")],
        "i int, name string",
    )
    right = spark.createDataFrame([(1, "sepp van b")], "o int, known string")
    args = (left, right, "name", "known", "o", 80)
    kept = fuzzy.fuzzy_semi(*args, shorten=first_two_words)
    rest = fuzzy.fuzzy_anti(*args, shorten=first_two_words)
    assert kept.columns == rest.columns == ["i", "name"]
    assert sorted(r.i for r in kept.collect()) == [1, 2, 4]
    assert [r.i for r in rest.collect()] == [3]


def test_hot_name_is_compared_once(spark):
    hot = spark.range(20_000).selectExpr("id AS i", "'Bruno Fernandez' AS name")
    right = spark.createDataFrame([(2, "Bruno Fernandes"), (1, "Fernandes Bruno")], "o int, known string")
    got = fuzzy.fuzzy_best_match(hot, right, "name", "known", "o", 90)
    assert [tuple(r) for r in got.groupBy("matched_name", "match_score").count().collect()] == [
        ("Fernandes Bruno", 93, 20_000)
    ]


def test_plan_has_no_cross_join(spark, monkeypatch):
    plans = []
    original = fuzzy.join_bounded

    def watch(big, small, keys, how="inner"):
        plans.append(small._jdf.queryExecution().optimizedPlan().toString())
        return original(big, small, keys, how)

    monkeypatch.setattr(fuzzy, "join_bounded", watch)
    left = spark.createDataFrame([(1, "ben mee")], "i int, name string")
    right = spark.createDataFrame([(1, "ben me")], "o int, known string")
    fuzzy.fuzzy_best_match(left, right, "name", "known", "o", 70)
    assert plans and not any("Join Cross" in p or "NestedLoop" in p for p in plans)
