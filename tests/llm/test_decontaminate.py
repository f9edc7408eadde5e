import re

import numpy as np
import pytest
from llm_data import low

from statloom.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def items_of(rows):
    def cut(i, a, b):
        return " ".join(WORD.findall(low(rows[i][1]))[a:b])

    long = next(i for i, r in enumerate(rows) if r[1] and len(r[1].split()) > 3000)
    return [
        (1, cut(long, 100, 140).upper()), (2, cut(long, 130, 150)), (10, cut(0, 0, 12)), (11, cut(0, 0, 12)),
        (3, "no such words here at all but more than ten of them"), (4, "x"), (5, "..."), (6, None), (None, "the"),
        (7, cut(3, 2, 6)), (1, cut(long, 500, 515)), (8, "river"),
    ]


def expected(rows, items, window=10):
    windows = {}
    for i, text in items:
        own = WORD.findall(low(text))
        if i is None or not own:
            continue
        size = min(window, len(own))
        for k in range(len(own) - size + 1):
            windows.setdefault(tuple(own[k : k + size]), set()).add(str(i))
    out = []
    for r in rows:
        found = list(WORD.finditer(low(r[1])))
        own, hit, names = [m[0] for m in found], [False] * len(found), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in windows:
                    names |= windows[tuple(own[k : k + size])]
                    hit[k : k + size] = [True] * size
        spans = []
        for k, h in enumerate(hit):
            if h and k and hit[k - 1]:
                spans[-1][1] = found[k].end()
            elif h:
                spans.append([found[k].start(), found[k].end()])
        left = r[1]
        for a, b in reversed(spans):
            left = left[:a] + left[b:]
        out.append((str(r[0]), len(own), sum(hit), sorted(names), spans, left))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 22, 150])
def test_against_brute_force(spark, docs, rows, block):
    items = items_of(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = d.decontaminate(docs, bench, remove=True, item_block=block).collect()
    made = [
        (str(r.doc_id), r.n_words, r.n_hit, list(r["items"]), [[s.start, s.end] for s in r.spans], r.text) for r in got
    ]
    want = expected(rows, items)
    assert sorted(made, key=repr) == want
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in got)
    assert sum(w[2] > 0 for w in want) > 5 and any(len(w[3]) > 2 for w in want)


def test_windows_only(spark, docs, rows):
    items = [x for x in items_of(rows) if x[0] in (1, 2, 10, 11)]
    got = d.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    made = sorted(((str(r.doc_id), r.n_hit, list(r["items"])) for r in got), key=repr)
    assert made == sorted(((w[0], w[2], w[3]) for w in expected(rows, items)), key=repr)


def test_index_finds_every_occurrence():
    rnd = np.random.default_rng(5)
    for letters, n in ((2, 400), (5, 700), (40, 900)):
        text = np.concatenate([rnd.integers(0, letters + 1, n), np.tile([1, 2, 1], 60), [0]])
        index = d.FmIndex(text)
        for size in (1, 2, 3, 7):
            asked = np.array([rnd.integers(1, letters + 3, size) for _ in range(50)] + [np.tile([1, 2, 1], 3)[:size]])
            which, low_, high = index.search(asked)
            found = {i: set() for i in range(len(asked))}
            for i, a, b in zip(which, low_, high):
                found[i] = set(index.locate(np.arange(a, b)).tolist())
            for i, w in enumerate(asked):
                assert found[i] == {k for k in range(len(text) - size + 1) if (text[k : k + size] == w).all()}


def test_empty_tables_and_clashing_columns(spark, docs, no_docs, rows):
    bench = spark.createDataFrame(items_of(rows), "item_id long, text string")
    assert d.decontaminate(no_docs, bench).count() == 0
    clean = d.decontaminate(docs, bench.limit(0))
    assert clean.count() == len(rows) and clean.filter("n_hit > 0 or contaminated").count() == 0
    clashing = d.decontaminate(docs.selectExpr("*", "1 as items", "2 as Spans", "3 as item_id"), bench, remove=True)
    assert clashing.columns == [
        "doc_id", "lang", "source", "n_chars", "item_id", "text", "n_words", "n_hit", "n_items", "items", "spans", "contaminated",
    ]
    assert clashing.count() == len(rows)
