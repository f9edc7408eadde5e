import math
import random
import re
from collections import Counter

import pytest

from statloom.llm import license_scan as scan

DOCS = "doc_id bigint, text string"


def words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def texts(seed=6):
    rnd = random.Random(seed)
    plain = ["the", "software", "license", "größe", "of", "x1", "copy", "use", "mit", "under", "public", "général", "gnu"]
    out = []
    for i in range(140):
        said = []
        for _ in range(rnd.randint(0, 5)):
            said += [rnd.choice(plain) for _ in range(rnd.randint(0, 12))]
            own = words(rnd.choice(scan.TEMPLATES).text)
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):  # changed, lost and added words
                k = rnd.randrange(len(own))
                own[k : k + rnd.choice([0, 1, 1])] = [rnd.choice(plain)] if rnd.random() < 0.7 else []
            said += own[rnd.choice([0, 0, 0, 3]) : len(own) - rnd.choice([0, 0, 0, 2])]
        out.append("".join(w + rnd.choice([" ", " ", ", ", "\n", "-", "\x00"]) for w in said))
    out += ["Released under the MIT License.", "THE APACHE LICENSE general public license", "mit\x7flicense mit licenses", "MIT LİCENSE mit-license"]
    out += ["This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.", None, "", " \n", out[0], out[0]]
    return out


def brute(text):
    """Every template tried at every beginning."""
    own = words(text)
    base = sorted((i, label) for p, label in scan.BASE_PHRASES.items() for i in range(len(own)) if own[i : i + len(p.split())] == p.split())
    coded = [words(t.text) for t in scan.TEMPLATES]
    found = Counter(w for t in coded for w in set(t))
    idf = {w: math.log((1 + len(coded)) / n) for w, n in found.items()}
    places = []
    for t, said in zip(scan.TEMPLATES, coded, strict=True):
        anchors = sorted(range(len(said)), key=lambda q: (-idf[said[q]], q))[: scan.ANCHORS]
        at = lambda i: own[i] if 0 <= i < len(own) else None
        good = []
        for o in range(-len(said), len(own)):
            if sum(at(o + q) == said[q] for q in anchors) < max(1, math.ceil(scan.MEET * len(anchors))):
                continue
            near = own[max(o - scan.DRIFT, 0) : max(o + len(said) + scan.DRIFT, 0)]
            if not all(f" {k} " in f" {' '.join(near)} " for k in t.keys):
                continue
            stands = [q for q in range(len(said)) if any(at(o + q + e) == said[q] for e in range(-scan.DRIFT, scan.DRIFT + 1))]
            share = sum(idf[said[q]] for q in stands) / sum(idf[w] for w in said)
            if share >= scan.SHARE - 1e-12:
                good.append((-round(share, 9), o))
        taken = []
        for less, o in sorted(good):
            if all(abs(o - x) >= len(said) for x in taken):
                taken.append(o)
                places.append((t.label, max(o, 0), min(o + len(said), len(own)), -less))
    return len(own), base, sorted(places, key=lambda p: (p[1], p[0]))


@pytest.mark.parametrize("cut", [scan.CUT_BYTES, 7])
def test_against_brute_force(spark, monkeypatch, cut):
    monkeypatch.setattr(scan, "CUT_BYTES", cut)
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in scan.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        n, base, places = brute(text)
        r = got[i]
        assert (r.n_words, [(b.start, b.label) for b in r.base]) == (n, base)
        assert [(p.label, p.start, p.end, round(p.share, 9)) for p in r.places] == places, text
        assert r.labels == sorted({x[1] for x in base} | {p[0] for p in places})
        assert 0 <= r.score <= 1 and round(r.score, 9) == max([p[3] for p in places], default=0)


def test_query_digest(spark, monkeypatch):
    from statloom.llm import queries

    rows = list(enumerate(texts(seed=8)))
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, DOCS))
    for r in queries.op12_licenses(spark, "").collect():
        n, base, places = brute(rows[r.doc_id][1])
        starts, own = [s for s, _ in base], {x for _, x in base}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(own)) and r.labels == ",".join(sorted(own | {p[0] for p in places}))


def test_every_template_finds_itself():
    index = scan.Index(scan.TEMPLATES, scan.BASE_PHRASES, scan.ANCHORS, scan.MEET, scan.DRIFT, scan.SHARE)
    for t in scan.TEMPLATES:
        for around in ("", "some words before "):
            got = index.places(scan._coded(index, (around + t.text + " and after").encode()))
            assert (t.label, len(around.split()), len(around.split()) + len(words(t.text)), 1.0) in got


def test_long_text_with_many_places(spark):
    line = "x y Licensed under CC BY-NC 4.0. Released under the MIT License.\n"
    r = scan.scan_licenses(spark.createDataFrame([(1, line * 20_000)], DOCS)).first()
    assert (r.n_words, len(r.base), len(r.places), r.labels) == (280_000, 20_000, 40_000, ["cc-by-nc", "mit", "mit-notice"])


def test_empty_clashing_and_wrong_templates(spark):
    assert scan.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []
    frame = spark.createDataFrame([("a mit license", 5, "old", 2, None)], "text string, n_words int, labels string, Score int, base string")
    r = scan.scan_licenses(frame).first()
    assert (r.n_words, r.labels, r.score) == (3, ["mit"], 0.0) and len(r) == 5
    with pytest.raises(ValueError):
        scan.scan_licenses(frame, templates=[scan.Template("x", "some words", ("other words",))])
