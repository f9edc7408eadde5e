import random
import re
from collections import Counter

import numpy as np
import pytest

from statloom.llm import phrase_mining as mining

ROWS = "doc_id bigint, lang string, text string"


def corpus(seed=2, n=160):
    """Texts with set phrases, odd white space and odd letters, in languages of very different size."""
    rnd = random.Random(seed)
    words = ["the", "of", "Rain", "größe", "new", "york", "city", "a\x00b", "x\x1cy", "é", " ", "it's", "7"]
    words += ["w%d" % i for i in range(30)]
    rows = []
    for i in range(n):
        said = []
        for _ in range(rnd.randint(0, 60)):
            said.append(rnd.choice(["New York", "new york city hall", "of the"]) if rnd.random() < 0.2 else rnd.choice(words))
            said.append(rnd.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", " ? ", "\v", "\r\n"]))
        rows.append((i, rnd.choice(["en", "en", "en", "de", None, "und", ""]), "".join(said)))
    rows += [rows[3]] * 5 + [(None, "en", None), (1, "fr", ""), (2, "it", " .\n"), (3, "en", "new york " * 3_000)]
    return rows


def brute(rows, support, longest, covered, top):
    n, f = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    f = {p: c for p, c in f.items() if c >= support}
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        if any(g == lang and len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (g, q), b in f.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], r + 1, *x[1:]) for r, x in enumerate(own[:top])]
    return sorted(ranked)


@pytest.mark.parametrize(("support", "covered", "top", "size", "parts"), [(5, 100, 2000, 1 << 20, 3), (2, 60, 7, 900, 5), (30, 100, 50, 3_000, 2)])
def test_against_brute_force(spark, support, covered, top, size, parts):
    rows = corpus()
    frame = spark.createDataFrame(rows, ROWS).repartition(parts)
    got = mining.collocations(frame, support=support, covered=covered, top=top, slice_bytes=size).collect()
    assert sorted(map(tuple, got)) == brute(rows, support, 5, covered, top)


def test_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mining, "PART", 50)
    monkeypatch.setattr(mining, "CUT_BYTES", 9)
    monkeypatch.setattr(mining, "COUNTED_BYTES", 500)
    rows = corpus(seed=8)
    got = mining.collocations(spark.createDataFrame(rows, ROWS).coalesce(2), support=6, slice_bytes=1_500).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6, 5, 100, 2000)


def test_crowded_filter(spark, monkeypatch):
    """A filter that lets much through by chance changes nothing."""
    monkeypatch.setattr(mining, "FILTER_BYTES", 128)
    rows = corpus(seed=4)
    got = mining.collocations(spark.createDataFrame(rows, ROWS), support=4, slice_bytes=2_000).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 5, 100, 2000)


def test_shards_that_end_early(spark, monkeypatch):
    monkeypatch.setattr(mining, "REPORTS", 300)
    rows = corpus(seed=11)
    got = mining.collocations(spark.createDataFrame(rows, ROWS).coalesce(2), support=9, slice_bytes=1_000).collect()
    assert sorted(map(tuple, got)) == brute(rows, 9, 5, 100, 2000)


def test_local_bars_lose_nothing():
    """Some shard reaches its bar for every phrase that is frequent in all."""
    rnd = random.Random(1)
    for _ in range(300):
        sizes = [rnd.randint(1, 50) for _ in range(rnd.randint(1, 9))]
        counts = [rnd.randint(0, s) for s in sizes]
        support = max(1, sum(counts))
        assert sum(counts) < support or any(c >= mining.bar_of(support, s, sum(sizes)) for c, s in zip(counts, sizes, strict=True))


def test_mask_equals_sql(spark):
    h = np.array([0, -1, 1 << 62, -(1 << 63), 123456789012345], np.int64)
    frame = spark.createDataFrame([(int(x),) for x in h], "h long")
    blocks = mining.bit_filter(frame, 5)
    own = h.view(np.uint64)
    mask = mining._mask(own)
    at = ((own >> np.uint64(32)) & np.uint64(len(blocks) - 1)).astype(int)
    assert (blocks[at] & mask == mask).all()
    wanted = np.zeros(len(blocks), np.uint64)
    np.bitwise_or.at(wanted, at, mask)
    assert (wanted == blocks).all()


def test_wide_products(spark):
    """Products beyond 64 bits stay exact."""
    q = "SELECT (CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0)) * CAST(1000 AS DECIMAL(4, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0))) AS s"
    a, n, l, r = 98_765_432_109_876, 987_654_321_098_765, 98_765_432_109_877, 123_456_789_012_345
    got = spark.sql(f"{q} FROM (SELECT {a}L AS a, {n}L AS n, {l}L AS l, {r}L AS r)").first().s
    assert got == 1000 * a * n // (l * r)


def test_empty_and_clashing(spark):
    assert mining.collocations(spark.createDataFrame([], ROWS)).collect() == []
    rows = spark.createDataFrame([("a b " * 60, "en", 1, 2, "x")], "text string, lang string, n int, total int, h string")
    assert [tuple(r) for r in mining.collocations(rows, support=60, longest=2).collect()] == [("en", 1, "a b", 60, 60, 60, 120, 2000)]
