import random

import numpy as np
import pytest
import xxhash
from llm_data import low, words

from statloom.llm import simhash


def plain_fingerprint(text):
    own = words(low(text))
    shingles = [" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def components(marks, radius):
    """Least index of each component over all pairs."""
    label = list(range(len(marks)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(marks):
            for j in range(i):
                if (a ^ marks[j]).bit_count() <= radius and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_groups_against_brute_force(docs, rows):
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == len(rows)
    # per id, as ids repeat only in equal rows here
    texts = [(r[0], r[1]) for r in rows]
    marks = [plain_fingerprint(t) for _, t in texts]
    label = components(marks, 2)
    least = {}
    for (i, _), k in zip(texts, label):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    expected = sorted((str(i), f"{m:016x}", str(least.get(k))) for (i, _), m, k in zip(texts, marks, label))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    assert len({e[2] for e in expected}) < len(rows)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_distances(radius):
    rnd = np.random.default_rng(radius)
    marks = rnd.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rnd.choice(64, k, False))) for k in range(8)]
    block = np.concatenate([marks[:10] ^ f for f in flips] + [marks])
    found = simhash.within(marks, block, radius)
    wanted = np.bitwise_count(marks[:, None] ^ block[None]) <= radius
    assert (found == wanted).all() and wanted.any()


@pytest.mark.parametrize("block", [2, 7, 2048])
def test_chains_and_crowded_keys(spark, block):
    """A chain of single-bit steps is one component although its ends differ in many bits; many
    fingerprints share a key and are cut into blocks."""
    rnd = random.Random(1)
    chain = [rnd.getrandbits(64)]
    for b in rnd.sample(range(64), 40):
        chain.append(chain[-1] ^ (1 << b))
    crowd = [(7 << 40) | i for i in range(60)]
    alone = [rnd.getrandbits(64) for _ in range(30)]
    marks = list(dict.fromkeys(chain + crowd + alone))
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    frame = spark.createDataFrame([(s,) for s in signed], "__fp long")
    stars = {r.hi: r.lo for r in simhash.components(simhash.links(frame, 2, block)).collect()}
    label = components(marks, 2)
    least = {}
    for s, k in zip(signed, label):
        least[k] = min(s, least.get(k, s))
    assert [stars.get(s, s) for s in signed] == [least[k] for k in label]


def test_empty_table_and_clashing_columns(docs, no_docs, rows):
    assert simhash.simhash_groups(no_docs).count() == 0
    got = simhash.simhash_groups(docs.selectExpr("*", "1 as fingerprint", "2 as Component_ID"))
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "fingerprint", "component_id"] and got.count() == len(rows)


@pytest.mark.parametrize("together", [0, simhash.TOGETHER])
def test_few_edges_take_no_rounds(spark, monkeypatch, together):
    """Long chains, rings and stars with repeated edges; by rounds and in one task the same."""
    rnd, written = random.Random(4), []
    pairs = [(i + 1, i) for i in range(-30, 30)] + [(100 + i, 100 + (i * 7 + 1) % 40) for i in range(40)]
    pairs += [(200 + i, 200) for i in range(1, 25)] * 2 + [(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(60)]
    pairs = [(max(p), min(p)) for p in pairs if p[0] != p[1]]
    label = {n: n for p in pairs for n in p}
    while any(label[a] != label[b] for a, b in pairs):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    keep = simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df, name: written.append(name) or keep(df, name))
    frame = spark.createDataFrame(rnd.sample(pairs, len(pairs)), "hi long, lo long").repartition(5)
    got = simhash.components(frame, together).collect()
    assert sorted((r.hi, r.lo) for r in got) == sorted((a, b) for a, b in label.items() if a != b)
    assert (len(written) > 9) if not together else written == ["simhash-stars"]
    assert simhash.components(frame.where("false"), together).count() == 0
