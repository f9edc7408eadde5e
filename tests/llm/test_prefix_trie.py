import hashlib
import random
import zlib

import pytest

from statloom.llm import prefix_trie as trie

TURNS = "conv_id bigint, turn bigint, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns(seed=5, n=260, few=3):
    """Conversations that share first turns, with copies, gaps, odd values and one long one."""
    rnd = random.Random(seed)
    said = [("user", "hello there"), ("user", "größe 😀"), ("system", ""), (None, None), ("", "x\ny"), ("user", "u")][: few + 3]
    rows = []
    for c in rnd.sample(range(-30, 450), n):
        if c % 10 == 7:  # a large group of copies
            rows += [(c, k, "user", f"copied {k}") for k in range(8)]
            continue
        rows += [(c, k if rnd.random() < 0.9 else None, *rnd.choice(said)) for k in range(rnd.randint(1, 7))]
    rows += [(1000, k, "user", f"t{k % 11}") for k in range(900)] + [(1001, k, "user", f"t{k % 11}") for k in range(901)]
    rows += [rows[0], rows[0], (None, 1, "user", "nobody's"), (9_000_000_000_000, 1, "a", "b")]
    return rows


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    nodes = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        block = c - (abs(c) % 100) * (1 if c > 0 else -1)
        path = tuple(own.get(block, [])[:h] + said[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], ([], []))[0].append(c)
        nodes[path][1].append(c)
    below = {p: [0, 0, 0] for p in nodes}  # children, leaves, saved
    for p in sorted(nodes, key=len, reverse=True):
        mine = below[p]
        mine[1] = mine[1] or 1
        mine[2] += (len(nodes[p][0]) - 1) * (len(p[-1][1]) if p else 0)
        if p:
            up = below[p[:-1]]
            up[0], up[1], up[2] = up[0] + 1, up[1] + mine[1], up[2] + mine[2]
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]][0]) if p else None, len(m), *below[p],
         hashlib.sha256(",".join(map(str, sorted(e))).encode()).hexdigest())
        for p, (m, e) in nodes.items()
    )


def result(df):
    return sorted((tuple(r[c] for c in NAMES) for r in df.collect()), key=lambda r: (r[:2], r[2] or 0, r[3:]))


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_against_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(trie, "ENDS", 3)
    rows = turns()
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, TURNS).repartition(3)
    assert result(trie.prefix_trie(frame, shards=shards)) == sorted(brute(rows), key=lambda r: (r[:2], r[2] or 0, r[3:]))


def test_copies_are_divided(spark):
    """A group of copies lies in several shards, and its node is in the skeleton."""
    rows = [(c, k, "user", f"same {k}") for c in range(100, 400) for k in range(2)]
    paths = trie.conversation_paths(spark.createDataFrame(rows, TURNS), rebuilt=False)
    places = trie.splitters(paths, 8)
    assert len(places) == 7 and len({p for p, _ in places}) == 1 and len(trie.skeleton_of(places)) == 3


def test_cut_splitters(spark, monkeypatch):
    """Splitters that are cut off divide worse, but give the same nodes."""
    rows = turns(seed=9)
    monkeypatch.setattr(trie, "SPLITTER_BYTES", 9 * 16 * 3)
    frame = spark.createDataFrame(rows, TURNS)
    assert result(trie.prefix_trie(frame, shards=9)) == sorted(brute(rows), key=lambda r: (r[:2], r[2] or 0, r[3:]))


def test_whole_conversations(spark):
    rows = [(3, 1, "u", "a"), (3, 2, "u", "b"), (4, 1, "u", "a")]
    got = result(trie.prefix_trie(spark.createDataFrame(rows, TURNS), rebuilt=False, shards=2))
    assert [r[:7] for r in got] == [(3, 0, None, 2, 1, 1, 1), (3, 1, 3, 2, 1, 1, 1), (3, 2, 3, 1, 0, 1, 0)]


def test_empty_and_clashing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    rows = spark.createDataFrame([(7, 1, "u", "é" * 2_000_000, 5, "x")], TURNS + ", depth bigint, path string")
    got = result(trie.prefix_trie(rows))
    assert [r[:7] for r in got] in ([(7, 0, None, 1, 1, 1, 0), (7, 1, 7, 1, 0, 1, 0)], [(7, 0, None, 1, 0, 1, 0)])
