import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash

from statloom.llm import line_templates as lt
from statloom.llm.common import mixed

D, L = "doc_id long, text string", {"texts": 3, "short_texts": 5, "short_words": 6, "least_words": 3}


def letter(word):
    """A word as the leaves count it: any word with a digit is the same one."""
    return xxhash.xxh64_intdigest("<*>" if any(c.isdigit() and c.isascii() for c in word) else word)


def line_hash(own):
    """The hash that ranks lines of equally many texts."""
    letters, place = np.array(own, np.uint64), np.arange(len(own), dtype=np.uint64)
    with np.errstate(over="ignore"):
        whole = mixed(letters + mixed(place + np.uint64(1))).sum(dtype=np.uint64) + mixed(np.array([len(own)]))[0]
    return int(np.array([whole], np.uint64).view(np.int64)[0])


def expected(rows, limits=L):
    """The method by plain loops: per line the template, then what recurs."""
    occ, texts_of = [], defaultdict(set)
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            own = tuple(letter(w) for w in re.findall(r"[^\x20\x09-\x0D]+", line))
            if len(own) >= limits["least_words"]:
                occ.append((i, k, own, t))
                texts_of[own].add(t)
    template = {}
    leaves = defaultdict(list)
    for own in texts_of:
        leaves[len(own), own[: lt.DEPTH]].append(own)
    for leaf, lines in leaves.items():
        if len(lines) < 2 or sum(len(texts_of[x]) for x in lines) < limits["texts"]:
            continue
        beyond = range(lt.DEPTH, leaf[0])
        need = max(1, math.ceil(lt.AGREE * max(leaf[0] - lt.DEPTH, 0) - 1e-9))
        rest = lines
        for number in range(lt.ROUNDS):
            if len(rest) < 2:
                break
            pattern = {}
            for pos in beyond:
                counts = Counter()
                for x in rest:
                    counts[x[pos] & 0xFFFF] += len(texts_of[x])
                texts, word = max((n, w) for w, n in counts.items())
                if texts >= lt.CONSTANT * sum(counts.values()):
                    pattern[pos] = word
            near = [x for x in rest if sum(x[pos] & 0xFFFF == w for pos, w in pattern.items()) >= need]
            for x in near:
                template[x] = (leaf, number)
            rest = [x for x in rest if x not in near]
        rest = sorted(rest, key=lambda x: (-len(texts_of[x]), line_hash(x)))
        while len(rest) > 0:
            seed = rest[0]
            mine = [x for x in rest if x == seed or sum(x[pos] == seed[pos] for pos in beyond) >= need]
            for x in mine:
                template[x] = (leaf, seed)
            rest = [x for x in rest if x not in mine]
    groups = defaultdict(list)
    for i, k, own, t in occ:
        groups[template.get(own, own), len(own)].append((i, k, t))
    dropped = defaultdict(set)
    for (_, n), members in groups.items():
        if len({m[2] for m in members}) >= (limits["short_texts"] if n < limits["short_words"] else limits["texts"]):
            first = min((m[:2] for m in members if m[0] is not None), default=None)
            for i, k, _ in members:
                if i is not None and (i, k) != first:
                    dropped[i].add(k)
    return dropped


def made_up(seed=6):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    common = [" ".join(word() for _ in range(9)) for _ in range(4)]
    passage = " ".join(word() for _ in range(70))
    rows = []
    for i in range(40):
        lines = [" ".join(word() for _ in range(rnd.randint(1, 14))) for _ in range(rnd.randint(1, 6))]
        if i % 3 == 0:
            lines.insert(rnd.randint(0, 1), common[i % 4])
        if i % 7 == 0:
            lines.append(passage)
        if i % 5 == 0:
            lines.append(f"user {i} logged in at 12:{i:02d} from host node{i} with key {word()} today")
        if i % 2 == 0:
            lines.append("all rights reserved" if i % 4 else "")
        # four words of which three lead, several lines of a template in one text, templates of equal weight
        lines.append(f"how to make {word()}")
        if i % 6 == 0:
            lines += [f"table row with values {word()} and more in it" for _ in range(3)]
        shape = [["red", "green", "blue", "white"], ["one", "two", "three", "four"], ["north", "south", "east", "west"]][i % 3]
        lines.append(" ".join(["see the list", *shape, word(), *shape, word()]))
        rows.append((i, "\n".join(lines)))
    rows += [(100 + k, rows[1][1]) for k in range(6)]  # exact copies count once
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, passage), (203, passage + "\n" + passage), rows[7], rows[7]]
    return rows


def test_against_plain_loops(spark):
    rows = made_up()
    docs = spark.createDataFrame(rows, D).repartition(4)
    got = lt.drop_recurring_lines(docs, **L).collect()
    want, texts = expected(rows), dict(rows)
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id]
        lines = [] if text is None else text.split("\n")
        drop = sorted(want[r.doc_id]) if r.doc_id is not None else []
        assert list(r.dropped) == drop, r.doc_id
        assert r.n_lines == len(lines)
        assert r.text == (None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in drop))
    assert sum(bool(v) for v in want.values()) > 15
    gone = "\n".join(texts[r.doc_id].split("\n")[k] for r in got for k in r.dropped)
    left = "\n".join(r.text or "" for r in got if r.doc_id is not None)
    assert "logged in" in gone and left.count("logged in") == 1  # variable fields do not hide a template
    passage = texts[203].split("\n")[0]
    own = max(texts[1].split("\n")[:-3], key=len)  # a line that only copies of one text have
    assert left.count(passage) == 1 and left.count(own) == 7
    assert left.count("how to make") == 40 + 6 + 2 and "table row with values" in gone and "see the list" in gone


def test_empty_table_clashing_columns_and_long_lines(spark):
    long = "w1 w2 w3 " + "many words in a row " * 20_000
    docs = spark.createDataFrame([(i, f"{long}\nown line of document number {i} alone {i * 7}") for i in range(4)], D)
    got = lt.drop_recurring_lines(docs.selectExpr("*", "1 as dropped", "2 as N_lines", "3 as line", "4 as leaf"))
    assert got.columns == ["doc_id", "text", "line", "leaf", "n_lines", "dropped"]
    assert sorted((r.doc_id, 0 in r.dropped) for r in got.collect()) == [(0, False), (1, True), (2, True), (3, True)]
    assert lt.drop_recurring_lines(docs.limit(0)).count() == 0


def crowded_leaf():
    """One leaf of many templates of equal weight with a spelled-out variable field, among unique lines."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    fields = [[word() for _ in range(8)] for _ in range(7)]
    lines = [["the", "weather", "in", *own[:3], word(), *own[3:]] for own in fields for _ in range(4)]
    lines += [["the", "weather", "in", *(word() for _ in range(9))] for _ in range(30)]
    lines += [["the", "weather", "in", *(word() if rnd.random() < 0.25 else w for w in fields[0]), word()] for _ in range(12)]
    rnd.shuffle(lines)
    return [(i, " ".join(line)) for i, line in enumerate(lines)]


def test_a_leaf_has_as_many_templates_as_it_holds(spark):
    rows = crowded_leaf()
    got = lt.drop_recurring_lines(spark.createDataFrame(rows, D).repartition(3), **L).collect()
    fields = Counter(t.split()[-1] for _, t in rows if t.split()[-1] != t.split()[-2])
    left = Counter(r.text.split()[-1] for r in got if r.text)
    for last, n in fields.items():
        if n == 4:  # the four lines of a template: its first stays
            assert left[last] == 1
    assert sum(not r.dropped for r in got if fields[rows[r.doc_id][1].split()[-1]] == 1) >= 30


def test_seeds_against_plain_loops(spark, monkeypatch):
    """In one task and in blocks, the most frequent remaining line takes all that agree with it."""
    rnd = random.Random(9)
    lines = [bytes(x for k in range(12) for x in (k if k < 3 else rnd.randrange(2), 0)) for _ in range(150)]
    lines = sorted(set(lines))
    rows = [(i * 7919 % 1009, 5, 12, x, rnd.randint(1, 3)) for i, x in enumerate(lines)]
    rows += [(5000 + i, 6, 12, x, 1) for i, x in enumerate(lines[:20])]
    want, need = set(), lt._needed(12, 0.7, 3)
    for leaf in (5, 6):
        rest = sorted((r for r in rows if r[1] == leaf), key=lambda r: (-r[4], r[0]))
        while rest:
            near = [r for r in rest if sum(a == b for a, b in zip(r[3][6::2], rest[0][3][6::2])) >= need]
            want.add(frozenset(r[0] for r in near))
            rest = [r for r in rest if r not in near]
    assert len(want) > 4
    frame = spark.createDataFrame([(a, b, c, bytearray(d), e) for a, b, c, d, e in rows], "line long, leaf long, n int, letters binary, texts long")
    for most in (lt.LEAF_LINES, 1):
        monkeypatch.setattr(lt, "LEAF_LINES", most)
        groups = defaultdict(set)
        for r in lt.seeded_templates(frame.repartition(3), 0.7, 3).collect():
            groups[r.template].add(r.line)
        assert {frozenset(g) for g in groups.values()} == want


def test_several_lines_of_one_text_count_once(spark):
    """Rows of a table in one text recur nowhere; the same rows in three texts do."""
    row = "the price of one kilogram of {} was high in that year"
    table = "\n".join(row.format(x) for x in ("rye", "oats", "wheat", "barley"))
    got = lt.drop_recurring_lines(spark.createDataFrame([(1, table), (2, "own words"), (3, table)], D)).collect()
    assert all(not r.dropped for r in got)
    more = [(i, table + f"\nmore {'of this ' * i}text") for i in (1, 2, 3)]
    got = {r.doc_id: list(r.dropped) for r in lt.drop_recurring_lines(spark.createDataFrame(more, D)).collect()}
    assert got == {1: [1, 2, 3], 2: [0, 1, 2, 3], 3: [0, 1, 2, 3]}


def test_leading_words_alone_make_no_template(spark):
    rows = [(i, f"How to make {'abcdefghijkl'[i] * 4}") for i in range(12)]
    assert all(not r.dropped for r in lt.drop_recurring_lines(spark.createDataFrame(rows, D)).collect())


def test_kept_lines_are_copied_once(spark):
    """Many lines, of which many go, in time that grows with them alone."""
    import time

    from pyspark.sql import functions as F

    from statloom.llm.line_templates import _kept

    made = spark.range(1).select(F.sequence(F.lit(0), F.lit(99_999)).alias("n"))
    made = made.select(F.transform("n", lambda x: x.cast("string")).alias("lines"), F.filter("n", lambda x: x % 3 != 1).alias("dropped"))
    start = time.perf_counter()
    kept = made.select(F.array_join(_kept(F.split(F.array_join("lines", "\n"), "\n", -1), F.col("dropped")), ",")).first()[0]
    assert kept == ",".join(str(i) for i in range(1, 100_000, 3)) and time.perf_counter() - start < 20
    one = spark.sql("SELECT array('a') AS l, array(0) AS d UNION ALL SELECT array('a', 'b', 'c'), array(0, 2)")
    assert sorted(r[0] for r in one.select(_kept(F.col("l"), F.col("d"))).collect()) == [[], ["b"]]


def cut(texts):
    """The rows of ``lt._lines``, and the most bytes that Python and numpy held meanwhile."""
    import tracemalloc

    kinds = {"id": pa.int64(), "text_hash": pa.int64(), "line_no": pa.int32(), "line": pa.int64(), "leaf": pa.int64()}
    schema = pa.schema([*kinds.items(), ("n", pa.int32()), ("letters", pa.binary())])
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["id", "text"])
    tracemalloc.start()
    try:
        out = list(lt._lines("id", "text", 3, 3, schema)(iter([batch])))
        return pa.Table.from_batches(out, schema), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_task_does_not_grow_with_its_batch(spark, monkeypatch):
    """8 MB in many texts, and in one, are cut bit by bit; so are the rows that go to Python."""
    rnd = random.Random(3)
    lines = [" ".join(rnd.choices(("of", "the", "and", "a1", "words", "ünd"), k=40)) for _ in range(200)]
    texts = ["\n".join(lines[(i + k) % 200] for k in range(20)) for i in range(2_000)]
    for given in (texts, ["\n".join(texts)]):
        rows, held = cut(given)
        assert rows.num_rows == 40_000 and held < 80 << 20
    confs, write = [], lt.materialize
    monkeypatch.setattr(lt, "materialize", lambda df, label: confs.append((label, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))) or write(df, label))
    lt.drop_recurring_lines(spark.createDataFrame(made_up(), D))
    assert [int(n) for label, n in confs if label == "lines"] == [lt.BATCH_ROWS]
    assert confs[-1][1] == spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(lt.BATCH_ROWS)


def test_lines_do_not_depend_on_where_texts_are_cut(monkeypatch):
    texts = [t for _, t in made_up()] + ["\n", "a b\x1cc d\r\n  x1 y2\t z \x0bw\n\nq", "ends in words of a line\n"]
    whole, _ = cut(texts)
    for most in (1, 40, 1_000):
        monkeypatch.setattr(lt, "CHUNK", most)
        assert cut(texts)[0].equals(whole)
    want = [(i, k, line_hash([letter(w) for w in own])) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if len(own := re.findall(r"[^\x20\x09-\x0D]+", x)) > 2]
    assert list(zip(*(whole[c].to_pylist() for c in ("id", "line_no", "line")), strict=True)) == want


def test_words_and_bands_of_long_lines_come_in_small_batches():
    rnd = np.random.default_rng(5)
    letters = [rnd.integers(0, 60_000, 1_003, dtype=np.uint16).tobytes() for _ in range(600)]
    kinds = {"leaf": pa.int64(), "line": pa.int64(), "n": pa.int32(), "texts": pa.int64(), "letters": pa.binary()}
    columns = [[7] * 600, list(range(600)), [1_003] * 600, [1] * 600, letters]
    batch = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))
    cells = list(lt._cells(iter([batch])))
    assert sum(b.num_rows for b in cells) == 600 * 1_003 and max(b.num_rows for b in cells) <= lt.CHUNK_WORDS
    rows = copies = 0
    for b in lt._banded(0.7, 3)(iter([batch.slice(0, 20)])):
        assert b.nbytes < 2 * lt.CHUNK
        rows, copies = rows + b.num_rows, copies + sum(x in letters for x in b.column("letters").to_pylist())
    assert rows == copies == 20 * 301
