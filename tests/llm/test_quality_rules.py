import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import low, words

from statloom.llm import quality_rules as q


def base(text):
    own = words(text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    found, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if found[w] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(hit)


def histograms(text, lang):
    t = text or ""
    chars = [sum(c in cls for c in t) for cls in q.CLASSES.values()]
    chars.append(len(t) - sum(chars))
    listed = q.COMMON_WORDS[lang].split() if lang in q.COMMON_WORDS else q.ALL_WORDS
    counts = Counter(low(w) for w in words(t))
    commons = [counts[w] for w in listed]
    return np.array(chars, float), np.array([*commons, len(words(t)) - sum(commons)], float)


def distance(p, r):
    p, r = p / max(p.sum(), 1), r / max(r.sum(), 1)
    m = (p + r) / 2
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt(max((part(p) + part(r)) / 2, 0))


def test_against_brute_force(docs, rows):
    limits = {"char_limit": 0.25, "char_least": 40, "word_limit": 0.3, "word_noise": 0.1, "word_least": 30, "reference_least": 0}
    got = q.quality_rules(docs, **limits, keep_text=True).collect()
    assert len(got) == len(rows)
    measured = {(r[1], r[2]): base(r[1]) for r in rows}
    failed = {k: n < 50 or 100 * rep > 50 * n for k, (n, *_, rep) in measured.items()}
    refs = {}
    for _, text, lang, *_ in rows:
        if not failed[text, lang]:
            ref = lang or ""
            both = histograms(text, lang)
            refs[ref] = both if ref not in refs else tuple(a + b for a, b in zip(refs[ref], both))
    assert any(failed.values()) and not all(failed.values())
    for r in got:
        key = (r.text, r.lang)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measured[key]
        assert r.base_failed == failed[key]
        chars, commons = histograms(*key)
        far = False
        for counts, ref, least, limit, said in (
            (chars, 0, 40, 0.25, r.char_distance), (commons, 1, 30, 0.3, r.word_distance),
        ):
            if counts.sum() < least or (r.lang or "") not in refs:
                assert said is None
                continue
            expected = distance(counts, refs[r.lang or ""][ref])
            assert said == pytest.approx(expected, abs=1e-9)
            far |= expected > limit + (0.1 / math.sqrt(r.n_words) if ref else 0)
        assert r.kept == (not r.base_failed and not far)
    assert {r.kept for r in got} == {True, False}


def test_empty_table_and_clashing_columns(spark, docs, no_docs, rows):
    assert q.quality_rules(no_docs).count() == 0
    clashing = docs.selectExpr("*", "1 as kept", "2 as Chars", "3 as n_words", "4 as ref_lang", "'x' as more")
    got = q.quality_rules(clashing)
    assert got.count() == len(rows)
    assert {c.lower() for c in got.columns} >= {"more", "kept", "n_words"} and len(got.columns) == len(set(map(str.lower, got.columns)))
    assert dict(got.dtypes)["kept"] == "boolean"


def test_long_text(spark):
    one = spark.createDataFrame([(1, "wörter und so weiter " * 100_000, "de")], "doc_id long, text string, lang string")
    row = q.quality_rules(one).first()
    assert (row.n_words, row.word_chars, row.n_repeat_words) == (400_000, 1_700_000, 400_000) and row.base_failed


def test_every_language_has_its_own_reference(spark):
    """A language far below 0.1 % of the documents, in another script, is not held against others."""
    rnd = random.Random(5)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8)))
    prose = lambda letters: " ".join(word(letters) for _ in range(60))
    rows = [(i, prose("aeioulrnst"), "en") for i in range(3000)]
    rows += [(5000 + i, prose("aeioulrnst"), f"r{i % 20}") for i in range(40)]
    rows += [(9000 + i, prose("абвгдежзик"), "ru") for i in range(2)] + [(9100, prose("абвгдежзик"), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in q.quality_rules(docs, reference_least=0).collect()}
    assert len(got) == len(rows) and all(r.kept for r in got.values())
    assert got[9000].char_distance < 0.1 and got[9100].char_distance == pytest.approx(0, abs=1e-9)
    few = {r.doc_id: r for r in q.quality_rules(docs).collect()}
    assert few[9000].char_distance is None and few[9000].kept and few[0].char_distance is not None


def test_sql_with_rare_languages(spark, tmp_path):
    """The SQL has a reference per language too, and none where the language has too few words."""
    import duckdb

    from statloom.llm.queries import op1_divergence
    from statloom.llm.queries_sql import ORACLE

    rnd = random.Random(7)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8)))
    rows = []
    for i in range(400):
        lang = rnd.choice(["en"] * 20 + ["ru", "xx", None, "de"])
        letters = "абвгдежзик" if lang == "ru" else "aeioulrnst"
        said = [rnd.choice(["the", "of", "und", word(letters), word(letters)]) for _ in range(rnd.randint(0, 220))]
        junk = [rnd.choice("#$%&0123456789") * rnd.randint(1, 5) for _ in said]
        rows.append((i, " ".join(junk if rnd.random() < 0.1 else said) if i % 50 else None, lang))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = con.execute(ORACLE["op1_divergence"])
    names = [c[0] for c in found.description]
    got = sorted(tuple(r) for r in op1_divergence(spark, str(tmp_path)).select(*names).collect())
    assert got == sorted(found.fetchall()) and {r[-1] for r in got} == {True, False}
