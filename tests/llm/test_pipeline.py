"""The pipeline against its stages written as plain loops."""

import random

import numpy as np
import pytest
from llm_data import DOCS, words
from test_decontaminate import expected as without_benchmark
from test_line_templates import expected as recurring
from test_quality_rules import base, distance, histograms
from test_simhash import components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from statloom.llm import line_templates, quality_rules, tokens

LINES = {
    "texts": line_templates.TEXTS,
    "short_texts": line_templates.SHORT_TEXTS,
    "short_words": line_templates.SHORT_WORDS,
    "least_words": line_templates.LEAST_WORDS,
}


def made_up():
    rnd = random.Random(8)
    stems = ["the", "of", "and", "to", "in"] + ["".join(rnd.choice("aeioulrnst") for _ in range(6)) for _ in range(120)]
    prose = lambda n: " ".join(rnd.choice(stems) for _ in range(n))
    passage, item = prose(60), prose(30)
    texts = []
    for i in range(45):
        lines = [prose(rnd.randint(12, 40)) for _ in range(rnd.randint(2, 6))]
        if i % 6 == 0:
            lines.insert(1, passage)
        if i % 9 == 0:
            lines[-1] += " " + item[: len(item) // 2 if i % 2 else None] + " " + prose(3)
        texts.append("\n".join(lines))
    texts += [texts[3]] * 3 + [texts[5] + " ", "short text", "", None, "#$% " * 200, "again and again " * 90]
    rows = [(i, t, "en" if i % 4 else "xx", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, prose(80), "en", "s", 1), (99, prose(90), None, None, None)]
    return rows, [(1, item), (2, prose(25)), (3, None)]


def by_loops(rows, items):
    # quality rules
    failed = {r[1]: (lambda m: m[0] < 50 or 100 * m[4] > 50 * m[0])(base(r[1])) for r in rows}
    refs = {}
    for r in rows:
        if not failed[r[1]]:
            both = histograms(r[1], r[2])
            refs[r[2]] = tuple(a + b for a, b in zip(refs.get(r[2], (0, 0)), both))
    kept = []
    for r in rows:
        if failed[r[1]]:
            continue
        chars, commons = histograms(r[1], r[2])
        ref, limit = refs[r[2]], quality_rules.WORD_LIMIT + quality_rules.WORD_NOISE / commons.sum() ** 0.5
        judged = ref[1].sum() >= quality_rules.REFERENCE_LEAST
        far = judged and chars.sum() >= quality_rules.CHAR_LEAST and distance(chars, ref[0]) > quality_rules.CHAR_LIMIT
        far |= judged and commons.sum() >= quality_rules.WORD_LEAST and distance(commons, ref[1]) > limit
        if not far:
            kept.append((r[0], r[1]))
    # line dedup
    gone = recurring(kept, LINES)
    cut = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if i is None or k not in gone[i])) for i, t in kept]
    # near duplicates
    label = components([plain_fingerprint(t) for _, t in cut], 2)
    least = {}
    for (i, _), k in zip(cut, label):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    single = {i: t for (i, t), k in zip(cut, label) if i is not None and least[k] == i}
    left = [*single.items(), *((i, t) for i, t in cut if i is None)]
    # decontamination
    return [(w[0], w[5]) for w in without_benchmark(left, items)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rows, items = made_up()
    d = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_whole_pipeline(spark, sf_dir):
    rows, items = made_up()
    wanted = by_loops(rows, items)
    assert len(wanted) < len({r[0] for r in rows})
    whole = Tokenizer.from_file(tokens.default_path())
    want = sorted((i, whole.encode(t, add_special_tokens=False).ids + [2]) for i, t in wanted)
    docs = {}
    for p in corpus_pipeline.run(spark, sf_dir).collect():
        docs.setdefault(str(p.doc_id), []).append(p)
    made = []
    for i, pieces in docs.items():
        pieces = sorted(pieces, key=lambda p: p.start)
        made.append((i, np.concatenate([np.frombuffer(p.ids, "<u4") for p in pieces]).tolist()))
    assert sorted(made) == want
    before = {str(r[0]): len(words(r[1])) for r in rows}
    assert any(len(words(t)) < before[i] for i, t in wanted)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing",
    ]


def test_queries_are_registered():
    from __spark_entry__ import queries

    names = [n for n in queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted(["pipeline", *(f"op{i}" for i in range(1, 14))])
