"""Scalar functions on edge rows."""

import math
import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statloom.functions import numeric as num
from statloom.functions import similarity as sim
from statloom.functions import text as txt
from statloom.plans.season import SPECIAL_NAMES


def apply(spark, function, values, data_type="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {data_type}")
    out = rows.select("i", function(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(out, key=lambda r: r.i)]


CASES = [
    (
        txt.parse_age,
        ["23-145", "23", "23.456", " 23-0 ", "1-2-3", "-5", "abc", "N/A", None, "", "1.5x", "23 - 4"],
        [23.4, 23.0, 23.46, 23.0, None, None, None, None, None, None, None, 23.01],
    ),
    (
        txt.last_word,
        ["eng ENG", "ENG", "", "  ", "N/A", None, " a b "],
        ["ENG", "ENG", None, None, None, None, "b"],
    ),
    (
        txt.clean_name,
        ["Salah, Mohamed", "A, B, C", "  Ben   Mee ", None, "N/A", "", "a,"],
        ["Mohamed Salah", "C B A", "Ben Mee", "N/A", "N/A", "", " a"],
    ),
    (
        txt.first_two_words,
        ["Sepp van den Berg", "Neto", " Neto ", None, "Ben Mee"],
        ["Sepp van", "Neto", " Neto ", "", "Ben Mee"],
    ),
    (
        lambda c: txt.first_and_last_word(c, SPECIAL_NAMES),
        ["Sepp van den Berg", "Igor Júlio", "Ben Mee", "J. Philogene", None],
        ["Sepp Berg", "Igor", "Ben Mee", "Jaden Philogene Bidace", None],
    ),
    (
        txt.parse_money,
        ["€41.6M", "£350K", "€1.0m", "900", "Free", "N/A", "", None, "€1,000K", " € 2M "],
        [41_600_000.0, 350_000.0, 1_000_000.0, 900.0, None, None, None, None, None, 2_000_000.0],
    ),
    (txt.main_role, ["FW,MF", "DF/MF", "GK", " MF , FW", None], ["FW", "DF", "GK", "MF", None]),
    (
        txt.position_bucket,
        ["DF,GK", "MF,FW", "Unknown", "FW", None],
        ["GK", "MF", None, "FW", None],
    ),
    (txt.first_word, ["Ben Mee", "N/A", None, " Neto"], ["Ben", "", "", "Neto"]),
    (
        num.strip_thousands,
        ["1,234", "1,234.5", "a,b", "-1,000", None, "Salah, Mo", "12"],
        ["1234", "1234.5", "a,b", "-1000", None, "Salah, Mo", "12"],
    ),
    (
        num.parse_number,
        ["1.5", " 2 ", "5d", "0x10", "NaN", "1e3", "", "abc", None, ".5", "7."],
        [1.5, 2.0, None, None, None, 1000.0, None, None, None, 0.5, 7.0],
    ),
]


@pytest.mark.parametrize("function, values, expected", CASES, ids=[str(i) for i in range(len(CASES))])
def test_text_and_number_functions(spark, function, values, expected):
    assert apply(spark, function, values) == expected


def test_rounding_follows_numpy(spark):
    values = [1.005, 0.125, 0.285, 2.675, -0.125, None]
    assert apply(spark, num.round2, values, "double") == [1.0, 0.12, 0.28, 2.68, -0.12, None]


def test_whole_numbers(spark):
    assert apply(spark, num.to_whole, [3.0, 3.5, None, 1e30], "double") == [3, None, None, None]
    with pytest.raises(PySparkException):
        apply(spark, lambda c: num.to_whole(c, strict=True), [3.0, 3.5], "double")


def test_clip_log_and_scale(spark):
    assert apply(spark, lambda c: num.clip(c, 1, 3), [0.0, 2.0, 9.0, None], "double") == [1, 2, 3, None]
    logs = apply(spark, num.log_positive, [-4.0, 0.0, math.e - 1, None], "double")
    assert logs[:2] == [0.0, 0.0] and abs(logs[2] - 1) < 1e-12 and logs[3] is None
    assert apply(spark, num.in_millions, [41_600_000.0], "double") == [41.6]


def test_cell_picks(spark):
    rows = spark.createDataFrame(
        [([" A\nB ", "C", " €1M "],), (["A", "B"],), (["A"],)], "cells array<string>"
    )
    got = rows.select(
        txt.cell_name(F.col("cells"), 0).alias("a"),
        txt.cell_name(F.col("cells"), 1).alias("b"),
        txt.cell_price(F.col("cells")).alias("p"),
    ).collect()
    assert [tuple(r) for r in got] == [("A", "C", "€1M"), ("A", "B", None), ("A", None, None)]


def brute_common(x, y):
    row = [0] * (len(y) + 1)
    for ch in x:
        new = [0]
        for j, other in enumerate(y, 1):
            new.append(row[j - 1] + 1 if ch == other else max(row[j], new[j - 1]))
        row = new
    return row[-1]


def test_pair_scores_equal_plain_table_filling():
    rng = random.Random(3)
    sizes = [0, 1, 3, 8, 9, 15, 33, 63, 64, 65, 90]
    texts = ["".join(rng.choice("abc é") for _ in range(rng.choice(sizes))) for _ in range(1200)]
    xs, ys = texts[:600], texts[600:]
    expected = [
        int(round(100 * (2.0 * brute_common(x, y) / max(1, len(x) + len(y))))) if x and y else 0
        for x, y in zip(xs, ys)
    ]
    assert sim.pair_scores(pd.Series(xs), pd.Series(ys)).tolist() == expected
    assert sim.pair_scores(pd.Series(ys), pd.Series(xs)).tolist() == expected


def test_token_sort_ratio(spark):
    pairs = [
        ("Manuel Ugarte", "ugarte  MANUEL"), ("manuel ugarte", "r manuel ugarte"), ("", "a"),
        ("Ødegaard", "degaard"), ("a-b", "b a"), (None, "a"),
    ]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    score = sim.token_sort_ratio(F.col("a"), F.col("b")).alias("s")
    got = {r.i: r.s for r in rows.select("i", score).collect()}
    assert got == {0: 100, 1: 93, 2: 0, 3: 100, 4: 100, 5: None}
