"""Operators against plain Python on small rows, and against their own limits."""

import random
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom import storage
from statloom.operators import features, histogram, merge, ordering, profile, ranking, schema
from statloom.operators.median import narrowed_medians
from statloom.storage import join_bounded, materialize


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- schema --------------------------------------------------------------------------------------


def test_rename_keeps_first_of_equal_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out = schema.rename_columns(df, {"a": "x", "b": "x", "zz": "y"})
    assert out.columns == ["x", "c"] and tuple(out.first()) == (1, 3)
    assert schema.first_of_names(["p", "q", "p"]) == [(0, "p"), (1, "q")]


def test_names_with_signs(spark):
    df = spark.createDataFrame([("N/A", "1.239", 5)], "`Save%` string, `a.b` string, `Gls per 90` int")
    out = schema.coerce(df, ["Gls per 90"], ["a.b", "Save%"])
    assert tuple(out.first()) == (None, 1.24, 5)
    assert tuple(schema.zero_fill(df, ["Save%"]).first())[0] == 0.0
    long = schema.unpivot_stats(out, ["Gls per 90"], ["Save%", "a.b"])
    assert rows_of(long, "stat") == [(5, "Save%", None), (5, "a.b", 1.24)]
    assert schema.in_order(df, ["a.b", "none", "Save%"]).columns == ["a.b", "Save%"]


def test_conform_adds_typed_defaults(spark):
    out = schema.conform(spark.range(1), {"id": "bigint", "m": "double", "t": "string"})
    assert tuple(out.first()) == (0, None, "")
    assert dict(out.dtypes) == {"id": "bigint", "m": "double", "t": "string"}


def test_sort_by_first_word(spark):
    df = spark.createDataFrame([("Zoe A",), ("N/A",), ("Al Z",), ("Al B",)], "n string")
    assert [r.n for r in schema.sort_by_first_word(df, "n").collect()] == ["N/A", "Al B", "Al Z", "Zoe A"]


# --- merge ---------------------------------------------------------------------------------------


def test_dedup_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert rows_of(merge.dedup(df, ["k"], ["o"]), "k") == [("a", 1, "y"), ("b", 5, "z")]
    assert rows_of(merge.dedup(df, ["k"], ["o"], "last"), "k") == [("a", 2, "x"), ("b", 5, "z")]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = merge.dedup(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge_keeps_all_keys_or_those_of_a_leading_table(spark):
    one = spark.createDataFrame([("a", 1, 7), ("b", 2, 8), (None, 5, 5)], "k string, x int, both int")
    two = spark.createDataFrame([("b", 3, 9), ("c", 4, None), (None, 6, 6)], "k string, y int, both int")
    three = spark.createDataFrame([("c", "t")], "k string, z string")
    every = merge.merge_wide({"a": one, "b": two, "c": three}, "k")
    assert every.columns == ["k", "x", "both_x", "y", "both_y", "z"]
    expected = [
        ("a", 1, 7, None, None, None), ("b", 2, 8, 3, 9, None), ("c", None, None, 4, None, "t"),
        (None, 5, 5, None, None, None), (None, None, None, 6, 6, None),
    ]
    assert set(map(tuple, every.collect())) == set(expected)
    for lead, held in enumerate((1, 3, 5)):  # a column of each table
        led = merge.merge_wide([one, two, three], "k", lead=lead)
        assert led.columns == every.columns
        assert set(map(tuple, led.collect())) == {r for r in expected if r[held] is not None}


@pytest.mark.parametrize("lead", [None, 0, 1])
@pytest.mark.parametrize("first", [True, False])
def test_merge_fails_or_skips_on_a_repeated_key(spark, lead, first):
    one = spark.createDataFrame([("a", 1)], "k string, x int")
    bad = spark.createDataFrame([("a", 1), ("a", 2)], "k string, y int")
    frames = [bad, one] if first else [one, bad]
    with pytest.raises(Exception, match="repeats"):
        merge.merge_wide(frames, "k", lead=lead).collect()
    if lead is None:
        skipped = merge.merge_wide(frames, "k", on_repeat="skip")
        assert skipped.columns == frames[0].columns and skipped.count() == frames[0].count()
    with pytest.raises(ValueError):
        merge.assert_unique(bad, ["k"])


@pytest.mark.parametrize("max_rows, sketched", [(100, False), (0, False), (0, True)])
def test_join_bounded_same_result_broadcast_or_salted(spark, max_rows, sketched):
    big = spark.createDataFrame([("h", i) for i in range(50)] + [(None, 50), ("q", 51)], "k string, i int")
    small = spark.createDataFrame([("h", 1.0), (None, 2.0)], "k string, m double")
    left = join_bounded(big, small, ["k"], "left", max_rows=max_rows, salts=4, sketched=sketched)
    got = {r.i: r.m for r in left.collect()}
    assert got == {**{i: 1.0 for i in range(50)}, 50: 2.0, 51: None}
    assert join_bounded(big, small, ["k"], max_rows=max_rows, salts=4, sketched=sketched).count() == 51


def test_only_hot_keys_are_salted(spark):
    """One key has half of the rows: it alone is repeated, and its rows spread over the tasks."""
    big = spark.range(40_000).selectExpr("if(id % 2 = 0, 7, 100 + id % 10000) AS k", "id AS i", "1 AS __k0")
    small = spark.range(12_000).selectExpr("id AS k", "id * 2 AS m")
    hot = storage.hot_keys(big, ["k"])
    assert hot == [r.h for r in spark.sql("SELECT xxhash64(7L) AS h").collect()]
    assert storage._repeated(small, ["k"], hot, 8).count() == 12_000 + 7
    joined = join_bounded(big, small, ["k"], max_rows=0, salts=8, sketched=True)
    assert joined.count() == 40_000 and joined.where("m <> 2 * k").isEmpty()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert f"{hot[0]}" in plan and "__salt" in plan and "__copy" in plan


def test_without_hot_keys_nothing_is_salted(spark):
    big = spark.range(5_000).selectExpr("id % 2500 AS k", "id AS i")
    small = spark.range(2_600).selectExpr("id AS k", "id * 2 AS m")
    assert storage.hot_keys(big, ["k"]) == [] and storage.hot_keys(big.limit(0), ["k"]) == []
    joined = join_bounded(big, small, ["k"], "left", max_rows=0, sketched=True)
    assert joined.columns == ["k", "i", "m"] and joined.count() == 5_000 and joined.where("m <> 2 * k").isEmpty()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "__salt" not in plan


def test_keys_of_two_types_or_fractions_are_salted_whole(spark):
    big = spark.range(3_000).selectExpr("cast(if(id % 2 = 0, 7, id) AS int) AS k", "if(id % 3 = 0, -0.0D, 0.0D) AS f")
    small = spark.range(3_000).selectExpr("id AS k", "id AS m")
    assert join_bounded(big, small, ["k"], max_rows=0, sketched=True).count() == 3_000
    zero = spark.sql("SELECT 0.0D AS f, 1 AS m")
    assert join_bounded(big, zero, ["f"], max_rows=0, sketched=True).count() == 3_000


def test_lookup_default_only_for_absent_keys(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    entries = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, o int, v string")
    assert rows_of(merge.lookup(left, entries, "k", "v", ["o"]), "k") == [("a", "x"), ("b", None), ("c", None)]
    last = merge.lookup(left, entries, "k", "v", ["o"], "last", "none")
    assert rows_of(last, "k") == [("a", "y"), ("b", None), ("c", "none")]


# --- medians and profiles ------------------------------------------------------------------------


def sample(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = rng.choice(["hot", "hot", "hot", "cold", None])
        zero_heavy = 0.0 if rng.random() < 0.6 else round(rng.uniform(-5, 5), 2)
        rows.append((group, round(rng.gauss(0, 100), 3), zero_heavy, rng.choice([None, 1.0, 2.0, 3.0])))
    rows.append(("single", 4.0, 4.0, None))
    return rows


def expected_medians(rows, by_group):
    held = defaultdict(list)
    for group, *values in rows:
        for stat, v in zip("abc", values):
            if v is not None:
                held[(group, stat) if by_group else stat].append(v)
    return {k: statistics.median(v) for k, v in held.items()}


@pytest.mark.parametrize("limit", [10, 100_000])
def test_narrowed_medians_equal_plain_ones(spark, limit):
    rows = sample(3000)
    df = materialize(spark.createDataFrame(rows, "g string, a double, b double, c double"), "t")
    got = {(r.g, r.stat): r["median"] for r in narrowed_medians(df, ["g"], list("abc"), limit).collect()}
    assert got == expected_medians(rows, True)
    got = {r.stat: r["median"] for r in narrowed_medians(df, [], list("abc"), limit).collect()}
    assert got == expected_medians(rows, False)


def test_medians_recover_when_the_bracket_misses(spark, monkeypatch):
    import statloom.operators.median as median

    monkeypatch.setattr(median, "BRACKET", 0.0)
    monkeypatch.setattr(median, "ACCURACY", 2)
    rows = sample(400, seed=8)
    df = spark.createDataFrame(rows, "g string, a double, b double, c double")
    got = {(r.g, r.stat): r["median"] for r in median.narrowed_medians(df, ["g"], list("abc"), 20).collect()}
    assert got == expected_medians(rows, True)


def test_profile_paths_agree_and_follow_the_total_row(spark):
    rows = [r for r in sample(600) if r[0] is not None]
    df = schema.zero_fill(spark.createDataFrame(rows, "g string, a double, b double, c double"), "abc")
    in_memory = profile.rollup_profile(df, "g", list("abc"))
    narrowed = profile.rollup_profile(df, "g", list("abc"), in_memory=0, sorted_values=20)
    one, two = [tuple(r) for r in in_memory.collect()], [tuple(r) for r in narrowed.collect()]
    assert one == two and [r[0] for r in one] == ["all", "cold", "hot", "single"]
    single = one[-1]
    assert single[1:4] == (4.0, 4.0, None)
    values = [r[1] for r in rows]
    whole = profile.group_profile(df, None, ["a"]).first()
    assert abs(whole["Std of a"] - statistics.stdev(values)) <= 0.0051


def test_result_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(sample(500), "g string, a double, b double, c double")
    results = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        out = profile.group_profile(df.repartition(n), "g", list("abc"))
        results.append(sorted(map(repr, out.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert results[0] == results[1]


# --- rankings ------------------------------------------------------------------------------------


def brute_ranking(rows, stats, n):
    out = set()
    for i, s in enumerate(stats):
        cells = [(r[2 + i], r[0], r[1]) for r in rows]
        top = sorted(cells, key=lambda c: (-c[0], c[1]))[:n]
        zero = all(c[0] == 0 for c in cells)
        low = sorted([c for c in cells if zero or c[0] > 0])[:n]
        for direction, picked in (("Highest", top), ("Lowest", low)):
            for place, (v, e, g) in enumerate(picked, 1):
                label = {1: "1st", 2: "2nd", 3: "3rd"}.get(place, f"{place}th")
                out.add((s, direction, label, e, g, v))
    return out


def test_top_bottom_equals_full_sort(spark):
    rng = random.Random(2)
    rows = [
        (f"p{i:03d}", rng.choice("xyz"), rng.gauss(0, 5), float(rng.choice([0, 0, 35, -1])), 0.0,
         1.0 if i in (3, 9) else 0.0)
        for i in range(400)
    ]
    stats = ["normal", "tied", "none", "few"]
    df = spark.createDataFrame(rows, "e string, g string, " + ", ".join(f"{s} double" for s in stats))
    for n in (3, 12):
        got = {tuple(r) for r in ranking.top_bottom_n(df, "e", "g", stats, n).collect()}
        assert got == brute_ranking(rows, stats, n)


def test_rank_labels(spark):
    labels = spark.range(1, 24).select(ranking.rank_label(F.col("id")).alias("l")).collect()
    assert [r.l for r in labels][:4] == ["1st", "2nd", "3rd", "4th"]
    assert [r.l for r in labels][10:13] == ["11th", "12th", "13th"] and labels[20].l == "21st"


def test_leaders_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0, 5.0), ("a", 1.0, 3.0)], "t string, x double, y double")
    leaders = ranking.leader_per_stat(df, "t", ["x", "y"])
    assert rows_of(leaders, "stat") == [("x", "a", 1.0), ("y", "b", 5.0)]
    assert tuple(ranking.best_group(ranking.leader_wins(leaders)).first()) == ("a", 1, 2)
    assert tuple(ranking.best_group(ranking.leader_wins(leaders, ["x"])).first()) == ("b", 1, 1)


# --- histograms ----------------------------------------------------------------------------------


@pytest.mark.parametrize("bins", [10, 20])
def test_histogram_equals_numpy(spark, bins):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), round(rng.gauss(3, 2), 2), 5.0) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, flat double")
    whole = defaultdict(dict)
    for r in histogram.histogram(df, ["v", "flat"], bins).collect():
        whole[r.stat][r.bin] = r["rows"]
    assert [whole["v"][i] for i in range(bins)] == np.histogram([r[1] for r in rows], bins)[0].tolist()
    assert [whole["flat"][i] for i in range(bins)] == np.histogram([5.0] * 500, bins)[0].tolist()
    parts = defaultdict(dict)
    for r in histogram.histogram(df, ["v"], bins, "g").collect():
        parts[r.g][r.bin] = r["rows"]
    for g in "ab":
        expected = np.histogram([r[1] for r in rows if r[0] == g], bins)[0].tolist()
        assert [parts[g][i] for i in range(bins)] == expected


# --- features ------------------------------------------------------------------------------------


def test_impute_median(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", None, None), ("a", 4.0, None), ("b", None, 2.0)], "g string, x double, y double"
    )
    assert Counter(r.x for r in features.impute_median(df, ["x"]).collect()) == Counter([1.0, 2.5, 4.0, 2.5])
    for limits in ({}, {"in_memory": 0}):
        got = features.impute_median(df, ["x", "y"], "g", **limits).collect()
        assert sorted((r.g, r.x, r.y) for r in got) == [
            ("a", 1.0, 0.0), ("a", 2.5, 0.0), ("a", 4.0, 0.0), ("b", 0.0, 2.0),
        ]


def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "x double, flat double")
    got = sorted(tuple(r) for r in features.standardize(df, ["x", "flat"]).collect())
    assert np.allclose([r[0] for r in got], [-(1.5**0.5), 0, 1.5**0.5])
    assert [r[1] for r in got] == [0.0, 0.0, 0.0]


def test_split_is_stable_and_near_four_fifths(spark):
    df = spark.range(5000)
    train, test = features.split_train_test(df, "id")
    assert train.count() + test.count() == 5000 and abs(train.count() - 4000) < 150
    again, _ = features.split_train_test(df.repartition(13), "id")
    assert {r.id for r in train.collect()} == {r.id for r in again.collect()}
    small = spark.range(5)
    assert [d.count() for d in features.split_train_test(small, "id")] == [5, 5]


def test_one_hot_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = [tuple(r)[1:] for r in features.one_hot(df, "c", ["a", "b"]).collect()]
    assert got == [(1, 0), (0, 0), (0, 0)]


def test_key_weights_multiply():
    weights = features.key_weights(["Gls", "Minutes"])
    assert weights == {"Gls": 2.0, "Minutes": 3.0, "Age": 0.5}


def shuffled_rows(df):
    """Collects the rows and tells how many each exchange of the plan wrote."""
    rows = df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows, found


@pytest.mark.parametrize("group", [None, "g"])
def test_histogram_shuffles_bins_only(spark, group):
    """A task sends a row per group, statistic and bin at most, however many values are distinct."""
    df = spark.range(20_000, numPartitions=4).selectExpr("id % 3 AS g", "id * 0.37 AS a", "sqrt(id) AS b")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows, sent = shuffled_rows(histogram.histogram(df, ["a", "b"], 10, group))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    groups = 3 if group else 1
    assert len(rows) == groups * 20 and sum(r["rows"] for r in rows) == 40_000
    assert sent and all(n <= 4 * groups * 2 * 10 for n in sent)


def test_profile_computes_its_input_once(spark):
    """The input is written, its size read from the files, and the profile from what was written."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(500).selectExpr("string(id % 3) AS g", "id * 1.0D AS a").mapInArrow(count, "g string, a double")
    assert profile.group_profile(df, "g", ["a"]).count() == 3 and seen.value == 500
    assert len(profile.rollup_profile(df, "g", ["a"]).collect()) == 4 and seen.value == 1_000


def test_merge_conditions_go_to_their_tables(spark):
    """Conditions on single tables give the rows of a filter on the merged table."""
    import random

    rng = random.Random(4)
    pick = lambda n, *kinds: [(k, *(f() for f in kinds)) for k in rng.sample([*range(12), None], n)]
    number = lambda: rng.choice([None, 1, 2, 3])
    for _ in range(4):
        tables = {
            "a": spark.createDataFrame(pick(8, lambda: rng.choice("xy")), "k int, s string"),
            "b": spark.createDataFrame(pick(9, number, number), "k int, v int, z int"),
            "c": spark.createDataFrame(pick(7, number), "k int, z int"),
        }
        every = merge.merge_wide(tables, "k")
        assert every.columns == ["k", "s", "v", "z_x", "z_y"]
        for where, plain in [({"b": "v > 1"}, "v > 1"), ({"c": "z = 2", "b": "v >= 1"}, "v >= 1 AND z_y = 2"), ({0: "s = 'x'"}, "s = 'x'")]:
            found = merge.merge_wide(tables, "k", where=where)
            assert found.columns == every.columns
            assert sorted(map(str, found.collect())) == sorted(map(str, every.filter(plain).collect()))
            some = merge.merge_wide(tables, "k", where=where, columns=["z_y", "v"])
            assert sorted(map(str, some.collect())) == sorted(map(str, every.filter(plain).select("k", "v", "z_y").collect()))
    with pytest.raises(ValueError):
        merge.merge_wide(tables, "k", columns=["none"])


def test_filter_threshold_reads_what_it_needs(spark):
    """The condition stands below the joins, tables without a wanted column are not read, columns are pruned."""
    from statloom import catalogue

    plan = catalogue.filter_threshold(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "c_acctbal" not in plan and "l_extendedprice" not in plan
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join" in line]
    conditions = [i for i, line in enumerate(plan.splitlines()) if "Filter" in line and "> 900.0" in line]
    assert conditions and min(conditions) > min(joins)


def test_bucketed_tables_merge_without_exchange(spark):
    from statloom.storage import _written, clear_scratch, materialize_by

    app = spark.sparkContext.applicationId
    kept, _written[app] = _written.get(app, []), []  # what other tests have written stays
    try:
        frames = [spark.range(50).selectExpr(f"id * {i + 2} % 53 AS k", f"id AS v{i}") for i in range(3)]
        held = [materialize_by(f, "merged", "k", 4) for f in frames]
        merged = merge.merge_wide(held, "k", lead=0).groupBy("k").agg({"v0": "sum", "v1": "sum", "v2": "sum"})
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
        plain = merge.merge_wide(frames, "k", lead=0).groupBy("k").agg({"v0": "sum", "v1": "sum", "v2": "sum"})
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, plain.collect()))
        assert clear_scratch(spark) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        _written[app] = kept


# --- orders --------------------------------------------------------------------------------------


def test_places_are_those_of_a_plain_sort(spark):
    """Half of the rows share the ordering value; nulls come first, others descend."""
    drawn = random.Random(3)
    rows = [(None if i % 11 == 0 else "h" if i % 2 else drawn.choice("abxyz"), i, {"a": i}) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k string, place int, m map<string,int>").withColumn("id", F.col("place")).repartition(7)
    got = ordering.with_places(df, [F.col("k").desc_nulls_first()])
    assert got.columns == ["k", "m", "id", "place"]
    made = [(r.place, r.k, r.id) for r in got.orderBy("place").collect()]
    want = sorted(((k, i) for k, i, _ in rows), key=lambda r: (r[0] is not None, -ord(r[0] or "a"), r[1]))
    assert made == [(n, *row) for n, row in enumerate(want, 1)]
    assert ordering.with_places(df.limit(0), [F.col("k")]).count() == 0


def test_hot_value_spreads_over_tasks(spark):
    df = spark.range(8_000).selectExpr("'same' AS k", "id")
    got = ordering.with_places(df, [F.col("k")])
    assert got.where("place <> id + 1").isEmpty()
    ranges = ordering._sorted_ranges(df, [F.col("k")]).groupBy(F.shiftright("__at", ordering.ROW_BITS)).count().collect()
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < 5_000
