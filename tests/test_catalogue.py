"""Every catalogue query at the smallest size, against its SQL where it has one.

Set CATALOGUE_SF_DIR for another size.
"""

import os
from itertools import combinations

import pytest
from oracle import connect, differences, order_differs

from __spark_entry__ import entry, oracle_sql, queries

DIR = os.environ.get("CATALOGUE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = queries(), oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, DIR), con, ORACLE[name]) is None


# queries that promise an order, with the order of their SQL
ORDERED = {
    "sort_first_token": "",
    "distinct_groups": " ORDER BY nation NULLS FIRST",
    "rollup_profile": " ORDER BY grouping(nation) DESC, nation NULLS FIRST",
    "value_model": "",
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_order(spark, con, name):
    assert order_differs(QUERIES[name](spark, DIR), con, ORACLE[name] + ORDERED[name]) is None


def test_entry(spark):
    assert entry(spark).columns == ["stat", "group", "mean"]


def test_elbow_falls(spark):
    rows = QUERIES["elbow_curve"](spark, DIR).orderBy("k").collect()
    costs = [r.wcss for r in rows]
    assert [r.k for r in rows] == list(range(1, 11)) and costs == sorted(costs, reverse=True)


def test_clusters_cover_all_rows(spark):
    sizes = [r["rows"] for r in QUERIES["cluster_sizes"](spark, DIR).collect()]
    assert len(sizes) == 4 and sum(sizes) == spark.read.parquet(f"{DIR}/embeddings.parquet").count()


def test_values_cover_all_rows_in_range(spark):
    rows = QUERIES["value_model"](spark, DIR).collect()
    assert len(rows) == spark.read.parquet(f"{DIR}/lineitem.parquet").count()
    assert all(0.1 <= r.predicted_m <= 200 for r in rows)


def test_regression_query_runs_the_operator(spark, monkeypatch):
    from statloom import catalogue

    fitted, fit = [], catalogue.values.fit_values
    monkeypatch.setattr(catalogue.values, "fit_values", lambda *a: fitted.append(a[1].role) or fit(*a))
    lines = [(f, float(q), 3.0 * q + k) for k, f in enumerate("ANR") for q in (1, 2, 5, 9)] + [("A", None, 7.0), ("A", 4.0, None)]
    frame = spark.createDataFrame(lines, "l_returnflag string, l_quantity double, l_extendedprice double")
    monkeypatch.setattr(catalogue, "table", lambda *_: frame)
    got = {r.role: (r.slope, r.intercept) for r in catalogue.ols_one_feature(spark, "").collect()}
    assert fitted == list(got) == ["Accepted", "None", "Returned"]
    assert got == {"Accepted": (3.0, 0.0), "None": (3.0, 1.0), "Returned": (3.0, 2.0)}


def test_drawn_starts_against_brute_force(spark, monkeypatch):
    """The best division of points on a line is one of intervals; all of them are tried."""
    from statloom import catalogue

    spots = [0.0, 0.3, 0.7, 1.2, 50.0, 50.2, 50.9, 51.1, 90.0, 90.4, 90.5, 91.3]
    frame = spark.createDataFrame([(i, [x]) for i, x in enumerate(spots)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(catalogue, "table", lambda *_: frame)
    own = sorted(r[catalogue.cluster.VECTOR][0] for r in catalogue._vectors(spark, "").collect())
    spread = lambda a, b: sum((x - sum(own[a:b]) / (b - a)) ** 2 for x in own[a:b])
    best = {}
    for k in range(1, 11):
        divisions = ([0, *cuts, len(own)] for cuts in combinations(range(1, len(own)), k - 1))
        best[k] = min(sum(map(spread, cuts, cuts[1:])) for cuts in divisions)
    got = {r.k: r.wcss for r in QUERIES["elbow_drawn_curve"](spark, "").collect()}
    assert sorted(got) == list(best) and all(got[k] >= best[k] - 1e-4 for k in best)
    assert all(got[k] == pytest.approx(best[k], abs=1e-4) for k in (1, 2, 3))
