"""The value model against least squares on the whole matrix of features."""

import math
import random
import statistics

import numpy as np
import pytest

from statloom.operators import value_model as vm
from statloom.operators.features import in_training

ROWS = "id int, role string, team string, nation string, x double, y double, worth double"


def people(n=160, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        role = rng.choice(["fw", "FW", "df", "gk", None, "zz"])
        x, y = rng.choice([None, rng.uniform(0, 50)]), rng.choice([None, -1.0, rng.uniform(1, 9)])
        worth = None if rng.random() < 0.2 else 1e6 * (3 + (x or 0) + rng.random())
        rows.append((i, role, rng.choice(["a", "b", "c", None]), rng.choice(["n", "m", "o"]), x, y, worth))
    rows += [(1000 + i, "md", "a", "n", float(i), 2.0, 5e6 + i) for i in range(4)]  # too few to split
    return rows + [(2000, "am", "a", "n", 1.0, 1.0, None)]  # no known value


CONFIGS = [
    vm.RoleModel("Forward", "FW", ["x", "y"], ["team", "nation"], {"x": 2.0}),
    vm.RoleModel("Defender", "DF", ["y"], ["team"], {"y": 0.5}),
    vm.RoleModel("Midfielder", "MD", ["x"]),
    vm.RoleModel("Attacker", "AM", ["x"]),
    vm.RoleModel("Keeper", "GK", ["x", "y"], ["nation", "team"]),
]


def expected(rows, train):
    """Predictions by a pseudo-inverse over scaled numbers and one-hot categories."""
    out = {}
    for config in CONFIGS:
        own = [dict(zip(("id", "role", "team", "nation", "x", "y", "worth"), r)) for r in rows if (r[1] or "").upper() == config.code]
        known = [r["id"] for r in own if r["worth"] is not None]
        if not known:
            continue
        fit_on = [i for i in known if i in train] if len(known) >= 6 else known
        for c in config.numeric:
            held = [r[c] for r in own if r[c] is not None]
            middle = statistics.median(held) if held else 0.0
            for r in own:
                r[f"f_{c}"] = math.log1p(max(middle if r[c] is None else r[c], 0)) * config.weights.get(c, 1.0)
        rows_of = {r["id"]: r for r in own}
        features = {i: [r[f"f_{c}"] for c in config.numeric] for i, r in rows_of.items()}
        numbers = np.array([features[i] for i in fit_on])
        mean, spread = numbers.mean(axis=0), numbers.std(axis=0, ddof=1)
        scale = np.array([1 / s if s > 1e-9 else 0 for s in spread])
        values = [(c, v) for c in config.categorical for v in sorted({rows_of[i][c] or "Unknown" for i in fit_on})]
        whole = {i: np.concatenate([(np.array(features[i]) - mean) * scale, [float((r[c] or "Unknown") == v) for c, v in values]]) for i, r in rows_of.items()}
        x = np.array([whole[i] for i in fit_on])
        y = np.array([rows_of[i]["worth"] for i in fit_on])
        weights = np.linalg.pinv(x - x.mean(axis=0)) @ (y - y.mean())
        for i in rows_of:
            value = y.mean() + (whole[i] - x.mean(axis=0)) @ weights
            out[i] = (config.role, round(min(max(value, 1e5), 2e8) / 1e6, 2))
    return out


def test_all_roles_against_the_whole_matrix(spark):
    rows = people()
    frame = spark.createDataFrame(rows, ROWS).repartition(5)
    train = {r.id for r in frame.filter(in_training(frame["id"], 42)).collect()}
    valued = vm.value_all_roles(frame, CONFIGS, "role", "worth", "id", ["id", "team"]).collect()
    wanted = expected(rows, train)
    assert {r.id for r in valued} == set(wanted)
    for r in valued:
        role, value = wanted[r.id]
        assert r.position == role and r.predicted_m == pytest.approx(value, abs=0.011)
    assert [r.predicted_m for r in valued] == sorted((r.predicted_m for r in valued), reverse=True)
    assert {r.team for r in valued} <= {"a", "b", "c", "Unknown"}


def test_input_is_computed_once_for_all_roles(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = people()
    frame = spark.createDataFrame(rows, ROWS).mapInArrow(count, ROWS)
    assert vm.value_all_roles(frame, CONFIGS, "role", "worth", "id", ["id"]).count() and seen.value == len(rows)


def test_no_known_value_at_all(spark):
    frame = spark.createDataFrame([(1, "fw", "a", "n", 1.0, 1.0, None)], ROWS)
    assert vm.value_all_roles(frame, CONFIGS, "role", "worth", "id", ["id"]) is None
    assert vm.value_all_roles(frame.limit(0), CONFIGS, "role", "worth", "id", ["id"]) is None


def test_steps_find_the_same_line_as_the_matrix(spark):
    """The iterative solution is the shortest one too."""
    rows = people(seed=5)
    frame = spark.createDataFrame(rows, ROWS).fillna({"x": 1.0, "y": 2.0, "team": "?", "role": "?"})
    config = vm.RoleModel("All", "", ["x", "y"], ["team", "nation", "role"])
    sums = vm.role_sums(frame.selectExpr("*", "0 AS __role"), [config], "worth", None)[0]
    dense, steps = vm.solve(sums, config), vm.solve(sums, config, dense_width=0)
    assert steps.intercept == pytest.approx(dense.intercept, rel=1e-6) and steps.slopes == pytest.approx(dense.slopes, rel=1e-6)
    for a, b in zip(dense.categories, steps.categories, strict=True):
        assert a.keys() == b.keys() and all(b[v] == pytest.approx(a[v], rel=1e-5, abs=1.0) for v in a)


def test_hundred_thousand_categories(spark):
    """A category of its own for each two rows: the line passes through their means."""
    frame = spark.range(200_000, numPartitions=4).selectExpr("0 AS __role", "string(id div 2) AS c", "double(id % 2) AS x", "double(id % 2) * 3 + (id div 2) % 7 AS t")
    config = vm.RoleModel("All", "", ["x"], ["c"])
    fit = vm.fit_values(frame.drop("__role"), config, "t")
    assert len(fit.categories[0]) == 100_000
    off = fit.estimate(frame.drop("__role")).selectExpr("max(abs(estimate - t)) AS off").first().off
    assert off < 1e-5 and fit.slopes[0] == pytest.approx(3.0, abs=1e-6)
