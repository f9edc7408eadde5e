"""Linear value model per role, all roles from the same passes.

Rows are prepared once for all roles. What a least-squares fit needs of them are sums: products of the
numbers, per category the count and the sums of the numbers, and counts of pairs of categories. Spark
adds them up per role; the lines are solved from them, and the rows are valued by expressions and by
joins with the categories' weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.numeric import clip, in_millions, log_positive
from statloom.operators.features import impute_median, in_training
from statloom.operators.schema import fill_text, quoted
from statloom.storage import join_bounded

#: Fixed value: predictions are limited to this range before they are scaled to millions.
VALUE_RANGE = (100_000.0, 200_000_000.0)
#: Columns up to which a line is solved from the whole matrix; wider ones step by step. Categories of
#: all roles whose sums may come to the driver.
DENSE_WIDTH, MOST_CATEGORIES = 1_000, 2_000_000
#: Rows with a known value below which a role trains on all of them.
LEAST_SPLIT = 6


@dataclass(frozen=True)
class RoleModel:
    """What one role is valued on."""

    role: str
    code: str
    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    weights: Mapping[str, float] = field(default_factory=dict)


def of_role(df: DataFrame, role_column: str, code: str) -> DataFrame:
    return df.filter(F.upper(quoted(role_column)) == F.lit(code.upper()))


@dataclass
class RoleSums:
    """Sums over training rows: of ``z z'`` for z = (1, numbers, target), per category, per pair of categories."""

    products: np.ndarray
    #: per categorical column: values, and per value the sums of z
    categories: list[tuple[list[str], np.ndarray]]
    #: per pair of categorical columns: positions of the two values, and rows
    pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class LinearFit:
    """A line on scaled numbers and on categories; a category that was not trained on weighs nothing."""

    config: RoleModel
    intercept: float
    #: per number: weight of one unit as it stands
    slopes: np.ndarray
    #: per categorical column: weight of each value
    categories: list[dict[str, float]]

    def estimate(self, df: DataFrame) -> DataFrame:
        """The rows with ``estimate``."""
        return estimate_roles(df.withColumn("__role", F.lit(0)), [self]).drop("__role")


def _least_norm(multiply, wanted: np.ndarray, most: int) -> np.ndarray:
    """The shortest solution of a consistent system with a positive semidefinite matrix: conjugate
    gradients from zero never leave its range."""
    out, rest = np.zeros(len(wanted)), wanted.copy()
    step, size = rest.copy(), rest @ rest
    enough = 1e-24 * size
    for _ in range(most):
        if size <= enough:
            break
        image = multiply(step)
        length = step @ image
        if length <= 0:
            break
        out += size / length * step
        rest -= size / length * image
        size, before = rest @ rest, size
        step = rest + size / before * step
    return out


def solve(sums: RoleSums, config: RoleModel, dense_width: int | None = None) -> LinearFit:
    """Ordinary least squares on scaled numbers and one-hot categories.

    Of all best lines, as one-hot columns depend on each other, the one with the least weights.
    """
    z = sums.products
    n, k = z[0, 0], len(z) - 2
    mean = z[0, 1:-1] / n
    spread = np.sqrt(np.maximum(np.diag(z)[1:-1] - n * mean**2, 0) / max(n - 1, 1))
    spread[spread <= 1e-9 * np.abs(mean)] = 0.0
    scale = np.divide(1.0, spread, out=np.zeros(k), where=spread > 0)
    target = z[0, -1] / n
    # of the centred and scaled columns: numbers with numbers and target, categories with them
    numbers = (z[1:-1, 1:-1] - n * np.outer(mean, mean)) * np.outer(scale, scale)
    wanted = [(z[1:-1, -1] - n * mean * target) * scale]
    counts, crossed = [], []
    for _, held in sums.categories:
        counts.append(held[:, 0])
        crossed.append((held[:, 1:-1] - np.outer(held[:, 0], mean)) * scale)
        wanted.append(held[:, -1] - held[:, 0] * target)
    starts = np.cumsum([k, *map(len, counts)])
    count, cross, right = np.concatenate([np.zeros(0), *counts]), np.concatenate([np.zeros((0, k)), *crossed]), np.concatenate(wanted)

    def multiply(w: np.ndarray) -> np.ndarray:
        hot = w[k:]
        below = cross @ w[:k] + count * hot - count * (count @ hot) / n
        for (a, b), (i, j, rows) in sums.pairs.items():
            i, j = i + starts[a] - k, j + starts[b] - k
            np.add.at(below, i, rows * hot[j])
            np.add.at(below, j, rows * hot[i])
        return np.concatenate([numbers @ w[:k] + cross.T @ hot, below])

    width = len(right)
    if width <= (DENSE_WIDTH if dense_width is None else dense_width):
        matrix = np.column_stack([multiply(e) for e in np.eye(width)]) if width else np.zeros((0, 0))
        weights = np.linalg.pinv(matrix, rcond=1e-10, hermitian=True) @ right
    else:
        weights = _least_norm(multiply, right, 10 * width)
    slopes = weights[:k] * scale
    intercept = target - mean @ slopes - count @ weights[k:] / n
    hot = [dict(zip(values, weights[a:b].tolist(), strict=True)) for (values, _), a, b in zip(sums.categories, starts, starts[1:], strict=False)]
    return LinearFit(config, float(intercept), slopes, hot)


def _products(numeric: list[str]):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, bool], np.ndarray] = {}
        for batch in batches:
            role, train = batch.column("__role").to_numpy(), batch.column("__train").to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(batch.num_rows), *(batch.column(c).to_numpy(zero_copy_only=False) for c in (*numeric, "__target"))])
            for r in np.unique(role).tolist():
                for t in (True, False):
                    own = z[(role == r) & (train == t)]
                    if len(own):
                        total[r, t] = total.get((r, t), 0) + own.T @ own
        for (r, t), cells in total.items():
            flat = cells.ravel()
            columns = [pa.array([r] * len(flat), pa.int32()), pa.array([t] * len(flat)), pa.array(np.arange(len(flat))), pa.array(flat)]
            yield pa.RecordBatch.from_arrays(columns, ["__role", "__train", "cell", "value"])

    return add_up


def role_sums(rows: DataFrame, configs: list[RoleModel], target: str, key: str | None, seed: int = 42) -> list[RoleSums | None]:
    """The sums of each role's training rows, None where no row has a known value.

    ``rows`` has ``__role`` (the position in ``configs``) and the prepared columns. Without ``key`` all
    rows with a known value train, otherwise its split; a role with few of them trains on all.
    """
    numeric = list(dict.fromkeys(c for config in configs for c in config.numeric))
    categorical = list(dict.fromkeys(c for config in configs for c in config.categorical))
    train = F.lit(True) if key is None else in_training(quoted(key), seed)
    known = rows.filter(quoted(target).isNotNull()).select(
        F.col("__role").cast("int").alias("__role"), F.coalesce(train, F.lit(False)).alias("__train"),
        *[quoted(c).cast("double").alias(c) for c in numeric], quoted(target).cast("double").alias("__target"),
        *[quoted(c).cast("string").alias(f"__c{i}") for i, c in enumerate(categorical)],
    )
    by, size = ["__role", "__train"], len(numeric) + 2
    cells = known.select(*by, *[quoted(c) for c in numeric], "__target").mapInArrow(_products(numeric), "__role int, __train boolean, cell long, value double")
    cells = cells.groupBy(*by, "cell").agg(F.sum("value").alias("value")).toPandas()
    held = pd.DataFrame(columns=[*by, "c", "v", "n"])
    together: dict[tuple[int, int], pd.DataFrame] = {}
    if categorical:
        own = [F.struct(F.lit(i).alias("c"), F.col(f"__c{i}").alias("v")) for i in range(len(categorical))]
        spread = known.select(*by, *[quoted(c) for c in numeric], "__target", F.inline(F.array(*own)))
        sums = [F.sum(quoted(c)).alias(f"s{j}") for j, c in enumerate([*numeric, "__target"])]
        held = spread.groupBy(*by, "c", "v").agg(F.count(F.lit(1)).alias("n"), *sums).limit(MOST_CATEGORIES + 1).toPandas()
        if len(held) > MOST_CATEGORIES:
            raise ValueError(f"more than {MOST_CATEGORIES} categories")
        for a, b in combinations(range(len(categorical)), 2):
            both = known.groupBy(*by, f"__c{a}", f"__c{b}").agg(F.count(F.lit(1)).alias("n")).limit(MOST_CATEGORIES + 1).toPandas()
            if len(both) > MOST_CATEGORIES:
                raise ValueError(f"more than {MOST_CATEGORIES} pairs of categories")
            together[a, b] = both
    out: list[RoleSums | None] = []
    for r, config in enumerate(configs):
        mine = {t: np.zeros((size, size)) for t in (True, False)}
        for t in mine:
            part = cells[(cells["__role"] == r) & (cells["__train"] == t)]
            mine[t].ravel()[part["cell"].to_numpy()] = part["value"].to_numpy()
        rows_known = mine[True][0, 0] + mine[False][0, 0]
        if not rows_known:
            out.append(None)
            continue
        whole = rows_known < LEAST_SPLIT
        if not whole and not mine[True][0, 0]:
            raise ValueError(f"{config.role}: no row with a known value to train on")
        taken = [0, *(1 + numeric.index(c) for c in config.numeric), size - 1]
        products = (mine[True] + mine[False] if whole else mine[True])[np.ix_(taken, taken)]
        chosen = (held["__role"] == r) & (held["__train"].astype(bool) | whole)
        categories, place, pairs = [], [], {}
        for c in config.categorical:
            i = categorical.index(c)
            part = held[chosen & (held["c"] == i)].drop(columns=["__role", "__train", "c"]).groupby("v").sum().sort_index()
            categories.append((part.index.tolist(), part.to_numpy(float)[:, taken]))
            place.append(dict(zip(part.index, range(len(part)), strict=True)))
        for x, y in combinations(range(len(config.categorical)), 2):
            a, b = (categorical.index(config.categorical[k]) for k in (x, y))
            both = together[min(a, b), max(a, b)]
            both = both[(both["__role"] == r) & (both["__train"].astype(bool) | whole)]
            i, j = both[f"__c{a}"].map(place[x]).to_numpy(np.int64), both[f"__c{b}"].map(place[y]).to_numpy(np.int64)
            pairs[x, y] = (i, j, both["n"].to_numpy(float))
        out.append(RoleSums(products, categories, pairs))
    return out


def fit_values(train: DataFrame, config: RoleModel, target: str) -> LinearFit:
    """The line of one role on all rows with a known value."""
    sums = role_sums(train.withColumn("__role", F.lit(0)), [config], target, None)[0]
    if sums is None:
        raise ValueError(f"{config.role}: no row with a known value")
    return solve(sums, config)


def estimate_roles(rows: DataFrame, fits: list[LinearFit | None]) -> DataFrame:
    """The rows with ``estimate`` by the line of their ``__role``."""
    spark = rows.sparkSession
    categorical = list(dict.fromkeys(c for fit in fits if fit for c in fit.config.categorical))
    out = rows
    for i, c in enumerate(categorical):
        weights = [
            (r, v, w)
            for r, fit in enumerate(fits) if fit and c in fit.config.categorical
            for v, w in fit.categories[fit.config.categorical.index(c)].items()
        ]
        known = spark.createDataFrame(weights, f"__role int, __v string, __w{i} double")
        out = join_bounded(out.withColumn("__v", quoted(c).cast("string")), known, ["__role", "__v"], "left").drop("__v")
    estimate: Column = F.lit(None).cast("double")
    for r, fit in enumerate(fits):
        if fit:
            line = F.lit(fit.intercept)
            for c, slope in zip(fit.config.numeric, fit.slopes.tolist(), strict=True):
                line = line + quoted(c) * F.lit(slope)
            for c in fit.config.categorical:
                line = line + F.coalesce(F.col(f"__w{categorical.index(c)}"), F.lit(0.0))
            estimate = F.when(F.col("__role") == r, line).otherwise(estimate)
    return out.withColumn("estimate", estimate).drop(*[f"__w{i}" for i in range(len(categorical))])


def value_all_roles(
    matched: DataFrame,
    configs: list[RoleModel],
    role_column: str,
    target: str,
    key: str,
    output: list[str],
    seed: int = 42,
) -> DataFrame | None:
    """One model per role, results together and sorted by predicted value, highest first.

    Trains on the split of a role's rows with a known value and predicts all its rows; a role without
    known values is left out, and without any such role there is no result. Returns ``output``,
    ``position`` (the role), ``actual_m`` and ``predicted_m``. The input is computed once.
    """
    numeric = list(dict.fromkeys(c for config in configs for c in config.numeric))
    categorical = list(dict.fromkeys(c for config in configs for c in config.categorical))
    code = F.upper(quoted(role_column))
    roles = F.array_compact(F.array(*[F.when(code == F.lit(c.code.upper()), F.lit(i)) for i, c in enumerate(configs)]))
    wanted = dict.fromkeys([*numeric, *categorical, target, key, *output])
    rows = matched.withColumn("__role", F.explode(roles)).select("__role", *[quoted(c) for c in wanted])
    prepared = impute_median(fill_text(rows, categorical, "Unknown"), numeric, group="__role")
    weighed = {}
    for c in numeric:
        weight = F.lit(1.0)
        for i, config in enumerate(configs):
            if config.weights.get(c, 1.0) != 1.0:
                weight = F.when(F.col("__role") == i, F.lit(float(config.weights[c]))).otherwise(weight)
        weighed[c] = log_positive(quoted(c)) * weight
    # what a result row shows is taken as it came
    shown = [c for c in output if c in weighed]
    prepared = prepared.withColumns({f"__shown{i}": quoted(c) for i, c in enumerate(shown)}).withColumns(weighed)
    sums = role_sums(prepared, configs, target, key, seed)
    fits = [solve(own, config) if own else None for own, config in zip(sums, configs, strict=True)]
    if not any(fits):
        return None
    low, high = VALUE_RANGE
    names = F.array(*[F.lit(c.role) for c in configs])
    valued = estimate_roles(prepared.filter(F.col("__role").isin([i for i, f in enumerate(fits) if f])), fits)
    valued = valued.select(
        *[F.col(f"__shown{shown.index(c)}").alias(c) if c in shown else quoted(c) for c in output],
        F.element_at(names, F.col("__role") + 1).alias("position"),
        in_millions(quoted(target)).alias("actual_m"),
        in_millions(clip(F.col("estimate"), low, high)).alias("predicted_m"),
    )
    return valued.orderBy(F.desc("predicted_m"), *[quoted(c) for c in output])
