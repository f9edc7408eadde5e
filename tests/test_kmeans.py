import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from statloom.operators import kmeans


def test_tally_against_plain_loops(spark, monkeypatch):
    """Sums, rows and cost of every centre as row by row; ties go to the first centre. Rows that come
    in one part are dealt over all cores."""
    random = np.random.default_rng(3)
    x = np.concatenate([random.integers(-3, 4, (1500, 3)).astype(float), np.zeros((40, 3))])
    frame = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").coalesce(1)
    parts, kept = [], []
    write = kmeans.materialize
    monkeypatch.setattr(kmeans, "materialize", lambda df, name: parts.append(df.rdd.getNumPartitions()) or kept.append(write(df, name)) or kept[0])
    first = random.integers(-3, 4, (4, 3)).astype(float)
    kmeans.fit_kmeans(frame.select(array_to_vector(F.col("x")).alias("features")), [1, 4], max_iter=2, first=first)
    assert parts[0] >= spark.sparkContext.defaultParallelism
    models = [first[:1], first[:2], first[1:3], np.vstack([first, first[:1]]), first[:2]]
    for centres, (sums, counts, cost) in zip(models, kmeans._tally(kept[0], models), strict=True):
        distance = ((x[:, None] - centres[None]) ** 2).sum(2)
        label = distance.argmin(1)
        assert counts.tolist() == np.bincount(label, minlength=len(centres)).tolist()
        assert np.allclose(sums, [x[label == k].sum(0) for k in range(len(centres))])
        assert cost == pytest.approx(distance.min(1).sum())
