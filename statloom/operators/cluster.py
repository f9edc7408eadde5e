"""K-means, its elbow curve, a two-component projection and cluster summaries."""

from __future__ import annotations

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.numeric import mean_of, round2
from statloom.operators.features import standardize
from statloom.operators.kmeans import fit_kmeans, nearest_centre
from statloom.operators.schema import quoted
from statloom.storage import materialize

VECTOR = "features"


def feature_table(df: DataFrame, keep: list[str], columns: list[str]) -> DataFrame:
    """Rows with all features present, standardised, as one vector column, written once."""
    names = [f"f{i}" for i in range(len(columns))]
    complete = df.dropna(how="any", subset=[f"`{c}`" for c in columns])
    plain = materialize(
        complete.select(
            *[quoted(c) for c in keep],
            *[quoted(c).cast("double").alias(n) for c, n in zip(columns, names)],
        ),
        "complete",
    )
    scaled = standardize(plain, names)
    return VectorAssembler(inputCols=names, outputCol=VECTOR).transform(scaled).drop(*names)


def spread_of_one(vectors: DataFrame) -> float:
    """Within-cluster sum of squares of a single cluster, per dimension and added up."""
    cells = vectors.select(F.posexplode(vector_to_array(VECTOR)).alias("dim", "x"))
    per_dim = cells.groupBy("dim").agg((F.var_pop("x") * F.count("x")).alias("ss"))
    return per_dim.agg(F.sum("ss")).first()[0] or 0.0


def elbow_curve(
    vectors: DataFrame, max_k: int = 10, starts: int = 10, seed: int = 42, **options
) -> DataFrame:
    """Within-cluster sum of squares for every number of clusters: ``k, wcss``.

    ``options`` go to :func:`fit_kmeans`, as they do below.
    """
    models = fit_kmeans(vectors, list(range(1, max_k + 1)), starts, seed, **options)
    curve = [(k, model.cost) for k, model in sorted(models.items())]
    return vectors.sparkSession.createDataFrame(curve, "k int, wcss double")


def kmeans_assign(
    vectors: DataFrame, k: int = 4, starts: int = 10, seed: int = 42, **options
) -> DataFrame:
    """Rows with their cluster. Ids go by size (largest 0), then by the first centre coordinate."""
    model = fit_kmeans(vectors, [k], starts, seed, **options)[k]
    order = sorted(range(len(model.centres)), key=lambda c: (-model.sizes[c], tuple(model.centres[c])))
    return vectors.withColumn("cluster", nearest_centre(F.col(VECTOR), model.centres[order]))


def pca_2d(vectors: DataFrame) -> tuple[DataFrame, list[float]]:
    """Rows with ``pc1, pc2`` and the variance shares of both components.

    The sign of a component is free; its largest loading is made positive.
    """
    model = PCA(k=2, inputCol=VECTOR, outputCol="pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    parts = vector_to_array("pc")
    projected = model.transform(vectors).withColumns(
        {f"pc{i + 1}": parts[i] * F.lit(signs[i]) for i in range(2)}
    )
    return projected.drop("pc"), [float(v) for v in model.explainedVariance.toArray()]


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"))
    return sizes.orderBy(F.desc("rows"), "cluster")


def cluster_profile(clustered: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of each feature per cluster, two decimals."""
    return clustered.groupBy("cluster").agg(
        *[round2(mean_of(quoted(c))).alias(c) for c in columns]
    )
