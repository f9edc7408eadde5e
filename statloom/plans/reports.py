"""Rankings, profiles, histograms, leaders and clusters of the wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from statloom.operators.cluster import (
    cluster_profile,
    cluster_sizes,
    elbow_curve,
    feature_table,
    kmeans_assign,
    pca_2d,
)
from statloom.operators.histogram import histogram
from statloom.operators.profile import rollup_profile
from statloom.operators.ranking import best_group, leader_per_stat, leader_wins, top_bottom_n
from statloom.operators.schema import numeric_names, zero_fill
from statloom.plans import season
from statloom.storage import materialize


def statistics_report(wide: DataFrame) -> dict[str, DataFrame]:
    """Every table of the statistics stage; missing numbers count as 0 throughout."""
    stats = numeric_names(wide, season.TEXT)
    filled = materialize(zero_fill(wide, stats), "filled")
    plotted = [s for s in season.PLOTTED if s in stats]
    leaders = leader_per_stat(filled, "Team", stats)
    wins = leader_wins(leaders, season.NEGATIVE)
    return {
        "ranking": top_bottom_n(filled, "Player", "Team", stats),
        "profile": rollup_profile(filled, "Team", stats),
        "league_histogram": histogram(filled, plotted, 20),
        "team_histogram": histogram(filled, plotted, 10, "Team"),
        "leaders": leaders,
        "wins": wins,
        "best": best_group(wins),
    }


def cluster_report(
    wide: DataFrame, clusters: int = 4, max_k: int = 10, starts: int = 10
) -> dict[str, DataFrame]:
    """Elbow curve, clustered players with their projection, sizes and means per cluster.

    Players with a missing feature are left out.
    """
    features = [c for c in season.CLUSTERED if c in wide.columns]
    vectors = materialize(feature_table(wide, wide.columns, features), "vectors")
    curve = elbow_curve(vectors, max_k, starts)
    projected, shares = pca_2d(kmeans_assign(vectors, clusters, starts))
    clustered = materialize(projected.drop("features"), "clustered")
    variance = wide.sparkSession.createDataFrame(
        [(i + 1, share) for i, share in enumerate(shares)], "component int, share double"
    )
    return {
        "elbow": curve,
        "clustered": clustered,
        "variance": variance,
        "sizes": cluster_sizes(clustered),
        "means": cluster_profile(clustered, features),
    }
