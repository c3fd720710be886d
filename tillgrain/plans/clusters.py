"""Customer clusters on recency, frequency and monetary value.

All restarts of all cluster counts settle together, see ``operators.lloyd``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.operators import lloyd
from tillgrain.operators.materialize import materialize

MEASURES = ("recency_days", "frequency", "monetary")
SCALED = tuple(f"scaled_{m}" for m in MEASURES)
SEED = 42
# An upper bound only: starts stop once their centres move less than the tolerance.
MAX_PASSES = 300


@dataclass(frozen=True)
class ClusterModel:
    """Means and deviations of the log measures, and one centre per cluster in the order of numbers."""

    means: tuple[float, ...]
    deviations: tuple[float, ...]
    centres: tuple[tuple[float, ...], ...] = ()

    def scaled(self, measure: str) -> Column:
        i = MEASURES.index(measure)
        return (_logged(measure) - self.means[i]) / (self.deviations[i] or 1.0)

    def with_scaled(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"scaled_{m}": self.scaled(m) for m in MEASURES})

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with ``rfm_cluster``; measures scaled on the way do not stay."""
        number = lloyd.nearest_centre(SCALED, np.array(self.centres))
        return self.with_scaled(df).withColumn("rfm_cluster", number).drop(*SCALED)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per cluster: number, and the centre, means and deviations per measure."""
        rows = [(i, list(c), list(self.means), list(self.deviations)) for i, c in enumerate(self.centres)]
        columns = "centre array<double>, means array<double>, deviations array<double>"
        return spark.createDataFrame(rows, f"rfm_cluster int, {columns}")

    @classmethod
    def read(cls, table: DataFrame) -> ClusterModel:
        rows = table.orderBy("rfm_cluster").collect()
        centres = tuple(tuple(r["centre"]) for r in rows)
        return cls(tuple(rows[0]["means"]), tuple(rows[0]["deviations"]), centres)


@dataclass(frozen=True)
class Clustering:
    assigned: DataFrame
    profiles: DataFrame
    model: ClusterModel
    selected_k: int
    silhouettes: dict[int, float]


def _logged(measure: str) -> Column:
    return F.log1p(F.greatest(F.col(measure).cast("double"), F.lit(0.0)))


def fit_scaling(customer_features: DataFrame) -> ClusterModel:
    """Mean and deviation of the log measures, without centres yet."""
    found = customer_features.agg(
        *[F.avg(_logged(m)).alias(f"mean_{m}") for m in MEASURES],
        *[F.stddev_samp(_logged(m)).alias(f"deviation_{m}") for m in MEASURES],
    ).first()
    return ClusterModel(
        tuple(found[f"mean_{m}"] or 0.0 for m in MEASURES), tuple(found[f"deviation_{m}"] or 0.0 for m in MEASURES)
    )


def scaled_measures(customer_features: DataFrame) -> DataFrame:
    """What the clustering sees of each customer: log measures scaled to mean 0 and deviation 1."""
    scaled = fit_scaling(customer_features).with_scaled(customer_features)
    return scaled.select("customer_id", *[F.round(c, 6).alias(c) for c in SCALED])


def _sample_order() -> Column:
    """Order of the bounded sample: a hash of the customer."""
    return F.md5(F.col("customer_id").cast("string").cast("binary"))


def silhouette_sample(scaled: DataFrame, labellings: Sequence[str] = (), limit: int = lloyd.SAMPLE_ROWS) -> DataFrame:
    """The sample that silhouettes are taken on: scaled measures and ``labellings`` of at most ``limit`` customers."""
    return lloyd.sample_rows(scaled, _sample_order(), [*SCALED, *labellings], limit)


def fit_rfm_clusters(
    customer_features: DataFrame,
    ks: Sequence[int] = range(2, 7),
    sweep_restarts: int = 20,
    final_restarts: int = 30,
) -> Clustering:
    """Pick k by the silhouette of the sample, then keep the restart of lowest cost.

    Clusters are numbered from the highest to the lowest mean revenue, so numbers do
    not depend on which restart won.
    """
    scaling = fit_scaling(customer_features)
    points = materialize(scaling.with_scaled(customer_features).select("customer_id", *SCALED), "scaled")
    sample_table = silhouette_sample(points)
    sample = lloyd.as_matrix(sample_table, SCALED)  # at most SAMPLE_ROWS rows
    tolerance = lloyd.TOLERANCE * float(sample.var(axis=0).mean())

    def settled(jobs: Sequence[tuple[int, int]]) -> tuple[list[np.ndarray], list[float]]:
        starts = [lloyd.spread_centres(sample, k, (SEED, k, restart)) for k, restart in jobs]
        found = lloyd.settled_centres(points, SCALED, starts, tolerance, MAX_PASSES)
        return found, lloyd.costs(points, SCALED, found)

    jobs = [(k, r) for k in ks for r in range(sweep_restarts)]
    centres, found = settled(jobs)
    best = {k: min((c, i) for i, (c, job) in enumerate(zip(found, jobs)) if job[0] == k) for k in ks}
    labelled = sample_table.select(
        *SCALED, *[lloyd.nearest_centre(SCALED, centres[best[k][1]]).alias(f"k_{k}") for k in ks]
    )
    scores = {
        int(r["labelling"][2:]): r["silhouette"]
        for r in lloyd.silhouettes(labelled, SCALED, [f"k_{k}" for k in ks]).collect()
    }
    silhouettes = {k: -1.0 if scores[k] is None else scores[k] for k in ks}
    selected_k = max(silhouettes, key=silhouettes.get)
    # The sweep's restarts count towards the final ones: same seeds, same centres.
    cost, chosen = best[selected_k][0], centres[best[selected_k][1]]
    more = [(selected_k, r) for r in range(sweep_restarts, final_restarts)]
    if more:
        later, later_costs = settled(more)
        least = min(range(len(more)), key=lambda i: later_costs[i])
        if later_costs[least] < cost:
            chosen = later[least]

    raw = ClusterModel(scaling.means, scaling.deviations, tuple(map(tuple, chosen.tolist())))
    means = (
        raw.assign(customer_features).groupBy("rfm_cluster").agg(F.avg("monetary").alias("mean")).collect()
    )  # one row per cluster
    ranked = [r["rfm_cluster"] for r in sorted(means, key=lambda r: (-r["mean"], r["rfm_cluster"]))]
    ranked += [i for i in range(selected_k) if i not in ranked]
    model = ClusterModel(raw.means, raw.deviations, tuple(raw.centres[i] for i in ranked))
    assigned = model.assign(customer_features)
    return Clustering(assigned, cluster_profiles(assigned), model, selected_k, silhouettes)


def cluster_profiles(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("rfm_cluster").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg(F.col("monetary").cast("double")).alias("avg_monetary"),
        F.sum("monetary").cast("double").alias("total_revenue"),
    )
