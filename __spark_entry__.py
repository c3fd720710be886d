"""Registered queries: each takes a session and a folder of tables and returns a DataFrame."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps
from pathlib import Path
from typing import Any

sys.path.insert(0, str(Path(__file__).resolve().parent))

import numpy as np  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from tillgrain.operators import lloyd, newton  # noqa: E402
from tillgrain.operators.materialize import intermediates, materialize  # noqa: E402
from tillgrain.operators.ordered import exact_medians  # noqa: E402
from tillgrain.plans import cleaning, clusters, customers, dashboard, metrics  # noqa: E402
from tillgrain.plans import orders, performance, quality, reports, scoring, snapshots  # noqa: E402
from tillgrain.plans import training  # noqa: E402
from tillgrain.sources import star_schema  # noqa: E402
from tillgrain.sources.export import export_dataset  # noqa: E402
from tillgrain.sources.tables import read_csv  # noqa: E402

try:  # the text operators may be left out of an installation
    import corpus_pipeline
    from tillgrain.llm import queries as text_queries
except ModuleNotFoundError as error:
    if error.name not in ("tillgrain.llm", "corpus_pipeline"):
        raise
    corpus_pipeline = text_queries = None

SMOKE_FOLDER = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


# --- Tables and fits that the parts of one query share -----------------------------------
# A query builds them from its inputs when it is called, and no later query sees them, so its
# time does not depend on what ran before. ``drop_intermediates`` deletes what they wrote.

_shared: ContextVar[dict[Any, Any] | None] = ContextVar("_shared", default=None)


def _kept(build: Callable[[SparkSession, str], Any]) -> Callable[[SparkSession, str], Any]:
    @wraps(build)
    def get(spark: SparkSession, folder: str) -> Any:
        kept = _shared.get()
        if kept is None:
            return build(spark, folder)
        if build not in kept:
            kept[build] = build(spark, folder)
        return kept[build]

    return get


def _alone(query: Query) -> Query:
    """The query with shared parts of its own."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        token = _shared.set({})
        try:
            return query(spark, folder)
        finally:
            _shared.reset(token)

    return run


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines for queries that read them once."""
    return star_schema.clean_lines(spark, folder)


@_kept
def _stored_lines(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(_lines(spark, folder), "lines")


@_kept
def _feature_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What customer products read of the lines; the whole lines where the query stores them anyway."""
    if _stored_lines.__wrapped__ in (_shared.get() or {}):
        return _stored_lines(spark, folder)
    needed = ["customer_id", "invoice_no", "stock_code", "invoice_date", "country", "quantity", "revenue"]
    return materialize(_lines(spark, folder).select(*needed), "feature_lines")


@_kept
def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.number_transactions(_stored_lines(spark, folder))


@_kept
def _sequence(spark: SparkSession, folder: str) -> DataFrame:
    totals = orders.invoice_totals(_feature_lines(spark, folder))
    return orders.sequenced(totals)  # stored already


@_kept
def _customer_features(spark: SparkSession, folder: str) -> DataFrame:
    return customers.customer_features(_feature_lines(spark, folder), _sequence(spark, folder))


@_kept
def _current(spark: SparkSession, folder: str) -> DataFrame:
    found = snapshots.current_features(
        _feature_lines(spark, folder), sequenced_invoices=_sequence(spark, folder)
    )
    return materialize(found, "current")


@_kept
def _training(spark: SparkSession, folder: str) -> DataFrame:
    found = snapshots.snapshot_dataset(
        _feature_lines(spark, folder),
        star_schema.SNAPSHOTS,
        sequenced_invoices=_sequence(spark, folder),
    )
    return materialize(found, "snapshots")


@_kept
def _clustering(spark: SparkSession, folder: str) -> clusters.Clustering:
    return clusters.fit_rfm_clusters(_customer_features(spark, folder))


@_kept
def _models(spark: SparkSession, folder: str) -> training.TrainedModels:
    return training.train_models(_training(spark, folder))


# --- Queries -------------------------------------------------------------------------------


def _distinct(spark: SparkSession, folder: str) -> DataFrame:
    raw = star_schema.dirty_lines(spark, folder)
    return cleaning.distinct_lines(cleaning.normalise(raw, star_schema.COUNTRY_SPELLINGS))


@_kept
def _stored_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct lines for queries that read them more than once."""
    return materialize(_distinct(spark, folder), "distinct")


def _order_history(spark: SparkSession, folder: str) -> DataFrame:
    return orders.order_history(_stored_lines(spark, folder))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return performance.product_performance(_stored_lines(spark, folder))


def _stand_in_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores that SQL can compute as well, in place of model output."""
    return scoring.customer_analytics(
        _current(spark, folder).withColumn("rfm_cluster", F.col("customer_id").cast("long") % 2),
        (F.col("recency_days") * 37 % 1000) / F.lit(1000.0),
        F.col("frequency") * F.lit(12.25),
    )


def _model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return training.score_customers(
        _current(spark, folder), _models(spark, folder), _clustering(spark, folder).assigned
    )


def _dataset(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.dashboard_dataset(
        _transactions(spark, folder),
        _customer_features(spark, folder),
        _stand_in_scores(spark, folder),
    )


def _holdout(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in scores and outcomes of the last snapshot."""
    return (
        _training(spark, folder)
        .filter(F.col("snapshot_date") == F.lit(star_schema.SNAPSHOTS[-1]))
        .select(
            "churn",
            F.col("future_revenue").cast("double").alias("actual"),
            ((F.col("recency_days") * 37 % 200) / F.lit(200.0)).alias("p"),
            (F.col("frequency") * F.lit(1024.0)).alias("guess"),
        )
    )


def _classifier_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.classifier_metrics(_holdout(spark, folder), "p", "churn")
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


def _regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.regression_metrics(_holdout(spark, folder), "actual", "guess")
    return found.select(
        F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"), F.round("r2", 9).alias("r2")
    )


def _metrics_report(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics report over metrics of the stand-in scores."""
    holdout = _holdout(spark, folder)
    found = {
        "churn_classification": metrics.classifier_metrics(holdout, "p", "churn"),
        "customer_value_regression": metrics.regression_metrics(holdout, "actual", "guess"),
    }
    long = [
        values.unpivot([], values.columns, "metric", "value").select(
            F.lit(kind).alias("model_type"),
            F.lit("stand-in").alias("model_name"),
            F.lit("test").alias("evaluation_split"),
            F.lit(star_schema.SNAPSHOTS[-1]).alias("evaluation_snapshot"),
            "metric",
            "value",
            F.lit(True).alias("selected_model"),
        )
        for kind, values in found.items()
    ]
    return reports.metrics_report(long[0].unionByName(long[1]))


def _feature_medians(spark: SparkSession, folder: str) -> DataFrame:
    names = ["avg_days_between_orders", "average_order_value", "recency_days"]
    found = exact_medians(_training(spark, folder), names)
    return spark.range(1).select(*[F.lit(found[n]).alias(n) for n in names])


def _run_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The checks of a run as counts: rules on raw lines, scores and keys."""
    price = F.col("unit_price").cast("decimal(12,3)")
    quantity = F.col("quantity").cast("int")
    lines = _stored_distinct(spark, folder).withColumns(
        {"quantity": quantity, "unit_price": price, "revenue": quantity * price}
    )
    scores = materialize(_stand_in_scores(spark, folder), "scores")
    current = _current(spark, folder)
    return (
        quality.violation_rows(lines, quality.transaction_rules(), "raw lines")
        .unionByName(quality.violation_rows(scores, quality.analytics_rules(), "scores"))
        .unionByName(quality.key_violations(scores, current, "customer_id", "scores"))
        .unionByName(quality.key_violations(lines, current, "customer_id", "raw lines"))
    )


def _cluster_profile_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of clusters that SQL can assign as well."""
    number = (F.col("customer_id").cast("long") % 2).cast("int")
    found = clusters.cluster_profiles(
        _customer_features(spark, folder).withColumn("rfm_cluster", number)
    )
    return found.select(
        "rfm_cluster",
        "customers",
        *[F.round(c, 3).alias(c) for c in found.columns if c not in ("rfm_cluster", "customers")],
    )


def _lloyd_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Three passes of the clustering from centres that SQL can start from as well."""
    features = _customer_features(spark, folder)
    points = materialize(clusters.fit_scaling(features).with_scaled(features).select(*clusters.SCALED), "scaled")
    start = np.array([[-1.0, -1, -1], [0, 0, 0], [1, 1, 1], [1, -1, -1]])
    last = lloyd.lloyd_steps(points, clusters.SCALED, [start], 2)
    found = lloyd.cluster_sums(points, clusters.SCALED, last)
    after = lloyd.lloyd_steps(points, clusters.SCALED, last, 1)[0]
    rows = [(i, *c) for i, c in enumerate(after.tolist())]
    names = ", ".join(f"{c} double" for c in clusters.SCALED)
    centres = spark.createDataFrame(rows, f"cluster int, {names}")
    return centres.join(found.select("cluster", "n", "cost"), "cluster", "left").select(
        "cluster",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.round(F.coalesce("cost", F.lit(0.0)), 5).alias("cost"),
        *[F.round(c, 6).alias(c) for c in clusters.SCALED],
    )


def _silhouette_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Silhouettes of clusters that SQL can assign as well."""
    features = _customer_features(spark, folder)
    scaled = clusters.fit_scaling(features).with_scaled(features)
    number = F.col("customer_id").cast("long")
    labelled = scaled.withColumns({"by_2": number % 2, "by_3": number % 3})
    sample = clusters.silhouette_sample(labelled, ["by_2", "by_3"])
    found = lloyd.silhouettes(sample, clusters.SCALED, ["by_2", "by_3"])
    return found.select("labelling", F.round("silhouette", 6).alias("silhouette"))


def _logistic_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Two Newton steps of a churn model on two inputs, which SQL can solve as well."""
    inputs = ("recency_days", "frequency")
    rows = training._balanced(_training(spark, folder))[0]
    means, deviations = newton.scales(rows, inputs)
    scaled = rows.select(
        *[((F.col(c) - m) / d).alias(c) for c, m, d in zip(inputs, means, deviations)], "churn", "class_weight"
    )
    beta = newton.newton_steps(materialize(scaled, "scaled"), inputs, "churn", "class_weight", 1.0, 2)
    named = list(zip(("intercept", *inputs), beta.tolist()))
    return spark.createDataFrame(named, "term string, value double").select("term", F.round("value", 7).alias("value"))


def _model_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Selection on the validation date and evaluation on the test date, with rules for models."""
    rules = {
        "recency rule": (F.col("recency_days") * 37 % 200) / F.lit(200.0),
        "frequency rule": (F.col("frequency") * 61 % 100) / F.lit(100.0),
    }
    best, _, churn = training.select_classifier(
        _training(spark, folder), list(rules), lambda name, _: training.RuleScorer(rules[name])
    )
    found = training.metric_table(spark, best, churn, [])
    return found.withColumn("value", F.round("value", 9))


def _period_reach(spark: SparkSession, folder: str) -> DataFrame:
    lines = _stored_lines(spark, folder).withColumn("month", performance.month_of(F.col("invoice_date")))
    counted = {"active_customers": "customer_id", "total_orders": "invoice_no"}
    return performance.reach_by_period(lines, ["month"], counted)


def _export_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The dataset after its export to text files and back."""
    transactions = cleaning.number_transactions(_stored_lines(spark, folder), in_order=True)
    dataset = dashboard.dashboard_dataset(
        transactions, _customer_features(spark, folder), _stand_in_scores(spark, folder), in_order=True
    )  # of stored tables
    target = f"{intermediates(spark)}/export-{uuid.uuid4().hex}"
    export_dataset(dataset, target, in_order=True)
    return read_csv(spark, target, dataset.schema)


def _text_queries() -> dict[str, Query]:
    if text_queries is None:
        return {}
    return text_queries.queries() | {"pipeline": corpus_pipeline.run}


def entry(spark: SparkSession) -> DataFrame:
    """Customer features with RFM scores and segments."""
    return _alone(_customer_features)(spark, SMOKE_FOLDER)


def queries() -> dict[str, Query]:
    return {name: _alone(query) for name, query in _own_queries().items()} | _text_queries()


def _own_queries() -> dict[str, Query]:
    return {
        "transactions": _transactions,
        "clean_transactions": lambda s, d: cleaning.accepted_lines(_distinct(s, d)),
        "quality_report": lambda s, d: cleaning.quality_report(_distinct(s, d)),
        "order_history": _order_history,
        "customer_features": _customer_features,
        "monthly_sales": lambda s, d: performance.monthly_sales(_lines(s, d)),
        "country_performance": lambda s, d: performance.country_performance(_lines(s, d)),
        "product_performance": _products,
        "snapshot_dataset": _training,
        "current_features": _current,
        "customer_analytics_rules": _stand_in_scores,
        "classifier_metrics": _classifier_metrics,
        "regression_metrics": _regression_metrics,
        "executive_dashboard": lambda s, d: dashboard.executive_dashboard(_transactions(s, d)),
        "customer_dashboard": lambda s, d: dashboard.customer_dashboard(
            _customer_features(s, d), _stand_in_scores(s, d)
        ),
        "dashboard_dataset": _dataset,
        "dashboard_integrity": lambda s, d: dashboard.integrity_metrics(_dataset(s, d)),
        "record_counts": lambda s, d: dashboard.grain_counts(
            _lines(s, d), _lines(s, d).select("customer_id").distinct()
        ),
        "export_rows": _export_rows,
        "data_validation": lambda s, d: reports.data_validation(_lines(s, d)),
        "mom_growth": lambda s, d: reports.month_growth(_lines(s, d)),
        "country_ranking": lambda s, d: reports.country_ranking(
            performance.country_performance(_lines(s, d))
        ),
        "top_products": lambda s, d: reports.top_products(_products(s, d)),
        "segment_contribution": lambda s, d: reports.segment_contribution(_customer_features(s, d)),
        "churn_distribution": lambda s, d: reports.churn_distribution(
            _stand_in_scores(s, d), _customer_features(s, d)
        ),
        "retention_targets": lambda s, d: reports.retention_targets(
            _customer_features(s, d), _stand_in_scores(s, d)
        ),
        "metrics_report": _metrics_report,
        "feature_medians": _feature_medians,
        "cluster_profile_rules": _cluster_profile_rules,
        "run_checks": _run_checks,
        "split_summary": lambda s, d: training.split_summary(_training(s, d)),
        "value_targets": lambda s, d: training.value_targets(_training(s, d)),
        "scaled_measures": lambda s, d: clusters.scaled_measures(_customer_features(s, d)),
        "period_reach": _period_reach,
        "logistic_steps": _logistic_steps,
        "model_selection": _model_selection,
        "lloyd_steps": _lloyd_steps,
        "silhouette_scores": _silhouette_scores,
        "rfm_clusters": lambda s, d: _clustering(s, d).assigned.select("customer_id", "rfm_cluster"),
        "cluster_profiles": lambda s, d: _clustering(s, d).profiles,
        "model_metrics": lambda s, d: reports.metrics_report(_models(s, d).metrics),
        "customer_analytics": _model_scores,
        "order_gaps": lambda s, d: reports.order_gaps(orders.order_dates(_sequence(s, d))),
        "pareto": lambda s, d: reports.pareto(_customer_features(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    found = dict(oracle_queries.oracle_sql())
    if text_queries is not None:
        found |= text_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
