"""The whole run in one Spark application: raw lines in, published tables out."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tillgrain.operators.materialize import dropping_intermediates, materialize
from tillgrain.plans import cleaning, customers, dashboard, orders, performance, quality
from tillgrain.plans import reports, snapshots
from tillgrain.plans.clusters import Clustering, ClusterModel, fit_rfm_clusters
from tillgrain.plans.training import (
    ChurnModel,
    ModelSettings,
    TrainedModels,
    ValueModel,
    score_customers,
    train_models,
)
from tillgrain.schemas import (
    COUNTRY_SPELLINGS,
    CUSTOMER_ANALYTICS,
    OBSERVATION_DAYS,
    PREDICTION_DAYS,
    SNAPSHOT_DATES,
)
from tillgrain.sources import commits
from tillgrain.sources.export import export_dataset
from tillgrain.sources.layout import MONTH, is_bucketed, read_bucketed, with_month, write_bucketed
from tillgrain.sources.paths import delete, exists
from tillgrain.sources.raw_lines import load_periods
from tillgrain.sources.tables import (
    model_inputs,
    register_view,
    write_clean_csv,
    write_json,
    write_table,
)

TABLES = (
    "transactions",
    "customer_order_history",
    "customer_features",
    "monthly_sales",
    "country_performance",
    "product_performance",
    "customer_analytics",
    "cluster_profiles",
    "model_metrics",
)
REPORTS = ("data_quality_report", "model_metadata")
MODELS = ("rfm_clusters", "churn_classifier", "customer_value")
EXPORT = "dashboard_dataset"
# Published runs that stay: the current one, and the one before for those who still read it.
RUNS_KEPT = 2


def model_metadata(
    spark: SparkSession,
    snapshot_dates: Sequence[dt.date],
    clustering: Clustering,
    models: TrainedModels,
) -> DataFrame:
    """One row describing the run, with a list of dates and a map of scores per k."""
    row = (
        OBSERVATION_DAYS,
        PREDICTION_DAYS,
        [d.isoformat() for d in snapshot_dates],
        models.validation_date.isoformat(),
        models.test_date.isoformat(),
        "validation_roc_auc",
        models.classifier_name,
        clustering.selected_k,
        clustering.silhouettes,
    )
    return spark.createDataFrame(
        [row],
        "observation_window_days int, prediction_window_days int, snapshot_dates array<string>,"
        " validation_snapshot string, test_snapshot string,"
        " classification_selection_metric string, selected_churn_model string,"
        " selected_k int, silhouette_scores map<int,double>",
    )


def run(
    spark: SparkSession,
    periods: Mapping[str, str],
    out: str,
    file_format: str = "csv",
    country_map: Mapping[str, str] = COUNTRY_SPELLINGS,
    snapshot_dates: Sequence[dt.date] = SNAPSHOT_DATES,
    settings: ModelSettings = ModelSettings(),
    clean_csv: bool = False,
    follow_others: bool = True,
    **cluster_options: int,
) -> dict[str, int]:
    """Build and publish everything under ``out``; returns the exported rows per grain.

    A run writes to a folder of its own and enters the log of commits last, so a run that fails at
    any step leaves the earlier one current and whole. Runs at the same time do not see each other:
    the one that ends later follows the other in the log, or with ``follow_others`` off is refused.
    Folders of runs older than the last two in the log go.
    """
    missing = [p for p in periods.values() if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"Input not found: {missing}")
    base = out.rstrip("/")
    run_name = f"run-{uuid.uuid4().hex}"
    staging = f"{base}/{run_name}"
    before = commits.latest(spark, base)
    try:
        with dropping_intermediates(spark):
            raw = load_periods(spark, periods, file_format)
            parts = _build(
                spark, raw, staging, country_map, snapshot_dates, settings, clean_csv, cluster_options
            )
            counts = export_dataset(parts, f"{staging}/{EXPORT}")
        made = commits.commit(spark, base, run_name, before.version if before else 0, follow_others)
    except Exception:
        delete(spark, staging)
        raise
    for version in commits.versions(spark, base):
        if version <= made.version - RUNS_KEPT:
            delete(spark, f"{base}/{commits.commit_at(spark, base, version).run}")
    return counts


def published(spark: SparkSession, out: str, name: str) -> str:
    """Path of a published table, report, model or export of the current run."""
    current = commits.latest(spark, out)
    if current is None:
        raise FileNotFoundError(f"Nothing is published under {out}.")
    return f"{out.rstrip('/')}/{current.run}/{name}"


def _build(
    spark: SparkSession,
    raw: DataFrame,
    staging: str,
    country_map: Mapping[str, str],
    snapshot_dates: Sequence[dt.date],
    settings: ModelSettings,
    clean_csv: bool,
    cluster_options: Mapping[str, int],
) -> DataFrame:
    def table(df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{staging}/{name}")

    def checked(df: DataFrame, name: str, rules: Mapping[str, Column], write=write_table) -> DataFrame:
        return quality.written_checked(df, f"{staging}/{name}", rules, name, write)

    def by_month(df: DataFrame, path: str) -> DataFrame:
        return write_table(df, path, MONTH)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def by_customer(df: DataFrame, path: str) -> DataFrame:
        return write_bucketed(df, path, "customer_id", buckets)

    lines = cleaning.normalise(raw, country_map, strict=True)
    distinct = materialize(cleaning.distinct_lines(lines), "distinct")
    write_json(cleaning.quality_report(distinct), f"{staging}/data_quality_report")
    accepted = cleaning.accepted_lines(distinct)
    if clean_csv:
        write_clean_csv(accepted, f"{staging}/clean_transactions")
    numbered = with_month(cleaning.number_transactions(accepted))
    transactions = checked(numbered, "transactions", quality.transaction_rules(), by_month)

    # The window over each customer's orders runs once; four products read its result.
    sequence = materialize(orders.sequenced(orders.invoices(transactions)), "sequence")
    table(orders.history_rows(sequence), "customer_order_history")
    features = by_customer(customers.customer_features(transactions, sequence), f"{staging}/customer_features")
    table(performance.monthly_sales(transactions), "monthly_sales")
    table(performance.country_performance(transactions), "country_performance")
    table(performance.product_performance(transactions), "product_performance")

    clustering = fit_rfm_clusters(features, **cluster_options)
    inputs = model_inputs(transactions)
    models = train_models(
        snapshots.snapshot_dataset(inputs, snapshot_dates, sequenced_invoices=sequence), settings
    )
    current = snapshots.current_features(inputs, sequenced_invoices=sequence)
    analytics = checked(
        score_customers(current, models, clustering.assigned).select(*CUSTOMER_ANALYTICS.names),
        "customer_analytics",
        quality.analytics_rules(),
        by_customer,
    )
    checked(clustering.profiles, "cluster_profiles", quality.profile_rules())
    found = checked(models.metrics, "model_metrics", quality.metric_rules())
    quality.require_unique(
        found, ["model_type", "model_name", "evaluation_split", "metric"], "model_metrics"
    )
    quality.require_reference(analytics, features, "customer_id", "customer_analytics")
    quality.joined_one_to_one(
        features,
        analytics,
        "customer_id",
        ["rfm_segment", "churn_probability", "predicted_90d_value"],
        "customer dashboard",
    )
    write_json(
        model_metadata(spark, snapshot_dates, clustering, models), f"{staging}/model_metadata"
    )
    table(clustering.model.table(spark), MODELS[0])
    for name, model in zip(MODELS[1:], (models.classifier, models.value_model)):
        model.write(spark, f"{staging}/{name}")
    return dashboard.dashboard_dataset(transactions, features, analytics)


def published_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The published tables, with their buckets where they have any; folders by month are no column."""
    paths = {name: published(spark, out, name) for name in TABLES}
    return {
        name: read_bucketed(spark, path) if is_bucketed(spark, path) else spark.read.parquet(path).drop(MONTH)
        for name, path in paths.items()
    }


def published_models(spark: SparkSession, out: str) -> dict[str, ClusterModel | ChurnModel | ValueModel]:
    """The models of the current run, ready to score."""
    clusters, churn, value = (published(spark, out, name) for name in MODELS)
    return {
        MODELS[0]: ClusterModel.read(spark.read.parquet(clusters)),
        MODELS[1]: ChurnModel.read(spark, churn),
        MODELS[2]: ValueModel.read(spark, value),
    }


def register_views(spark: SparkSession, out: str) -> None:
    """Make the published tables and the three reporting views available to ``spark.sql``."""
    t = published_tables(spark, out)
    features, scores = t["customer_features"], t["customer_analytics"]
    views = {
        **t,
        "executive_dashboard": dashboard.executive_dashboard(t["transactions"]),
        "customer_dashboard": dashboard.customer_dashboard(features, scores),
        "dashboard_dataset": dashboard.dashboard_dataset(t["transactions"], features, scores),
    }
    for name, df in views.items():
        register_view(df, name)


def analyst_reports(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The ten analyst reports over the published tables."""
    t = published_tables(spark, out)
    return {
        "data_validation": reports.data_validation(t["transactions"]),
        "mom_growth": reports.month_growth(t["transactions"]),
        "country_ranking": reports.country_ranking(t["country_performance"]),
        "top_products": reports.top_products(t["product_performance"]),
        "segment_contribution": reports.segment_contribution(t["customer_features"]),
        "churn_distribution": reports.churn_distribution(
            t["customer_analytics"], t["customer_features"]
        ),
        "retention_targets": reports.retention_targets(
            t["customer_features"], t["customer_analytics"]
        ),
        "metrics_report": reports.metrics_report(t["model_metrics"]),
        "order_gaps": reports.order_gaps(t["customer_order_history"]),
        "pareto": reports.pareto(t["customer_features"]),
    }
