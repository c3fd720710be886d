"""Churn classifier and 90-day value regressor on the snapshot training set."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass
from typing import Protocol

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillgrain.operators import boosting, forest, newton
from tillgrain.operators.materialize import materialize
from tillgrain.operators.ordered import exact_medians
from tillgrain.plans.metrics import classifier_metrics, regression_metrics
from tillgrain.plans.scoring import customer_analytics
from tillgrain.schemas import FEATURES, FOREST_NAME, LOGISTIC_NAME, MODEL_METRICS, VALUE_MODEL_NAME
from tillgrain.sources.tables import write_json, write_table

# Only this feature can be missing: a single order in the window has no gap.
IMPUTED = ("avg_days_between_orders",)
#: Feature columns as the models see them, and what tells the rows of the training set apart.
INPUTS = tuple(f"input_{name}" for name in FEATURES)
ROW_KEY = ("snapshot_date", "customer_id")


@dataclass(frozen=True)
class ModelSettings:
    """Sizes of the models; ``forest_depth`` bounds the trees where it is given."""

    trees: int = 300
    forest_depth: int | None = None
    forest_leaf_rows: int = 5
    forest_bins: int = 255
    boosting_rounds: int = 200
    boosting_step: float = 0.05
    boosting_leaves: int = 31
    boosting_bins: int = 255
    boosting_leaf_rows: int = 20
    logistic_iterations: int = 2000
    seed: int = 42

    def forest(self) -> forest.ForestSettings:
        tried = max(1, int(len(FEATURES) ** 0.5))
        return forest.ForestSettings(
            self.trees, self.forest_leaf_rows, tried, self.forest_bins, self.seed, depth=self.forest_depth
        )

    def boosting(self) -> boosting.BoostingSettings:
        return boosting.BoostingSettings(
            self.boosting_rounds, self.boosting_step, self.boosting_leaves, self.boosting_leaf_rows, self.boosting_bins, self.seed
        )


def with_inputs(rows: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """``rows`` with the inputs of the models: features as doubles, missing ones set to medians."""

    def value(name: str):
        number = F.col(name).cast("double")
        return F.coalesce(number, F.lit(float(medians.get(name, 0.0)))) if name in IMPUTED else number

    return rows.withColumns({f"input_{name}": value(name) for name in FEATURES})


@dataclass(frozen=True)
class ChurnModel:
    """One of the two classifiers with the medians it was fitted with."""

    medians: Mapping[str, float]
    logistic: newton.Logistic | None = None
    trees: forest.Forest | None = None

    def scores(self, rows: DataFrame) -> DataFrame:
        """``rows`` and ``churn_score``."""
        given = with_inputs(rows, self.medians)
        if self.logistic is not None:
            scored = given.withColumn("churn_score", self.logistic.probability())
        else:
            scored = forest.forest_scores(self.trees, given, "churn_score")
        return scored.select(*rows.columns, "churn_score")

    def write(self, spark: SparkSession, path: str) -> None:
        form = {"medians": dict(self.medians)}
        if self.logistic is not None:
            form["logistic"] = asdict(self.logistic)
        else:
            trees = self.trees
            form["forest"] = {"inputs": trees.inputs, "edges": trees.edges, "tops": [asdict(t) for t in trees.tops]}
            write_table(trees.grown, f"{path}/trees")
        _write_form(spark, form, path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> ChurnModel:
        form = _read_form(spark, path)
        if "logistic" in form:
            found = {k: tuple(v) if isinstance(v, list) else v for k, v in form["logistic"].items()}
            return cls(form["medians"], logistic=newton.Logistic(**found))
        kept = form["forest"]
        tops = [forest.Top(**t) for t in kept["tops"]]
        grown = spark.read.schema(forest.GROWN_DDL).parquet(f"{path}/trees")
        return cls(form["medians"], trees=forest.Forest(tuple(kept["inputs"]), kept["edges"], tops, grown))


@dataclass(frozen=True)
class ValueModel:
    """Boosted trees on the log of future revenue."""

    medians: Mapping[str, float]
    boosted: boosting.Boosted

    def scores(self, rows: DataFrame) -> DataFrame:
        """``rows`` and ``value_score``, turned back from logs and not below 0."""
        scored = boosting.boosted_scores(self.boosted, with_inputs(rows, self.medians), "_log")
        value = F.greatest(F.expm1("_log"), F.lit(0.0))
        return scored.withColumn("value_score", value).select(*rows.columns, "value_score")

    def write(self, spark: SparkSession, path: str) -> None:
        boosted = self.boosted
        trees = [{k: v.tolist() for k, v in vars(t).items()} for t in boosted.trees]
        form = {"inputs": boosted.inputs, "edges": boosted.edges, "base": boosted.base, "trees": trees, "losses": boosted.losses}
        _write_form(spark, {"medians": dict(self.medians), "boosted": form}, path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> ValueModel:
        form = _read_form(spark, path)
        kept = form["boosted"]
        trees = [boosting.Tree(**{k: np.array(v) for k, v in t.items()}) for t in kept["trees"]]
        return cls(form["medians"], boosting.Boosted(tuple(kept["inputs"]), kept["edges"], kept["base"], trees, kept["losses"]))


def _write_form(spark: SparkSession, form: Mapping, path: str) -> None:
    """What all tasks need of a model, as one JSON record of text."""
    write_json(spark.createDataFrame([(json.dumps(form),)], "form string"), f"{path}/form")


def _read_form(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.schema("form string").json(f"{path}/form").first()["form"])


@dataclass(frozen=True)
class TrainedModels:
    classifier_name: str
    classifier: ChurnModel
    value_model: ValueModel
    metrics: DataFrame
    validation_date: dt.date
    test_date: dt.date


def temporal_split(snapshots: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, dt.date, dt.date]:
    """Train, validation (second last date) and test (last date)."""
    dates = sorted(r[0] for r in snapshots.select("snapshot_date").distinct().collect())
    if len(dates) < 3:
        raise ValueError("Training needs at least three snapshot dates.")
    validation_date, test_date = dates[-2:]
    day = F.col("snapshot_date")
    return (
        snapshots.filter(day < F.lit(validation_date)),
        snapshots.filter(day == F.lit(validation_date)),
        snapshots.filter(day == F.lit(test_date)),
        validation_date,
        test_date,
    )


def split_summary(snapshots: DataFrame) -> DataFrame:
    """Per part of the temporal split and outcome: rows and the weight that balances outcomes."""
    parts = zip(("train", "validation", "test"), temporal_split(snapshots)[:3])
    counted = [
        rows.groupBy("churn").agg(F.count(F.lit(1)).alias("customers"))
        .select(F.lit(name).alias("split"), "churn", "customers")
        for name, rows in parts
    ]
    table = counted[0].unionByName(counted[1]).unionByName(counted[2])
    whole = Window.partitionBy("split")  # two rows per split
    weight = F.sum("customers").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("customers"))
    return table.withColumn("class_weight", F.round(weight, 9))


def value_targets(snapshots: DataFrame) -> DataFrame:
    """The target of the value model per row, and the value its inverse gives back."""
    target = F.log1p(F.greatest(F.col("future_revenue").cast("double"), F.lit(0.0)))
    return snapshots.select(
        "snapshot_date",
        "customer_id",
        F.round(target, 6).alias("log_revenue"),
        F.round(F.greatest(F.expm1(target), F.lit(0.0)), 3).alias("value"),
    )


def _balanced(rows: DataFrame) -> tuple[DataFrame, int]:
    """Weights that give both outcomes the same total, and the row count."""
    counts = {r["churn"]: r["count"] for r in rows.groupBy("churn").count().collect()}
    n = sum(counts.values())
    weight = F.lit(1.0)
    for label, count in counts.items():
        weight = F.when(F.col("churn") == label, n / (len(counts) * count)).otherwise(weight)
    return rows.withColumn("class_weight", weight), n


def fit_classifier(
    name: str, rows: DataFrame, medians: Mapping[str, float], settings: ModelSettings
) -> ChurnModel:
    given = with_inputs(rows, medians)
    if name == LOGISTIC_NAME:
        weighted = materialize(_balanced(given)[0].select(*INPUTS, "churn", "class_weight"), "weighted")
        found = newton.fit_logistic(weighted, INPUTS, "churn", "class_weight", 1.0, settings.logistic_iterations)
        return ChurnModel(dict(medians), logistic=found)
    return ChurnModel(dict(medians), trees=forest.fit_forest(given, INPUTS, "churn", ROW_KEY, settings.forest()))


def churn_scores(model: ChurnModel, rows: DataFrame) -> DataFrame:
    return model.scores(rows)


def fit_value_model(
    rows: DataFrame, medians: Mapping[str, float], settings: ModelSettings
) -> ValueModel:
    target = F.log1p(F.greatest(F.col("future_revenue").cast("double"), F.lit(0.0)))
    given = with_inputs(rows, medians).withColumn("log_revenue", target)
    return ValueModel(dict(medians), boosting.fit_boosted(given, INPUTS, "log_revenue", ROW_KEY, settings.boosting()))


def value_scores(model: ValueModel, rows: DataFrame) -> DataFrame:
    return model.scores(rows)


class Scorer(Protocol):
    """A fitted classifier, or anything that adds ``churn_score`` to rows."""

    def scores(self, rows: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class RuleScorer:
    """A classifier that is an expression over the features."""

    score: Column

    def scores(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("churn_score", self.score)


def _evaluated(model: Scorer, rows: DataFrame) -> dict[str, float]:
    return classifier_metrics(model.scores(rows), "churn_score", "churn").first().asDict()


def select_classifier(
    snapshots: DataFrame, names: Sequence[str], fit: Callable[[str, DataFrame], Scorer]
) -> tuple[str, Scorer, list[tuple]]:
    """The classifier of greatest area under the ROC curve on the validation date, fitted again on
    all dates before the test date, and rows (model, split, date, metric, value).

    ``fit`` takes a name and rows. All candidates are evaluated on the validation date, the one
    selected on the test date, once. Equal areas go to the first name.
    """
    train, validation, test, validation_date, test_date = temporal_split(snapshots)
    if train.isEmpty():
        raise ValueError("The temporal split left no training rows.")
    on_validation = {name: _evaluated(fit(name, train), validation) for name in names}
    best = max(names, key=lambda name: on_validation[name]["roc_auc"])
    chosen = fit(best, snapshots.filter(F.col("snapshot_date") < F.lit(test_date)))
    found = [(name, "validation", validation_date, m) for name, m in on_validation.items()]
    found.append((best, "test", test_date, _evaluated(chosen, test)))
    return best, chosen, [(n, s, d, metric, v) for n, s, d, m in found for metric, v in m.items()]


def metric_table(spark: SparkSession, selected: str, churn: list[tuple], value: list[tuple]) -> DataFrame:
    """Rows of both models as the metrics table; the value model is always the selected one."""
    rows = [("churn_classification", *r, r[0] == selected) for r in churn]
    rows += [("customer_value_regression", *r, True) for r in value]
    return spark.createDataFrame(rows, MODEL_METRICS)


def train_models(snapshots: DataFrame, settings: ModelSettings = ModelSettings()) -> TrainedModels:
    """Select the classifier on the validation date, refit on all dates before the test
    date, and evaluate once on the test date."""
    stored = materialize(snapshots, "training")
    _, _, test, validation_date, test_date = temporal_split(stored)

    def fit(name: str, rows: DataFrame) -> ChurnModel:
        return fit_classifier(name, rows, exact_medians(rows, IMPUTED), settings)

    best, classifier, churn = select_classifier(stored, (LOGISTIC_NAME, FOREST_NAME), fit)
    development = stored.filter(F.col("snapshot_date") < F.lit(test_date))
    value_model = fit_value_model(development, classifier.medians, settings)
    found = regression_metrics(value_scores(value_model, test), "future_revenue", "value_score").first().asDict()
    value = [(VALUE_MODEL_NAME, "test", test_date, metric, v) for metric, v in found.items()]
    frame = metric_table(snapshots.sparkSession, best, churn, value)
    return TrainedModels(best, classifier, value_model, frame, validation_date, test_date)


def score_customers(current: DataFrame, models: TrainedModels, assigned: DataFrame) -> DataFrame:
    """Scores and clusters of all current customers."""
    scored = value_scores(models.value_model, churn_scores(models.classifier, current))
    clustered = scored.join(assigned.select("customer_id", "rfm_cluster"), "customer_id", "left")
    return customer_analytics(clustered, F.col("churn_score"), F.col("value_score"))
