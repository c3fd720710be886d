"""Evaluation metrics of classifiers and regressors, computed as aggregates.

The built-in area under the precision-recall curve interpolates between points;
average precision does not, so both areas are summed here from the exact curve.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.operators.ordered import POSITION, SLICE, slice_offsets, spread_in_order

THRESHOLD = 0.5


def classifier_metrics(scores: DataFrame, probability: str, label: str) -> DataFrame:
    """One row with roc_auc, pr_auc, f1, precision and recall; undefined ratios are 0.

    Rows are first counted per distinct score, so equal scores form one curve point,
    and the curve is accumulated over slices of the sorted scores.
    """
    is_positive = F.col(label) == 1
    predicted = F.col("score") >= THRESHOLD
    points = scores.groupBy(F.col(probability).alias("score")).agg(
        F.count_if(is_positive).alias("positives"), F.count_if(~is_positive).alias("negatives")
    )
    ordered = spread_in_order(points, [F.desc("score")], "curve")
    offsets = slice_offsets(ordered, positives=F.col("positives"), negatives=F.col("negatives"))
    within = Window.partitionBy(SLICE).orderBy(POSITION)
    curve = (
        ordered.join(F.broadcast(offsets), SLICE)
        .withColumn("tp", F.col("positives_before") + F.sum("positives").over(within))
        .withColumn("fp", F.col("negatives_before") + F.sum("negatives").over(within))
    )

    def total(column: Column) -> Column:
        return F.sum(column).cast("double")

    # Pairs ranked correctly: each negative beats no positive above it, half of its ties.
    ranked = F.col("negatives") * (
        (F.col("tp") - F.col("positives")).cast("double") + F.col("positives") / F.lit(2.0)
    )
    summed = curve.agg(
        total(F.col("positives")).alias("p"),
        total(F.col("negatives")).alias("n"),
        F.sum(ranked).alias("ranked"),
        F.sum(F.col("positives") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("gained"),
        total(F.when(predicted, F.col("positives")).otherwise(0)).alias("hits"),
        total(F.when(predicted, F.col("negatives")).otherwise(0)).alias("false_alarms"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0.0)), F.lit(0.0))

    p, n, hits, false_alarms = (F.col(c) for c in ("p", "n", "hits", "false_alarms"))
    return summed.select(
        share(F.col("ranked"), p * n).alias("roc_auc"),
        share(F.col("gained"), p).alias("pr_auc"),
        share(hits * 2, hits + false_alarms + p).alias("f1"),
        share(hits, hits + false_alarms).alias("precision"),
        share(hits, p).alias("recall"),
    )


def regression_metrics(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row with mae, rmse and r2."""
    truth, error = F.col(actual).cast("double"), F.col(actual) - F.col(predicted)
    return predictions.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (
            F.lit(1.0)
            - F.sum(error * error)
            / F.nullif(F.var_pop(truth) * F.count(truth), F.lit(0.0))
        ).alias("r2"),
    )
