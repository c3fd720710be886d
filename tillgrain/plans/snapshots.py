"""Training sets at past snapshot dates and the current feature set.

An order belongs to a snapshot's history or outcome by its own timestamp. Each
order is tagged with all snapshots it serves in one pass; since windows are a few
months long, one row yields a handful of copies whatever the number of snapshots.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.plans.orders import invoice_totals, sequenced
from tillgrain.schemas import OBSERVATION_DAYS, PREDICTION_DAYS, SNAPSHOT_DATES
from tillgrain.sources.layout import within_months


def _midnight(date: Column) -> Column:
    return date.cast("timestamp_ntz")


def _tagged(
    df: DataFrame, snapshots: Sequence[dt.date], moment: str, before: int, after: int
) -> DataFrame:
    """Rows once per snapshot with ``moment`` in ``[snapshot - before, snapshot + after)`` days.

    The overall range is a filter that reaches the scan, and names the folders of lines that lie
    in folders by month. The tags are plain comparisons
    in an exploded array, which stays in generated code; a lambda over the dates or a
    join on ranges would not.
    """

    def day(date: dt.date, shift: int) -> Column:
        return _midnight(F.lit(date + dt.timedelta(days=shift)))

    df = within_months(
        df, min(snapshots) - dt.timedelta(days=before), max(snapshots) + dt.timedelta(days=max(after, 1) - 1)
    )
    at = F.col(moment)
    in_reach = (at >= day(min(snapshots), -before)) & (at < day(max(snapshots), after))
    tags = [F.when((at >= day(s, -before)) & (at < day(s, after)), F.lit(s)) for s in snapshots]
    return (
        df.filter(in_reach)
        .withColumn("snapshot_date", F.explode(F.array_compact(F.array(*tags))))
    )


def _elapsed_days(earlier: Column, later: Column) -> Column:
    """Whole days between two timestamps, rounded down."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.call_function("div", micros, F.lit(86_400_000_000))


def _history_measures(inside: Column, window_start: Column) -> dict[str, Column]:
    """Aggregates over the orders for which ``inside`` holds."""
    gap = F.when(
        inside & (F.col("previous_timestamp") >= _midnight(window_start)),
        _elapsed_days(F.col("previous_timestamp"), F.col("order_timestamp")),
    )
    revenue = F.sum(F.when(inside, F.col("exact_revenue"))).cast("decimal(24,3)")
    orders = F.count_if(inside)
    return {
        "frequency": orders,
        "monetary": revenue,
        "average_order_value": revenue.cast("double") / F.nullif(orders, F.lit(0).cast("long")),
        "active_days": F.count_distinct(F.when(inside, F.to_date("order_timestamp"))),
        "avg_days_between_orders": F.sum(gap).cast("double")
        / F.nullif(F.count(gap), F.lit(0).cast("long")),
    }


def check_spacing(snapshots: Sequence[dt.date], prediction_days: int) -> None:
    """Refuse snapshots closer than the outcome window, whose outcomes lie in later features."""
    ordered = sorted(snapshots)
    for earlier, later in zip(ordered, ordered[1:]):
        if (later - earlier).days < prediction_days:
            raise ValueError(
                f"Snapshots {earlier} and {later} are closer than {prediction_days} days."
            )


def snapshot_dataset(
    transactions: DataFrame,
    snapshots: Sequence[dt.date] = SNAPSHOT_DATES,
    observation_days: int = OBSERVATION_DAYS,
    prediction_days: int = PREDICTION_DAYS,
    sequenced_invoices: DataFrame | None = None,
    spaced: bool = False,
) -> DataFrame:
    """Features and outcomes per snapshot and customer with an order in its history.

    ``spaced`` asks for ``check_spacing`` first.
    """
    if spaced:
        check_spacing(snapshots, prediction_days)
    orders = sequenced_invoices
    if orders is None:
        orders = sequenced(invoice_totals(transactions))
    keys = ["snapshot_date", "customer_id"]
    snapshot = F.col("snapshot_date")

    tagged = _tagged(orders, snapshots, "order_timestamp", observation_days, prediction_days)
    inside = F.col("order_timestamp") < _midnight(snapshot)
    outcome = F.coalesce(F.sum(F.when(~inside, F.col("exact_revenue"))), F.lit(0))
    measured = (
        tagged.groupBy(*keys)
        .agg(
            F.max(F.when(inside, F.col("order_timestamp"))).alias("last_order_date"),
            *[
                c.alias(name)
                for name, c in _history_measures(
                    inside, F.date_sub(snapshot, observation_days)
                ).items()
            ],
            F.count_if(~inside).alias("future_orders"),
            outcome.cast("decimal(24,3)").alias("future_revenue"),
        )
        .filter(F.col("frequency") > 0)
    )
    variety = (
        _tagged(transactions, snapshots, "invoice_date", observation_days, 0)
        .groupBy(*keys)
        .agg(F.count_distinct("stock_code").alias("unique_products"))
    )
    first_orders = orders.groupBy("customer_id").agg(
        F.to_date(F.min("order_timestamp")).alias("first_day")
    )
    return (
        measured.join(variety, keys, "left")
        .join(first_orders, "customer_id")
        .select(
            "customer_id",
            F.datediff(snapshot, F.to_date("last_order_date")).alias("recency_days"),
            "frequency",
            "monetary",
            "average_order_value",
            "unique_products",
            "active_days",
            F.datediff(snapshot, F.col("first_day")).alias("tenure_days"),
            "avg_days_between_orders",
            "last_order_date",
            "future_orders",
            "future_revenue",
            (F.col("future_orders") == 0).cast("int").alias("churn"),
            "snapshot_date",
        )
    )


def current_features(
    transactions: DataFrame,
    observation_days: int = OBSERVATION_DAYS,
    sequenced_invoices: DataFrame | None = None,
) -> DataFrame:
    """Features of every customer on the day after the last line, inactive ones included.

    All customers come out of one aggregate over their orders; the window only decides
    which orders count, so nobody has to be joined back in.
    """
    orders = sequenced_invoices
    if orders is None:
        orders = sequenced(invoice_totals(transactions))
    # One value, read first: as a literal it lets the scan skip lines before the window.
    last_day = transactions.agg(F.max("invoice_date").cast("date").alias("day")).first()["day"]
    if last_day is None:
        raise ValueError("There are no transactions.")
    today = F.lit(last_day + dt.timedelta(days=1))
    start = F.lit(last_day + dt.timedelta(days=1 - observation_days))
    inside = F.col("order_timestamp") >= _midnight(start)
    measured = orders.groupBy("customer_id").agg(
        *[c.alias(name) for name, c in _history_measures(inside, start).items()],
        F.to_date(F.min("order_timestamp")).alias("first_day"),
        F.to_date(F.max("order_timestamp")).alias("last_day"),
    )
    recent = within_months(transactions, last_day + dt.timedelta(days=1 - observation_days), last_day)
    variety = (
        recent.filter(F.col("invoice_date") >= _midnight(start))
        .groupBy("customer_id")
        .agg(F.count_distinct("stock_code").alias("unique_products"))
    )
    zero = F.lit(0)
    return measured.join(variety, "customer_id", "left").select(
        "customer_id",
        F.datediff(today, F.col("last_day")).alias("recency_days"),
        "frequency",
        F.coalesce("monetary", zero).cast("decimal(24,3)").alias("monetary"),
        F.coalesce("average_order_value", zero.cast("double")).alias("average_order_value"),
        F.coalesce("unique_products", zero.cast("long")).alias("unique_products"),
        "active_days",
        F.datediff(today, F.col("first_day")).alias("tenure_days"),
        "avg_days_between_orders",
    )
