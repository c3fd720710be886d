"""The ten analyst reports. Open ties are broken by the row's own key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.functions.exact import MONEY, mean, percent
from tillgrain.operators.distinct import totals_with_distinct
from tillgrain.operators.ordered import POSITION, SLICE, slice_offsets, spread_in_order
from tillgrain.plans.performance import month_of


def data_validation(transactions: DataFrame) -> DataFrame:
    counted = {"orders": F.col("invoice_no"), "customers": F.col("customer_id")}
    day = F.col("invoice_date")
    found = totals_with_distinct(
        transactions, counted, {"total_revenue": F.col("revenue")}, {"first_transaction": day}, {"last_transaction": day}
    )
    summed = transactions.select(F.sum("revenue").alias("revenue")).schema["revenue"].dataType
    return found.select(
        F.col("_rows").alias("transaction_rows"), "orders", "customers", "first_transaction", "last_transaction",
        F.col("total_revenue").cast(summed).alias("total_revenue"),
    )


def month_growth(transactions: DataFrame) -> DataFrame:
    """Growth over the previous month that has sales. The window holds one row per month."""
    monthly = transactions.groupBy(month_of(F.col("invoice_date")).alias("month")).agg(
        F.sum("revenue").alias("revenue")
    )
    previous = F.col("previous_month_revenue")
    return (
        monthly.withColumn(
            "previous_month_revenue", F.lag("revenue").over(Window.orderBy("month"))
        )
        .withColumn(
            "month_over_month_growth_pct", percent(F.col("revenue") - previous, previous)
        )
        .orderBy("month")
    )


def country_ranking(country_performance: DataFrame) -> DataFrame:
    return country_performance.select(
        "country", "customers", "orders", "revenue", "average_order_value"
    ).orderBy(F.desc("revenue"), "country")


def top_products(product_performance: DataFrame, limit: int = 20) -> DataFrame:
    return product_performance.orderBy(F.desc("revenue"), "stock_code").limit(limit)


def segment_contribution(customer_features: DataFrame) -> DataFrame:
    customers = F.count(F.lit(1))

    return (
        customer_features.groupBy("rfm_segment")
        .agg(
            customers.alias("customers"),
            F.sum("monetary").alias("historical_revenue"),
            mean(F.sum("recency_days"), customers, 1, "decimal(12,1)").alias("average_recency"),
            mean(F.sum("frequency"), customers, 1, "decimal(12,1)").alias("average_frequency"),
            mean(F.sum("monetary"), customers, 2, MONEY).alias("average_monetary"),
        )
        .orderBy(F.desc("historical_revenue"), "rfm_segment")
    )


def churn_distribution(customer_analytics: DataFrame, customer_features: DataFrame) -> DataFrame:
    customers = F.count(F.lit(1))
    urgency = F.when(F.col("churn_risk_band") == "High", 1).when(
        F.col("churn_risk_band") == "Medium", 2
    )
    return (
        customer_analytics.join(customer_features.select("customer_id", "monetary"), "customer_id")
        .groupBy("churn_risk_band")
        .agg(
            customers.alias("customers"),
            mean(
                F.sum("churn_probability"), customers, 4, "decimal(6,4)", scale=4
            ).alias("average_probability"),
            F.sum("monetary").alias("historical_revenue"),
            F.sum("predicted_90d_value").alias("predicted_90d_value"),
        )
        .orderBy(F.coalesce(urgency, F.lit(3)))
    )


def retention_targets(
    customer_features: DataFrame, customer_analytics: DataFrame, limit: int = 50
) -> DataFrame:
    at_risk = customer_analytics.filter(F.col("churn_risk_band") == "High").select(
        "customer_id", "churn_probability", "predicted_90d_value"
    )
    return (
        customer_features.select(
            "customer_id", "primary_country", "rfm_segment", "recency_days", "frequency", "monetary"
        )
        .join(at_risk, "customer_id")
        .orderBy(F.desc("monetary"), "customer_id")
        .limit(limit)
    )


def metrics_report(model_metrics: DataFrame) -> DataFrame:
    return model_metrics.withColumn("value", F.col("value").cast("decimal(20,4)")).orderBy(
        "model_type", "evaluation_split", "model_name", "metric"
    )


def order_gaps(order_history: DataFrame, limit: int = 100) -> DataFrame:
    return (
        order_history.filter(F.col("previous_order_date").isNotNull())
        .select(
            "customer_id",
            "invoice_no",
            "order_date",
            "previous_order_date",
            "days_since_previous_order",
            "order_revenue",
        )
        .orderBy("customer_id", "order_date", "invoice_no")
        .limit(limit)
    )


def pareto(customer_features: DataFrame) -> DataFrame:
    """Customers by falling revenue, with rank and cumulative share.

    Customers of equal revenue share the running total at their group's end. Within
    a slice the default window frame does that; a group that runs on into later
    slices adds the revenue of its leading rows there.
    """
    ordered = spread_in_order(
        customer_features.select("customer_id", "monetary"),
        [F.desc("monetary"), "customer_id"],
        "pareto",
    )
    revenue = F.col("monetary").cast("decimal(28,2)")
    offsets = slice_offsets(ordered, revenue=revenue)
    edges = ordered.groupBy(SLICE).agg(
        F.max("monetary").alias("highest"), F.min("monetary").alias("lowest")
    )
    # Only a slice's highest value can continue from an earlier slice.
    leading = (
        ordered.join(F.broadcast(edges), SLICE)
        .groupBy(SLICE, "highest", "lowest")
        .agg(F.sum(F.when(F.col("monetary") == F.col("highest"), revenue)).alias("leading"))
    )
    # Two rows per slice: what it holds of its highest value, and a request for the
    # revenue that later slices hold of its lowest value.
    marks = leading.select(
        SLICE,
        F.inline(
            F.array(
                F.struct(F.col("highest").alias("monetary"), "leading", F.lit(False).alias("asks")),
                F.struct(
                    F.col("lowest").alias("monetary"),
                    F.lit(0).cast("decimal(38,2)").alias("leading"),
                    F.lit(True).alias("asks"),
                ),
            )
        ),
    )
    later_slices = (
        Window.partitionBy("monetary").orderBy(F.desc(SLICE)).rangeBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        marks.withColumn("carried", F.sum("leading").over(later_slices))
        .filter(F.col("asks"))
        .select(SLICE, "monetary", "carried")
    )

    totals = customer_features.agg(
        F.count(F.lit(1)).alias("customers"), F.sum(revenue).alias("revenue")
    )
    customers = totals.select("customers").scalar()
    total_revenue = totals.select("revenue").scalar()
    within = Window.partitionBy(SLICE).orderBy(F.desc("monetary"))
    rank = (F.col("rows_before") + F.col(POSITION) + 1).cast("long")
    cumulative = (
        F.col("revenue_before") + F.sum(revenue).over(within) + F.coalesce("carried", F.lit(0))
    )
    # Slices are in rank order: one exchange by slice serves the window and the final order.
    return (
        ordered.repartitionByRange(SLICE)
        .join(F.broadcast(offsets), SLICE)
        .join(F.broadcast(carried), [SLICE, "monetary"], "left")
        .select(
            rank.alias("customer_rank"),
            "customer_id",
            "monetary",
            percent(rank, customers).alias("customer_pct"),
            percent(cumulative, total_revenue).alias("cumulative_revenue_pct"),
        )
        .sortWithinPartitions("customer_rank")
    )
