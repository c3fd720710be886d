"""Lifetime features, scores and labels per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.functions.exact import MONEY, mean
from tillgrain.functions.labels import churn_status, rfm_segment
from tillgrain.operators.materialize import materialize
from tillgrain.operators.ordered import tile_scores
from tillgrain.plans.orders import invoice_totals

SCORES = ("recency_score", "frequency_score", "monetary_score")


def lifetime_measures(transactions: DataFrame, invoice_rows: DataFrame) -> DataFrame:
    """One row per customer, before scoring.

    Gaps between consecutive order dates add up to last minus first date, so their
    mean needs no window. The analysis date is a scalar subquery, not a join.
    """
    order_date = F.to_date("order_timestamp")
    order_revenue = F.col("exact_revenue").cast(MONEY)
    first, last = F.min(order_date), F.max(order_date)
    orders = F.count(F.lit(1))
    per_customer = invoice_rows.groupBy("customer_id").agg(
        first.alias("first_purchase_date"),
        last.alias("last_purchase_date"),
        orders.alias("frequency"),
        F.sum(order_revenue).cast(MONEY).alias("monetary"),
        mean(F.sum(order_revenue), orders, 2, MONEY).alias("average_order_value"),
        F.sum("items_purchased").alias("total_items"),
        mean(F.datediff(last, first), orders - 1, 2, "decimal(10,2)").alias(
            "avg_days_between_orders"
        ),
    )
    # Counted per country first: F.mode would sort all invoices once the hash map is full.
    most_orders_first = F.struct((-F.col("orders")).alias("order"), "country")
    home = (
        invoice_rows.groupBy("customer_id", "country").agg(orders.alias("orders"))
        .groupBy("customer_id").agg(F.min(most_orders_first)["country"].alias("primary_country"))
    )
    # One distinct count per aggregate: two in one would copy every line once per count.
    products = transactions.groupBy("customer_id").agg(F.count_distinct("stock_code").alias("unique_products"))
    months = transactions.groupBy("customer_id").agg(
        F.count_distinct(F.trunc("invoice_date", "month")).alias("active_months")
    )
    analysis_date = transactions.agg(F.max("invoice_date").cast("date").alias("day")).scalar()
    return per_customer.join(home, "customer_id").join(products, "customer_id").join(months, "customer_id").select(
        "*",
        F.datediff(analysis_date, "last_purchase_date").alias("recency_days"),
        F.datediff("last_purchase_date", "first_purchase_date").alias("tenure_days"),
    )


def scored(measures: DataFrame) -> DataFrame:
    """Add quartile scores and labels; ties are broken by customer id."""
    stored = materialize(measures, "measures")
    shared_type = MONEY
    tiles = tile_scores(
        stored,
        {
            "recency_score": -F.col("recency_days").cast(shared_type),
            "frequency_score": F.col("frequency").cast(shared_type),
            "monetary_score": F.col("monetary").cast(shared_type),
        },
        tie_break="customer_id",
    )
    r, f, m = (F.col(name) for name in SCORES)
    return stored.withColumns({name: tiles[name] for name in SCORES}).withColumns(
        {
            "rfm_score": r + f + m,
            "rfm_segment": rfm_segment(r, f, m),
            "rule_based_churn_status": churn_status(F.col("recency_days")),
        }
    )


def customer_features(transactions: DataFrame, invoice_rows: DataFrame | None = None) -> DataFrame:
    if invoice_rows is None:
        invoice_rows = invoice_totals(transactions)
    return scored(lifetime_measures(transactions, invoice_rows))
