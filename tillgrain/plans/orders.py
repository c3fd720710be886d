"""Invoices and each customer's order history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.functions.exact import MONEY
from tillgrain.operators.materialize import materialize
from tillgrain.operators.neighbours import with_previous


def invoice_totals(transactions: DataFrame) -> DataFrame:
    """One row per customer and invoice, dated by its earliest line.

    ``country`` is the most frequent one among the lines, the alphabetically first on
    ties. Lines hardly shrink when they are summed per country in the tasks that read them, so they
    are brought together by invoice as they are, once: the sums per country and the choice
    of the country both happen where the invoice's lines lie.
    """
    together = transactions.select(
        "customer_id", "invoice_no", "country", "invoice_date", "revenue", "quantity"
    ).repartition("customer_id", "invoice_no")
    per_country = together.groupBy("customer_id", "invoice_no", "country").agg(
        F.min("invoice_date").alias("first_line"),
        F.sum("revenue").alias("revenue"),
        F.sum("quantity").alias("items"),
        F.count(F.lit(1)).alias("lines"),
    )
    most_lines_first = F.struct((-F.col("lines")).alias("order"), "country")
    return per_country.groupBy("customer_id", "invoice_no").agg(
        F.min("first_line").alias("order_timestamp"),
        F.sum("revenue").cast("decimal(24,3)").alias("exact_revenue"),
        F.sum("items").alias("items_purchased"),
        F.min(most_lines_first)["country"].alias("country"),
    )


def invoices(transactions: DataFrame) -> DataFrame:
    """Invoice totals with the number of distinct products.

    The distinct count is a branch of its own: counted together with the text-valued
    country, it would have to sort all lines instead of hashing them. Both branches end
    partitioned by customer and invoice, so the join moves no rows.
    """
    products = transactions.groupBy("customer_id", "invoice_no").agg(
        F.count_distinct("stock_code").alias("unique_products")
    )
    return invoice_totals(transactions).join(products, ["customer_id", "invoice_no"])


def sequenced(invoice_rows: DataFrame) -> DataFrame:
    """Invoices with ``previous_timestamp``, the customer's preceding order.

    They are stored first: finding the bounds of the order would add up all lines a second time.
    """
    return with_previous(
        materialize(invoice_rows, "invoices"),
        ["customer_id"],
        ["order_timestamp", "invoice_no"],
        "order_timestamp",
        "previous_timestamp",
    )


def order_history(transactions: DataFrame) -> DataFrame:
    return history_rows(sequenced(invoices(transactions)))


def order_dates(sequenced_invoices: DataFrame) -> DataFrame:
    """What the gap report needs of the order history: dates, gaps and revenue."""
    order_date, previous = F.to_date("order_timestamp"), F.to_date("previous_timestamp")
    return sequenced_invoices.select(
        "customer_id",
        "invoice_no",
        order_date.alias("order_date"),
        F.col("exact_revenue").cast(MONEY).alias("order_revenue"),
        previous.alias("previous_order_date"),
        F.datediff(order_date, previous).alias("days_since_previous_order"),
    )


def history_rows(sequenced_invoices: DataFrame) -> DataFrame:
    """The published order history; gaps are calendar days."""
    order_date = F.to_date("order_timestamp")
    previous = F.to_date("previous_timestamp")
    return sequenced_invoices.select(
        "customer_id",
        "invoice_no",
        "order_timestamp",
        order_date.alias("order_date"),
        F.col("exact_revenue").cast(MONEY).alias("order_revenue"),
        "items_purchased",
        "unique_products",
        "country",
        previous.alias("previous_order_date"),
        F.datediff(order_date, previous).alias("days_since_previous_order"),
    )
