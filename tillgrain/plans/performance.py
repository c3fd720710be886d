"""Monthly, country and product performance.

Each is one aggregate. Its two distinct counts are rewritten by Spark into a
partial aggregate keyed by (group, invoice) and (group, customer), so even a group
with most of the rows is spread over all tasks before the final counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.functions.exact import MONEY, mean
from tillgrain.functions.text import is_merchandise, product_name
from tillgrain.operators.distinct import extended_dictionary, merged_reach, reach, reach_state
from tillgrain.operators.materialize import materialize


def month_of(moment: Column) -> Column:
    return F.trunc(moment, "month")


def _order_value() -> Column:
    return mean(F.sum("revenue"), F.count_distinct("invoice_no"), 2, MONEY)


def monthly_sales(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(month_of(F.col("invoice_date")).alias("month")).agg(
        F.count_distinct("invoice_no").alias("total_orders"),
        F.count_distinct("customer_id").alias("active_customers"),
        F.sum("quantity").alias("items_sold"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        _order_value().alias("average_order_value"),
    )


def country_performance(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("country").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("invoice_no").alias("orders"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        _order_value().alias("average_order_value"),
    )


def product_performance(transactions: DataFrame) -> DataFrame:
    """Merchandise only. The greatest description and the sums come from a branch of
    their own, reduced to one row per description first: a text maximum next to the
    distinct counts would make Spark sort all lines instead of hashing them."""
    merchandise = transactions.filter(is_merchandise(F.col("stock_code")))
    totals = (
        merchandise.groupBy("stock_code", "description")
        .agg(F.sum("quantity").alias("units"), F.sum("revenue").alias("revenue"))
        .groupBy("stock_code")
        .agg(
            product_name(F.max("description")).alias("description"),
            F.sum("units").alias("units_sold"),
            F.sum("revenue").cast(MONEY).alias("revenue"),
        )
    )
    reach = merchandise.groupBy("stock_code").agg(
        F.count_distinct("invoice_no").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
    )
    return totals.join(reach, "stock_code").select(
        "stock_code", "description", "units_sold", "orders", "customers", "revenue"
    )


def reach_by_period(
    transactions: DataFrame, group: Sequence[str], counted: Mapping[str, str], period: str = "source_period"
) -> DataFrame:
    """Distinct values per group, kept as bitmaps that one period after the other adds to.

    ``counted`` names a result column and the column it counts. Every period extends the
    dictionary of values and is merged into the stored state, as a new period would be later on.
    """
    periods = [r[0] for r in transactions.select(period).distinct().orderBy(period).collect()]
    found = None
    for name, column in counted.items():
        dictionary, state = None, None
        for one in periods:
            rows = transactions.filter(F.col(period) == one)
            dictionary = materialize(extended_dictionary(dictionary, rows, column), "dictionary")
            new = reach_state(rows, group, column, dictionary)
            state = materialize(new if state is None else merged_reach([state, new], group), "reach")
        counts = reach(state, group, name)
        found = counts if found is None else found.join(counts, list(group), "full")
    return found
