"""Adapter that derives invoice lines from star-schema sales tables.

Joins carry no broadcast hints: Spark broadcasts a side when its measured size
allows it and otherwise sorts and merges, with adaptive splitting of skewed keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD_CHANGE = dt.datetime(1998, 7, 1)
REPEATED_UNTIL = dt.datetime(1998, 8, 1)
SNAPSHOTS = (
    dt.date(1999, 12, 1),
    dt.date(2000, 3, 1),
    dt.date(2000, 6, 1),
    dt.date(2000, 9, 1),
    dt.date(2000, 12, 1),
    dt.date(2001, 3, 1),
)
TABLES = ("lineitem", "orders", "part", "supplier", "nation")
COUNTRY_SPELLINGS = {"NATION_3": "Nation Three"}


def _moment(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def table_path(folder: str, name: str) -> str:
    return f"{folder}/{name}.parquet"


def _joined_lines(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(table_path(folder, name))

    return (
        table("lineitem")
        .join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )


def _period() -> Column:
    return F.when(F.col("o_orderdate") < _moment(PERIOD_CHANGE), "Period A").otherwise("Period B")


def _product_code() -> Column:
    return F.lpad(F.col("l_partkey").cast("string"), 5, "0")


def clean_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines in the shape of cleaned transactions, without a line key."""
    quantity = F.col("l_quantity").cast("int")
    price = F.col("p_retailprice").cast("decimal(12,3)")
    return _joined_lines(spark, folder).select(
        F.col("l_orderkey").cast("string").alias("invoice_no"),
        F.when(F.col("l_partkey") % 37 == 0, F.lit("POST"))
        .when(F.col("l_partkey") % 5 == 0, F.concat(_product_code(), F.lit("A")))
        .otherwise(_product_code())
        .alias("stock_code"),
        F.when(F.col("l_partkey") % 53 != 0, F.col("p_name")).alias("description"),
        quantity.alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        price.alias("unit_price"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("n_name").alias("country"),
        _period().alias("source_period"),
        (quantity * price).cast("decimal(14,3)").alias("revenue"),
    )


def dirty_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lines with cancellations, gaps, duplicates and a month repeated in two periods."""
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 4 == 0)
    base = _joined_lines(spark, folder).select(
        F.concat(
            F.when(returned, F.lit("c")).otherwise(F.lit("")),
            F.col("l_orderkey").cast("string"),
            F.lit(" "),
        ).alias("Invoice"),
        F.when(F.col("l_partkey") % 37 == 0, F.lit("POST"))
        .otherwise(_product_code())
        .alias("StockCode"),
        F.when(F.col("l_partkey") % 53 != 0, F.col("p_name")).alias("Description"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("Quantity"),
        F.when(F.col("l_linenumber") % 3 == 1, F.date_format("o_orderdate", "M/d/yyyy H:mm"))
        .when(F.col("l_linenumber") % 3 == 2, F.date_format("o_orderdate", "dd-MMM-yyyy H:mm"))
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("InvoiceDate"),
        F.when(F.col("l_partkey") % 97 == 0, F.lit(0.0))
        .when(F.col("l_partkey") % 89 == 0, F.lit(float("nan")))
        .otherwise(F.col("p_retailprice"))
        .alias("Price"),
        F.when(
            F.col("o_custkey") % 43 == 0, (F.col("o_custkey") + F.lit(2**53 + 1)).cast("string")
        )
        .when(
            F.col("o_custkey") % 41 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
        )
        .alias("Customer ID"),
        F.concat(F.lit(" "), F.col("n_name")).alias("Country"),
        _period().alias("source_period"),
        F.col("l_linenumber"),
        "o_orderdate",
    )
    repeated_month = (F.col("o_orderdate") >= _moment(PERIOD_CHANGE)) & (
        F.col("o_orderdate") < _moment(REPEATED_UNTIL)
    )
    # One pass instead of a union of three: each line lists the periods it appears under.
    copies = F.array_compact(
        F.array(
            F.col("source_period"),
            F.when(F.col("l_linenumber") == 1, F.col("source_period")),
            F.when(repeated_month, F.lit("Period A")),
        )
    )
    kept = [c for c in base.columns if c not in ("source_period", "l_linenumber", "o_orderdate")]
    return base.select(*kept, F.explode(copies).alias("source_period"))
