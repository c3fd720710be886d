"""Skewed tables: one customer, product and country hold a third or more of all rows, many
revenues tie, and orders carry a time of day."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import compare
import __spark_entry__ as entry
from tillgrain.operators.materialize import recording_intermediates
from tillgrain.operators.ordered import exact_medians
from tillgrain.plans import orders
from tillgrain.sources import star_schema

SOURCE = "/root/testdata/sf0.001"
CHANGES = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey,"
    " o_orderdate + to_hours(CAST(o_orderkey * 7 % 24 AS INTEGER)) AS o_orderdate)",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_suppkey % 2 = 0 THEN 7 ELSE l_partkey END AS l_partkey,"
    " 2.0::DOUBLE AS l_quantity)",
    "part": "SELECT * REPLACE (12.5::DOUBLE AS p_retailprice)",
    "supplier": "SELECT * REPLACE (CASE WHEN s_suppkey % 3 < 2 THEN 3 ELSE s_nationkey END AS s_nationkey)",
}
NAMES = (
    "transactions clean_transactions quality_report order_history customer_features monthly_sales"
    " country_performance product_performance snapshot_dataset current_features pareto"
    " segment_contribution classifier_metrics feature_medians dashboard_integrity"
).split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in compare.TABLES:
        select = CHANGES.get(name, "SELECT *")
        con.execute(
            f"COPY ({select} FROM read_parquet('{SOURCE}/{name}.parquet'))"
            f" TO '{target}/{name}.parquet' (FORMAT parquet)"
        )
    return str(target)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_tables_give_the_same_rows(spark, folder, name):
    df = entry.queries()[name](spark, folder)
    twin = compare.connection(folder).sql(entry.oracle_sql()[name])
    assert compare.differences(df.collect(), df.dtypes, twin) == []


def test_a_split_customer_keeps_its_history(spark, folder):
    lines = star_schema.clean_lines(spark, folder)
    df = orders.order_history(lines)
    twin = compare.connection(folder).sql(entry.oracle_sql()["order_history"])
    assert compare.differences(df.collect(), df.dtypes, twin) == []


def test_medians_of_a_column_in_which_most_rows_tie(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 5 > 0, 7.0).otherwise(F.col("id")).alias("v"))
    exact = df.agg(F.median("v")).first()[0]
    with recording_intermediates() as written:
        assert exact_medians(df, ["v"]) == {"v": exact}
    rows = spark.read.parquet(written[0])
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert rows.count() <= 401 and max(sizes) < 0.5 * rows.count()
