"""Layouts of published tables: lines in folders by month, customers in sorted buckets.

A window of months then names the folders it reads, and tables in the same buckets of one key are
joined without an exchange. The buckets are noted beside the files, so any session can use them.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.sources.paths import create_text, delete, read_text

#: Folder column of lines: the first day of their month.
MONTH = "invoice_month"
_NOTE = "_layout"


def with_month(lines: DataFrame, moment: str = "invoice_date") -> DataFrame:
    return lines.withColumn(MONTH, F.trunc(moment, "month"))


def within_months(lines: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Leave out the folders of months before ``first`` or after ``last``, where there are any."""
    if MONTH not in lines.columns:
        return lines
    return lines.filter(F.col(MONTH).between(F.lit(first.replace(day=1)), F.lit(last)))


def _catalog_name(path: str) -> str:
    return f"tillgrain_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Rebuild the Parquet table at ``path`` in buckets of ``key``, sorted inside, and read it back."""
    spark = df.sparkSession
    name = f"{_catalog_name(path)}_new"
    delete(spark, path)
    # One task per bucket, so a bucket is one sorted file.
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay
    columns = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    create_text(spark, f"{path}/{_NOTE}", json.dumps({"key": key, "buckets": buckets, "columns": columns}))
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table with its buckets, by a table of the session's catalog over the same files."""
    noted = json.loads(read_text(spark, f"{path}/{_NOTE}"))
    columns = ", ".join(f"`{column}` {kind}" for column, kind in noted["columns"])
    name, key = _catalog_name(path), noted["key"]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {noted['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return read_text(spark, f"{path}/{_NOTE}") is not None
