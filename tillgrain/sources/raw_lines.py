"""Raw invoice lines, one folder or file per period."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.plans.cleaning import check_columns


def load_periods(
    spark: SparkSession, periods: Mapping[str, str], file_format: str = "csv", **options: str
) -> DataFrame:
    """Union of all periods, each row tagged with its period in ``source_period``.

    CSV columns are named by the header and stay text: nothing is inferred, so
    values are parsed once, by the cleaning rules. All files of a period must have
    the same header, or the job that reads them fails. A column that a period lacks is
    NULL there.
    """
    if not periods:
        raise ValueError("No input periods given.")
    if file_format == "csv":
        options = {"header": True, "escape": '"', **options}

    def read(path: str) -> DataFrame:
        found = spark.read.options(**options).format(file_format).load(path)
        if file_format != "csv":
            return found
        # With the names of one file, and each file's header checked against them.
        checked = spark.read.options(**{**options, "enforceSchema": False}).schema(found.schema)
        return checked.csv(path)

    frames = [read(path).withColumn("source_period", F.lit(period)) for period, path in periods.items()]
    lines = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    check_columns(lines)
    return lines
