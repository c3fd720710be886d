"""Exact distinct counts without multiplying rows, and counts whose state can grow.

Several distinct counts in one aggregate make Spark copy every row once per count. Here rows are
reduced to their distinct combinations first, which also carry the sums; the counts are then taken
from this smaller table, one narrow aggregate each.

``Reach`` is a count kept as bitmaps: values get dense numbers from a dictionary that only grows,
and a group's values are the set bits of one bitmap per bucket of numbers. Bitmaps of another
period are merged by OR, so a stored state takes in new rows without the old ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.operators.materialize import materialize
from tillgrain.operators.ordered import number_rows


def totals_with_distinct(
    df: DataFrame,
    counted: Mapping[str, Column],
    sums: Mapping[str, Column] | None = None,
    least: Mapping[str, Column] | None = None,
    greatest: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row: the sums, least and greatest values, and per ``counted`` column its distinct values.

    NULLs are not counted. The combinations of the counted columns are stored once.
    """
    sums, least, greatest = sums or {}, least or {}, greatest or {}
    grain = materialize(
        df.groupBy(*[c.alias(name) for name, c in counted.items()]).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(c).alias(n) for n, c in sums.items()],
            *[F.min(c).alias(n) for n, c in least.items()],
            *[F.max(c).alias(n) for n, c in greatest.items()],
        ),
        "combinations",
    )
    found = grain.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("_rows"),
        *[F.sum(n).alias(n) for n in sums],
        *[F.min(n).alias(n) for n in least],
        *[F.max(n).alias(n) for n in greatest],
    )
    distinct = {
        name: grain.select(name).dropna().groupBy(name).agg(F.lit(1)).agg(F.count(F.lit(1))).scalar() for name in counted
    }
    return found.withColumns(distinct)


# --- Counts that grow ---------------------------------------------------------------------------

DICTIONARY = "value string, number bigint"


def extended_dictionary(known: DataFrame | None, df: DataFrame, column: str) -> DataFrame:
    """``known`` (value, number) and the new values of ``column``, numbered on from its greatest number.

    Numbers start at 1, as bitmap buckets do, and have no gaps; a value keeps its number for good.
    """
    values = df.select(F.col(column).cast("string").alias("value")).dropna().distinct()
    if known is None:
        return number_rows(values, ["value"], "number").select("value", "number")
    new = values.join(known.select("value"), "value", "left_anti")
    numbered = number_rows(new, ["value"], "number")
    above = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("top")).first()["top"]
    return known.select("value", "number").unionByName(
        numbered.select("value", (F.col("number") + F.lit(above)).cast("bigint").alias("number"))
    )


def reach_state(df: DataFrame, group: Sequence[str], column: str, dictionary: DataFrame) -> DataFrame:
    """Bitmaps of the values of ``column`` per group: group, bucket, bits.

    Group and value are made distinct before the dictionary is joined, so a hot group or value
    moves few rows.
    """
    pairs = df.select(*group, F.col(column).cast("string").alias("value")).dropna(subset=["value"]).distinct()
    number = F.col("number")
    return (
        pairs.join(dictionary, "value")
        .groupBy(*group, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def merged_reach(states: Sequence[DataFrame], group: Sequence[str]) -> DataFrame:
    """One state of several that share a dictionary."""
    whole = states[0]
    for state in states[1:]:
        whole = whole.unionByName(state)
    return whole.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def reach(state: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Distinct values per group of a state."""
    return state.groupBy(*group).agg(F.sum(F.bitmap_count("bits")).alias(name))


def rolled_up(state: DataFrame, group: Sequence[str]) -> DataFrame:
    """The state of coarser groups: the OR of the finer ones."""
    return state.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
