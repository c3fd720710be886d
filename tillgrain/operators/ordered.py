"""Whole-table order without a one-task window.

``spread_in_order`` range-partitions the rows on the sort keys, so every task
holds one contiguous slice of the global order, and tags each row with its
slice and its position there. The tags come from ``monotonically_increasing_id``
and need no further shuffle. The tagged rows are written once: a second sampling
of the range bounds could move rows between slices and break the numbers.

Ranks, tiles, exact quantiles and running totals then need only one summary row
per slice. There are at most as many slices as shuffle partitions, so these
summaries are small however large the table is.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillgrain.operators.materialize import materialize, recording_intermediates

SLICE = "_slice"
POSITION = "_position"
# monotonically_increasing_id keeps the partition above bit 33 and the row below it.
_POSITION_BITS = 33
#: Files that a plan lists one by one; rows in more of them are sorted again.
MOST_FILES = 256


def slice_number(tag: Column) -> Column:
    """The partition in a tag of ``monotonically_increasing_id``."""
    return F.shiftright(tag, _POSITION_BITS)


def spread_in_order(df: DataFrame, keys: Sequence[Column | str], label: str = "ordered") -> DataFrame:
    """Rows of ``df`` in stored global order, with ``_slice`` and ``_position`` (from 0)."""
    stored = materialize(
        df.orderBy(*keys).withColumn("_tag", F.monotonically_increasing_id()), label
    )
    position_mask = (1 << _POSITION_BITS) - 1
    return (
        stored.withColumn(SLICE, slice_number(F.col("_tag")))
        .withColumn(POSITION, F.col("_tag").bitwiseAND(F.lit(position_mask)))
        .drop("_tag")
    )


def slice_offsets(ordered: DataFrame, **totals: Column) -> DataFrame:
    """Per slice, ``rows_before`` and for each named total ``<name>_before``.

    The window has one row per slice, never one per data row.
    """
    summary = ordered.groupBy(SLICE).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(n) for n, c in totals.items()]
    )
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(
        SLICE,
        *[
            F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before")
            for n in ("rows", *totals)
        ],
    )


def number_rows(df: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """Dense row numbers from 1 in the order of ``keys``, as a long column ``name``."""
    ordered = spread_in_order(df, keys, "numbered")
    return (
        ordered.join(F.broadcast(slice_offsets(ordered)), SLICE)
        .withColumn(name, (F.col("rows_before") + F.col(POSITION) + 1).cast("long"))
        .drop(SLICE, POSITION, "rows_before")
    )


def number_rows_in_order(df: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """``number_rows`` with the partitions in the order of the numbers, and the rows in them too.

    The stored slices are read file by file, each after the one before it, so rows are not sorted again.
    """
    spark = df.sparkSession
    with recording_intermediates() as paths:
        ordered = spread_in_order(df, keys, "numbered")
    in_file = F.substring_index(F.input_file_name(), "/", -1)
    held = ordered.select(in_file.alias("file"), SLICE, POSITION).groupBy("file", SLICE)
    rows = held.agg(F.min(POSITION).alias("first"), F.count(F.lit(1)).alias("n")).collect()  # a row per file
    files = sorted(rows, key=lambda r: (r[SLICE], r["first"]))
    if not 0 < len(files) <= MOST_FILES:
        numbered = ordered.join(F.broadcast(slice_offsets(ordered)), SLICE)
        number = (F.col("rows_before") + F.col(POSITION) + 1).cast("long")
        return numbered.withColumn(name, number).select(*df.columns, name).orderBy(name)
    parts, schema = [], StructType([*df.schema.fields, StructField("_tag", LongType())])
    for r, before in zip(files, accumulate((r["n"] for r in files), initial=0)):
        position = F.col("_tag").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
        number = (position + F.lit(before - r["first"] + 1)).cast("long")
        parts.append(spark.read.schema(schema).parquet(f"{paths[-1]}/{r['file']}").select(*df.columns, number.alias(name)))
    return reduce(DataFrame.union, parts)


def rows_at(ordered: DataFrame, positions: Iterable[int], sizes: Mapping[int, int]) -> dict[int, Row]:
    """The rows at the given global positions (from 0); asks for a handful, returns a handful."""
    slices = sorted(sizes)
    starts = dict(zip(slices, accumulate((sizes[s] for s in slices), initial=0)))
    wanted = {}
    for position in positions:
        home = next(s for s in slices if starts[s] <= position < starts[s] + sizes[s])
        wanted[(home, position - starts[home])] = position
    if not wanted:
        return {}
    match = F.lit(False)
    for home, offset in wanted:
        match = match | ((F.col(SLICE) == home) & (F.col(POSITION) == offset))
    found = ordered.filter(match).collect()
    return {wanted[(row[SLICE], row[POSITION])]: row for row in found}


def slice_sizes(ordered: DataFrame) -> dict[int, int]:
    """Row count per slice: one small row per shuffle partition."""
    return {row[SLICE]: row["count"] for row in ordered.groupBy(SLICE).count().collect()}


def _stacked(df: DataFrame, measures: Mapping[str, Column], extra: Sequence[str] = ()) -> DataFrame:
    """One row per (row, measure), so several measures share one sort."""
    pairs = [F.struct(F.lit(n).alias("measure"), c.alias("value")) for n, c in measures.items()]
    return df.select(*extra, F.explode(F.array(*pairs)).alias("pair")).select(
        "pair.measure", "pair.value", *extra
    )


def tile_scores(
    df: DataFrame, measures: Mapping[str, Column], tie_break: str, tiles: int = 4
) -> dict[str, Column]:
    """NTILE over the whole table for several measures at once, each ascending.

    All measures must share one type and hold no NULL. One sort finds the row that
    opens each tile; the score is then a comparison with those few literal rows, so
    no rank has to be joined back to ``df``.
    """
    ordered = spread_in_order(
        _stacked(df, measures, [tie_break]), ["measure", "value", tie_break], "tiles"
    )
    sizes = slice_sizes(ordered)
    rows = sum(sizes.values()) // len(measures)
    openings = []
    for tile in range(1, tiles):
        start = tile * (rows // tiles) + min(tile, rows % tiles)
        if start < rows:
            openings.append(start)
    names = sorted(measures)
    wanted = [i * rows + start for i in range(len(names)) for start in openings]
    found = rows_at(ordered, wanted, sizes)
    scores = {}
    for i, name in enumerate(names):
        score = F.lit(1)
        for start in openings:
            first = found[i * rows + start]
            value = F.lit(first["value"]).cast(ordered.schema["value"].dataType)
            at_or_after = (measures[name] > value) | (
                (measures[name] == value) & (F.col(tie_break) >= F.lit(first[tie_break]))
            )
            score = score + at_or_after.cast("int")
        scores[name] = score
    return {name: scores[name] for name in measures}


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Interpolated medians of numeric columns, NULLs left out.

    ``F.median`` gathers every distinct value of the column in one task. Here equal values
    are counted first, so a value that most rows share is one row; the distinct values are
    sorted across tasks and only the middle ones are read.
    """
    measures = {c: F.col(c).cast("double") for c in columns}
    counts = (
        _stacked(df, measures).filter(F.col("value").isNotNull())
        .groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    ordered = spread_in_order(counts, ["measure", "value"], "medians")
    held: dict[str, list[tuple[int, int]]] = {c: [] for c in columns}
    for r in ordered.groupBy("measure", SLICE).agg(F.sum("n").alias("n")).orderBy(SLICE).collect():
        held[r["measure"]].append((r[SLICE], r["n"]))
    wanted = {}  # measure -> (slice, rows of the measure before the wanted one) for both middles
    for name, slices in held.items():
        total = sum(n for _, n in slices)
        for middle in {(total - 1) // 2, total // 2} if total else ():
            before = 0
            for home, n in slices:
                if middle < before + n:
                    wanted.setdefault(name, []).append((home, middle - before))
                    break
                before += n
    match = F.lit(False)
    for name, places in wanted.items():
        for home, _ in places:
            match = match | ((F.col("measure") == name) & (F.col(SLICE) == home))
    # Distinct values of the slices that hold a middle, with the rows up to each of them.
    running = Window.partitionBy("measure", SLICE).orderBy(POSITION)
    upto = ordered.filter(match).withColumn("upto", F.sum("n").over(running))
    hit = F.lit(False)
    for name, places in wanted.items():
        for home, offset in places:
            covers = (F.col("upto") > offset) & (F.col("upto") - F.col("n") <= offset)
            hit = hit | ((F.col("measure") == name) & (F.col(SLICE) == home) & covers)
    values: dict[str, list[float]] = {}
    for r in upto.filter(hit).select("measure", "value").collect():  # one or two per measure
        values.setdefault(r["measure"], []).append(r["value"])
    return {name: sum(v) / len(v) for name, v in values.items()}
