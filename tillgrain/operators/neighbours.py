"""Previous row within a group, whatever the size of the group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tillgrain.operators.materialize import materialize
from tillgrain.operators.ordered import SLICE, slice_number
from tillgrain.session import prepare_workers


def with_previous(
    df: DataFrame, group: Sequence[str], order: Sequence[str], source: str, target: str
) -> DataFrame:
    """Add ``target``: the value of ``source`` in the preceding row of the same group.

    ``order`` must be unique within a group; group columns that are both NULL are the same. Rows are
    spread over tasks in order of group and ``order``, so a group may run over several slices. The
    task that sorts a slice compares each row with the one before it and writes the slice once; each
    slice hands its last row on to the next. One row per slice is combined and broadcast, at most
    one per shuffle partition.
    """
    spread = df.orderBy(*group, *order).withColumn("_tag", F.monotonically_increasing_id())
    added = {target: df.schema[source].dataType, "_first": BooleanType(), "_last": BooleanType()}
    schema = StructType([*spread.schema.fields, *[StructField(n, t) for n, t in added.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compared(batches, group, source, target)

    ordered = materialize(prepare_workers(spread).mapInArrow(run, schema), "neighbours").withColumn(
        SLICE, slice_number(F.col("_tag"))
    )
    tails = ordered.filter("_last").select(SLICE, F.struct(*group, F.col(source).alias("_source")).alias("tail"))
    handed = materialize(
        tails.select(SLICE, F.lag("tail").over(Window.orderBy(SLICE)).alias("handed")), "handed"
    )
    same_group = F.col("_first") & F.col("handed").isNotNull()
    for column in group:
        same_group = same_group & F.col(column).eqNullSafe(F.col(f"handed.{column}"))
    return (
        ordered.join(F.broadcast(handed), SLICE)
        .withColumn(target, F.when(same_group, F.col("handed._source")).otherwise(F.col(target)))
        .select(*df.columns, target)
    )


def _compared(
    batches: Iterator[pa.RecordBatch], group: Sequence[str], source: str, target: str
) -> Iterator[pa.RecordBatch]:
    """Batches of one slice with ``target`` taken inside the slice, and marks on its first and last row."""
    before = held = None  # the row before a batch; the last batch so far, which may be the slice's last
    for batch in batches:
        if not batch.num_rows:
            continue
        first = np.zeros(batch.num_rows, dtype=bool)
        first[0] = before is None
        same = pa.array(~first)
        for name in group:
            left, right = _shifted(batch, before, name), batch.column(name)
            both_null = pc.and_(pc.is_null(left), pc.is_null(right))
            same = pc.and_(same, pc.or_(pc.fill_null(pc.equal(left, right), False), both_null))
        earlier = _shifted(batch, before, source)
        if held is not None:
            yield _marked(*held, None, target)
        before = batch.slice(batch.num_rows - 1)
        held = batch, pc.if_else(same, earlier, pa.nulls(len(earlier), earlier.type)), pa.array(first)
    if held is not None:
        yield _marked(*held, held[0].num_rows - 1, target)


def _shifted(batch: pa.RecordBatch, before: pa.RecordBatch | None, name: str) -> pa.Array:
    """The column one row later, opened by the row ``before`` the batch."""
    column = batch.column(name)
    opening = pa.nulls(1, column.type) if before is None else before.column(name)
    return pa.concat_arrays([opening, column.slice(0, len(column) - 1)])


def _marked(
    batch: pa.RecordBatch, previous: pa.Array, first: pa.Array, last_row: int | None, target: str
) -> pa.RecordBatch:
    last = np.zeros(batch.num_rows, dtype=bool)
    if last_row is not None:
        last[last_row] = True
    columns = [*batch.columns, previous, first, pa.array(last)]
    return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, target, "_first", "_last"])
