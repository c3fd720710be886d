"""Helpers shared by the operators: whole texts as bytes, bounded slices, typed output batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyarrow import compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.operators.materialize import materialize, recording_intermediates
from tillgrain.sources.paths import delete

_ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of an Arrow batch from Spark to a Python worker.
BATCH_BYTES = 8 << 20
#: Bytes of text that a task holds decoded at once; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text, NULL as empty; also of strings that hold broken UTF-8."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def text_of(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with at most ``limit`` bytes in ``column``."""
    for batch in batches:
        lengths = compute.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and held + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def find_package(df: DataFrame) -> None:
    """Let Python workers on this machine import the package from where it lies, and bound the
    batches they receive and hold by ``BATCH_BYTES``, a setting of the session.

    On a cluster the package is installed or shipped with ``--py-files``.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def map_texts(
    df: DataFrame,
    column: str,
    task: Callable[..., Iterator[list[tuple]]],
    fields: list[tuple[str, pa.DataType, str]],
    *arguments: Any,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Run ``task(slices, *arguments)``, which yields lists of rows, over Arrow batches.

    ``fields`` names each output column with its Arrow and its Spark type.
    """
    schema = pa.schema([(name, kind) for name, kind, _ in fields])
    find_package(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in task(slices(batches, column, limit), *arguments):
            if rows:
                yield batch_of(rows, schema)

    return df.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, _, kind in fields))


def append_columns(
    df: DataFrame,
    body: Column,
    task: Callable[..., Iterator[list[tuple]]],
    fields: list[tuple[str, pa.DataType, str]],
    *arguments: Any,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """All columns of ``df`` and those ``task`` finds, one row for each row and in their order.

    ``task`` sees slices that hold the bytes ``body`` as column ``body`` and the columns of
    ``df`` as a struct ``row``, so their names cannot clash.
    """
    schema = pa.schema([(name, kind) for name, kind, _ in fields])
    find_package(df)
    packed = df.select(F.struct("*").alias("row"), body.alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def watched() -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "body", limit):
                waiting.append(part)
                yield part

        for rows in task(watched(), *arguments):
            part = waiting.pop(0)
            found = batch_of(rows, schema)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.StructArray.from_arrays(found.columns, names=schema.names)],
                names=["row", "found"],
            )

    kinds = ", ".join(f"`{name}`: {kind}" for name, _, kind in fields)
    row = packed.schema["row"].dataType.simpleString()
    mapped = packed.mapInArrow(run, f"row {row}, found struct<{kinds}>")
    return mapped.select("row.*", "found.*")


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """All of ``df`` as one struct ``_row`` beside the named columns: no name can clash."""
    return df.select(F.struct("*").alias("_row"), *[F.col(c) for c in columns])


def labelled_sample(
    texts: DataFrame, labels: DataFrame, rows: int, limit: int
) -> list[tuple[int, str, Any]]:
    """At most ``rows`` (id, text, label), chosen by the hash of the id, ordered by id.

    ``texts`` has columns id and body, ``labels`` id and label. Texts above ``limit`` bytes are
    left out, so what is collected is bounded by ``rows * limit`` bytes.
    """
    chosen = (
        labels.filter("id is not null and label is not null")
        .groupBy("id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
        .collect()
    )
    if not chosen:
        return []
    few = labels.sparkSession.createDataFrame(
        [tuple(r) for r in chosen], f"id bigint, label {labels.schema['label'].dataType.simpleString()}"
    )
    found = (
        texts.filter(F.length("body") <= limit)
        .join(F.broadcast(few), "id")  # at most ``rows`` rows
        .dropDuplicates(["id"])
        .select("id", "body", "label")
        .collect()
    )
    return sorted((r["id"], text_of(bytes(r["body"])), r["label"]) for r in found)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by a table in the shared folder of the session."""
    return materialize(df, f"llm-{label}")


class Passing:
    """Tables that only the next step reads: ``drop`` deletes those stored through it so far."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        with recording_intermediates() as written:
            found = stored(df, label)
        self.paths += written
        return found

    def drop(self) -> None:
        while self.paths:
            delete(self.spark, self.paths.pop())
        self.release()

    def release(self) -> None:
        """Spark drops the shuffle files of finished steps once the driver's garbage is collected."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
