"""Cut lineage by writing an intermediate table to the shared folder.

A Parquet table is used instead of ``DataFrame.checkpoint()`` because later
passes usually need a few of the columns: Parquet prunes them and answers
``count()`` from its footers, while a checkpoint reads whole rows back.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tillgrain.session import shared_folder
from tillgrain.sources.paths import delete

_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def intermediates(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_folder(spark)}/tillgrain/{spark.sparkContext.applicationId}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once no result needs them."""
    delete(spark, intermediates(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it as read back."""
    spark = df.sparkSession
    path = f"{intermediates(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    if (written := _written.get()) is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recording_intermediates() -> Iterator[list[str]]:
    """Collect the paths of the intermediate tables written inside the block."""
    outer, paths = _written.get(), []
    token = _written.set(paths)
    try:
        yield paths
    finally:
        _written.reset(token)
        if outer is not None:
            outer.extend(paths)


@contextmanager
def dropping_intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside the block when it ends."""
    with recording_intermediates() as paths:
        try:
            yield
        finally:
            for path in paths:
                delete(spark, path)
