"""Inputs of tree models as one byte each, and numbers that every task draws alike."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.session import prepare_workers

#: Bins of an input; the last code stands for a missing value.
BINS, MISSING = 255, 255
#: Rows of a node that one task grows on its own, in about 0.2 GB. Larger nodes are split by histograms
#: of all tasks, at a pass over all rows for every level of them.
LOCAL_ROWS = 1_000_000


def bin_edges(rows: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper edges of the bins of every input: distinct quantiles, without the greatest value.

    Values up to the first edge have code 0, and so on; missing values are left out.
    """
    shares = [i / bins for i in range(1, bins)]
    known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in inputs}
    found = rows.agg(
        *[F.percentile_approx(v, shares, 50 * bins).alias(c) for c, v in known.items()],
        *[F.max(v).alias(f"max_{c}") for c, v in known.items()],
    ).first()
    return [sorted({v for v in found[c] or [] if v < found[f"max_{c}"]}) for c in inputs]


def codes_of(values: np.ndarray, edges: Sequence[float]) -> np.ndarray:
    codes = np.searchsorted(np.asarray(edges), values, side="left").astype(np.uint8)
    codes[np.isnan(values)] = MISSING
    return codes


def coded(
    rows: DataFrame, inputs: Sequence[str], edges: list[list[float]], packed: bool = False, **kept: Column
) -> DataFrame:
    """``kept`` columns (bigint or double) and ``codes``, a byte per input; NULL inputs are missing.

    ``packed`` gives a row per Arrow batch that holds every column's values as bytes, for tables
    that Python reads many times; ``unpacked`` reads them. Kept columns must not be NULL then.
    """
    kinds = {"bigint": pa.int64(), "double": pa.float64()}
    picked = rows.select(*[c.alias(n) for n, c in kept.items()], *[F.col(c).cast("double").alias(f"_in_{i}") for i, c in enumerate(inputs)])
    fields = [(f.name, f.dataType.simpleString()) for f in picked.schema.fields[: len(kept)]]
    schema = pa.schema([*[(n, pa.binary() if packed else kinds[k]) for n, k in fields], ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f"_in_{i}").to_numpy(zero_copy_only=False) for i in range(len(inputs))]
            found = np.column_stack([codes_of(np.asarray(v, dtype=np.float64), e) for v, e in zip(columns, edges)])
            if packed:
                if batch.num_rows:
                    blobs = [*[batch.column(n).to_numpy().tobytes() for n, _ in fields], found.tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([b], type=pa.binary()) for b in blobs], schema=schema)
                continue
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n, _ in fields], pa.array([row.tobytes() for row in found], type=pa.binary())],
                schema=schema,
            )

    return prepare_workers(picked).mapInArrow(
        run, ", ".join([*[f"{n} {'binary' if packed else k}" for n, k in fields], "codes binary"])
    )


def unpacked(batches: Iterator[pa.RecordBatch], **kinds: type) -> Iterator[list[np.ndarray]]:
    """The named columns of every packed row as arrays of the given kinds."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield [np.frombuffer(batch.column(n)[i].as_py(), dtype=k) for n, k in kinds.items()]


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: near numbers become unrelated ones."""
    x = np.asarray(numbers, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(keys: np.ndarray, *salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit keys and ``salt``."""
    x = np.asarray(keys).view(np.uint64)
    for s in salt:
        with np.errstate(over="ignore"):
            x = mixed(x + np.uint64(0x9E3779B97F4A7C15) * np.uint64(s + 1))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def key_of(*columns: str) -> Column:
    """A 64-bit key of a row from its own unique columns."""
    return F.xxhash64(*columns)
