"""k-means for many starts at once, and the silhouette of a sample.

All starts share their passes over the rows: the centres of every start are one array, and one
grouped sum per pass gives the size, the vector sum and the cost of every cluster of every start
that has not settled yet. A pass therefore costs the same jobs for one start as for a hundred,
and starts that have settled drop out of the next one. A task returns one row per cluster.

Starting centres are chosen by greedy k-means++ on a sample of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.session import prepare_workers

#: Rows in the sample of the starts and the silhouette.
SAMPLE_ROWS = 5_000
#: A start has settled once its centres move less than this share of the mean variance.
TOLERANCE = 1e-4
#: Distances that a task holds at once.
BLOCK_DISTANCES = 1 << 21


def sample_rows(points: DataFrame, order: Column, columns: Sequence[str], limit: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``limit`` rows by ``order``, which should be a hash of a unique key."""
    return points.select(*columns, order.alias("_order")).orderBy("_order").limit(limit).select(*columns)


def as_matrix(rows: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """A bounded table as doubles; callers state the bound."""
    return np.array([[float(v) for v in r] for r in rows.select(*columns).collect()]).reshape(-1, len(columns))


def spread_centres(sample: np.ndarray, k: int, seed: Sequence[int]) -> np.ndarray:
    """Greedy k-means++: each next centre is the best of a few rows drawn by squared distance."""
    draw = np.random.default_rng(seed)
    chosen = [sample[draw.integers(len(sample))]]
    nearest = np.square(sample - chosen[0]).sum(axis=1)
    for _ in range(1, k):
        total = nearest.sum()
        tried = draw.integers(len(sample), size=2 + int(np.log(k)))
        if total > 0:
            tried = np.minimum(np.searchsorted(np.cumsum(nearest), draw.random(tried.size) * total), len(sample) - 1)
        reached = [np.minimum(nearest, np.square(sample - sample[i]).sum(axis=1)) for i in tried]
        best = int(np.argmin([r.sum() for r in reached]))
        chosen.append(sample[tried[best]])
        nearest = reached[best]
    return np.array(chosen)


def _blocks(batches: Iterator[pa.RecordBatch], columns: int, width: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    rows = max(1, BLOCK_DISTANCES // max(width, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield np.column_stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]), part


def cluster_sums(points: DataFrame, columns: Sequence[str], starts: Sequence[np.ndarray]) -> DataFrame:
    """One pass: per start and cluster the rows nearest to its centre.

    Columns: start, cluster, n, cost (squared distances) and sum_0, sum_1, ... Clusters that no row
    is nearest to are left out; ties go to the first cluster. Values must not be NULL.
    """
    centres = np.concatenate(starts)
    ends = np.cumsum([len(s) for s in starts])
    names = [f"sum_{i}" for i in range(len(columns))]
    start_of = np.repeat(np.arange(len(starts)), [len(s) for s in starts]).astype(np.int32)
    cluster_of = np.concatenate([np.arange(len(s)) for s in starts]).astype(np.int32)
    schema = pa.schema(
        [("start", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), *[(x, pa.float64()) for x in ("cost", *names)]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centres), dtype=np.int64), np.zeros((len(centres), len(columns) + 1))
        norms = np.square(centres).sum(axis=1)
        for x, _ in _blocks(batches, len(columns), len(centres)):
            far = norms - 2 * x @ centres.T
            own = np.square(x).sum(axis=1)
            for start, end in zip(ends - [len(s) for s in starts], ends):
                label = far[:, start:end].argmin(axis=1)
                cost = np.maximum(own + far[np.arange(len(x)), start + label], 0)
                size = end - start
                counts[start:end] += np.bincount(label, minlength=size)
                for j, values in enumerate((cost, *x.T)):
                    sums[start:end, j] += np.bincount(label, weights=values, minlength=size)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[held]) for x in (start_of, cluster_of, counts, *sums.T)], schema=schema
        )

    ddl = ", ".join(["start int", "cluster int", "n bigint", *[f"{x} double" for x in ("cost", *names)]])
    found = prepare_workers(points.select(*[F.col(c).cast("double") for c in columns])).mapInArrow(run, ddl)
    return found.groupBy("start", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *names)])


def _moved(sums: list, starts: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Centres as the means of their rows; a centre without rows stays."""
    found = [s.copy() for s in starts]
    for r in sums:
        found[r["start"]][r["cluster"]] = [r[f"sum_{i}"] / r["n"] for i in range(starts[0].shape[1])]
    return found


def lloyd_steps(points: DataFrame, columns: Sequence[str], starts: Sequence[np.ndarray], steps: int) -> list[np.ndarray]:
    """Centres of every start after ``steps`` passes."""
    for _ in range(steps):
        starts = _moved(cluster_sums(points, columns, starts).collect(), starts)  # a row per cluster
    return list(starts)


def settled_centres(
    points: DataFrame, columns: Sequence[str], starts: Sequence[np.ndarray], tolerance: float, most_passes: int
) -> list[np.ndarray]:
    """Centres of every start once they move no more than ``tolerance`` (sum of squares) in a pass."""
    found, open_ = [s.copy() for s in starts], list(range(len(starts)))
    for _ in range(most_passes):
        if not open_:
            break
        moved = lloyd_steps(points, columns, [found[i] for i in open_], 1)
        shifts = [np.square(m - found[i]).sum() for m, i in zip(moved, open_)]
        for m, i in zip(moved, open_):
            found[i] = m
        open_ = [i for i, shift in zip(open_, shifts) if shift > tolerance]
    return found


def costs(points: DataFrame, columns: Sequence[str], starts: Sequence[np.ndarray]) -> list[float]:
    """Sum of squared distances to the nearest centre, per start."""
    rows = cluster_sums(points, columns, starts).groupBy("start").agg(F.sum("cost").alias("cost")).collect()
    found = {r["start"]: r["cost"] for r in rows}
    return [found.get(i, 0.0) for i in range(len(starts))]


def nearest_centre(columns: Sequence[str], centres: np.ndarray) -> Column:
    """Number of the nearest centre as an expression; ties go to the first."""
    far = F.array(
        *[
            sum((((F.col(c) - float(v)) * (F.col(c) - float(v))) for c, v in zip(columns, centre)), F.lit(0.0))
            for centre in centres
        ]
    )
    return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def silhouettes(sample: DataFrame, columns: Sequence[str], labellings: Sequence[str]) -> DataFrame:
    """Mean silhouette of ``sample`` by Euclidean distance per labelling: labelling, silhouette.

    ``sample`` is a table of bounded size that every task holds whole; tasks share its rows and take
    the sums of distances to every cluster block by block. Labels are integers; a cluster of one row
    scores 0, and a labelling with a single cluster has no silhouette (NULL).
    """
    held = sample.select(*[F.col(c).cast("double") for c in columns], *[F.col(c).cast("long") for c in labellings])
    rows = [tuple(r) for r in held.collect()]  # the bounded sample
    whole = np.array([r[: len(columns)] for r in rows], dtype=np.float64).reshape(-1, len(columns))
    labels = [np.unique([r[len(columns) + i] for r in rows], return_inverse=True)[1] for i in range(len(labellings))]
    sent = sample.sparkSession.sparkContext.broadcast((whole, labels))
    schema = pa.schema([("labelling", pa.string()), ("total", pa.float64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, numbers = sent.value
        square = np.square(points).sum(axis=1)
        totals, count = np.zeros(len(numbers)), 0
        for batch in batches:
            for at in np.array_split(batch.column(0).to_numpy(), max(1, batch.num_rows * len(points) // BLOCK_DISTANCES)):
                x = points[at]
                far = np.sqrt(np.maximum(square[at][:, None] - 2 * x @ points.T + square, 0))
                far[np.arange(len(at)), at] = 0
                count += len(at)
                for i, label in enumerate(numbers):
                    size = np.bincount(label)
                    sums = far @ (label[:, None] == np.arange(len(size)))
                    own, line = label[at], np.arange(len(at))
                    inside = sums[line, own] / np.maximum(size[own] - 1, 1)
                    means = sums / size
                    means[line, own] = np.inf
                    outside = means.min(axis=1)
                    widest = np.maximum(inside, outside)
                    with np.errstate(invalid="ignore"):
                        score = np.where((size[own] > 1) & (widest > 0), (outside - inside) / np.where(widest > 0, widest, 1), 0)
                    totals[i] += score.sum() if len(size) > 1 else np.nan
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(labellings)), pa.array(totals), pa.array([count] * len(numbers))], schema=schema
            )

    tasks = int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = sample.sparkSession.range(0, len(rows), 1, min(tasks, max(1, len(rows) // 100)))
    found = prepare_workers(places).mapInArrow(run, "labelling string, total double, n bigint").groupBy("labelling")
    mean = F.sum("total") / F.sum("n")
    return found.agg(F.when(~F.isnan(mean), mean).alias("silhouette"))
