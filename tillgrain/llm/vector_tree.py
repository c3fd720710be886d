"""Approximate nearest neighbours by inner product in a hierarchical k-means tree.

The tree is fitted on a bounded sample (``SAMPLE_ROWS``); every vector is then sent down to its
leaf. A query walks the tree best bin first: a priority queue holds the branches met so far by the
inner product of the query with their centres, and the best is opened next, until enough leaves
are visited. How many are enough is calibrated: for ``CALIBRATION_QUERIES`` queries the exact
neighbours are found by a scan of all vectors in blocks, and visits are widened until the mean
recall reaches ``TARGET_RECALL`` (all leaves, if need be).

Equal vectors are one vector of the index with its ``neighbours + 1`` smallest ids, which is all
that a result can name; equal queries are searched once. Leaves meet their queries in blocks of at
most about ``BLOCK_ROWS`` on either side, so no task receives a whole hot leaf. Each block returns
its best rows only.

Defined cases: vectors that are NULL, empty, zero, hold NULL or non-finite components, or have
another length than most take no part, neither as queries nor as candidates; NULL ids take no
part; repeated rows of one id and vector are one row; equal scores go to the smaller id; fewer
candidates than asked for are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.llm.rows import batch_of, find_package, stored

SAMPLE_ROWS = 20_000
BRANCHES = 8
LEAF_SAMPLE_ROWS = 512
ITERATIONS = 8
CALIBRATION_QUERIES = 100
TARGET_RECALL = 0.95
BLOCK_ROWS = 8192
#: Leaves whose rows set the score that those of later leaves must reach.
FIRST_LEAVES = 4
RESULT = "query_id bigint, rank int, vec_id bigint, score double"


@dataclass
class Tree:
    """Inner nodes hold centres and children; a child below zero is the leaf ``-child - 1``."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    @staticmethod
    def fit(sample: np.ndarray, seed: int = 11) -> Tree:
        tree, rng = Tree(), np.random.default_rng(seed)

        def grow(rows: np.ndarray) -> int:
            if len(rows) <= LEAF_SAMPLE_ROWS:
                tree.leaves += 1
                return -tree.leaves
            points = sample[rows]
            k = min(BRANCHES, len(rows))
            centres = points[rng.choice(len(rows), k, replace=False)]
            nearest = np.zeros(len(rows), dtype=int)
            for _ in range(ITERATIONS):
                nearest = (points @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
                for c in range(k):
                    if (nearest == c).any():
                        centres[c] = points[nearest == c].mean(axis=0)
            used = [c for c in range(k) if (nearest == c).any()]
            if len(used) < 2:  # points that cannot be told apart
                tree.leaves += 1
                return -tree.leaves
            at = len(tree.centres)
            tree.centres.append(centres[used])
            tree.children.append([])
            tree.children[at] = [grow(rows[nearest == c]) for c in used]
            return at

        grow(np.arange(len(sample)))
        return tree

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest centre at every level."""
        out = np.zeros(len(vectors), dtype=np.int64)
        if not self.centres:
            return out
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            centres = self.centres[node]
            near = (vectors[rows] @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
            for c, child in enumerate(self.children[node]):
                mine = rows[near == c]
                if len(mine):
                    if child < 0:
                        out[mine] = -child - 1
                    else:
                        waiting.append((child, mine))
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves best bin first."""
        if not self.centres:
            yield 0
            return
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if node < 0:
                yield -node - 1
                continue
            for child, gain in zip(self.children[node], (self.centres[node] @ query).tolist()):
                heapq.heappush(queue, (-gain, child))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _kept_type(table: DataFrame) -> tuple[pa.DataType, str]:
    """Arrow and Spark type of a vector: floats stay floats, all other numbers are doubles."""
    element = table.schema["embedding"].dataType.elementType.simpleString()
    return (pa.list_(pa.float32()), "array<float>") if element == "float" else (pa.list_(pa.float64()), "array<double>")


def usable(table: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    rows = table.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(_kept_type(table)[1]).alias("embedding")
    ).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    common = sizes.limit(1).collect()
    return rows.filter(F.size("embedding") == (common[0]["size"] if common else 0))


def _top(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The n best rows per key; tasks drop the rest before the shuffle."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def _scan(parts: Iterator[pa.RecordBatch], queries, n: int):
    ids, wanted = queries.value
    for part in parts:
        scores = _vectors(part.column("embedding")) @ wanted.T
        keys, leaves = part.column("vec_id").to_pylist(), part.column("leaf").to_pylist()
        best = np.argsort(-scores, axis=0, kind="stable")[:n]
        yield [
            (q, keys[i], float(scores[i, c]), leaves[i])
            for c, q in enumerate(ids) for i in best[:, c].tolist()
        ]


def calibrated_visits(index: DataFrame, tree: Tree, queries: DataFrame, neighbours: int) -> tuple[int, float]:
    """Leaves to visit, and the mean recall this reaches on the calibration queries."""
    rows = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION_QUERIES).collect()
    if not rows:
        return tree.leaves, 1.0
    wanted = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in rows}
    sent = index.sparkSession.sparkContext.broadcast((list(wanted), np.array(list(wanted.values()))))
    fields = [
        ("query", pa.int64(), "bigint"), ("vec_id", pa.int64(), "bigint"),
        ("score", pa.float64(), "double"), ("leaf", pa.int64(), "bigint"),
    ]
    exact = _top(_mapped(index.select("vec_id", "leaf", "embedding"), _scan, fields, sent, neighbours), ["query"], neighbours)
    found: dict[int, list[int]] = {}
    for r in exact.collect():  # at most neighbours rows per calibration query
        found.setdefault(r["query"], []).append(r["leaf"])
    reached = np.zeros(tree.leaves)
    for query, leaves in found.items():
        place = {leaf: i for i, leaf in enumerate(tree.visits(wanted[query]))}
        for leaf in leaves:
            reached[place[leaf] :] += 1 / len(leaves) / len(found)
    enough = int(np.argmax(reached >= TARGET_RECALL)) if (reached >= TARGET_RECALL).any() else tree.leaves - 1
    return enough + 1, float(reached[enough])


def _mapped(df: DataFrame, task, fields, *arguments) -> DataFrame:
    """Run ``task`` over Arrow's own batches of rows."""
    schema = pa.schema([(n, k) for n, k, _ in fields])
    find_package(df)

    def run(batches):
        for rows in task((b for b in batches if b.num_rows), *arguments):
            yield batch_of(rows, schema)

    return df.mapInArrow(run, ", ".join(f"`{n}` {kind}" for n, _, kind in fields))


def _leaves(parts: Iterator[pa.RecordBatch], tree):
    for part in parts:
        leaves = tree.value.leaf_of(_vectors(part.column("embedding"))).tolist()
        yield [tuple(r) for r in zip(part.column("vec_id").to_pylist(), leaves, part.column("ids").to_pylist(), part.column("embedding").to_pylist())]


def _visits(parts: Iterator[pa.RecordBatch], tree, count: int):
    for part in parts:
        rows = []
        for key, raw, query in zip(part.column("vec_id").to_pylist(), part.column("embedding").to_pylist(), _vectors(part.column("embedding"))):
            for i, leaf in enumerate(tree.value.visits(query)):
                if i == count:
                    break
                rows.append((key, leaf, i, raw))
            if len(rows) > 20_000:
                yield rows
                rows = []
        yield rows


def _block_best(n: int):
    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "vec_id": [], "score": []})
        vectors = np.array(right["embedding"].tolist(), dtype=np.float64)
        keys = right["vec_id"].to_numpy()
        order = np.argsort(keys, kind="stable")
        vectors, keys = vectors[order], keys[order]
        asked, hits, values = [], [], []
        for at in range(0, len(left), 256):
            some = left.iloc[at : at + 256]
            queries = some["query"].to_numpy()
            scores = np.array(some["embedding"].tolist(), dtype=np.float64) @ vectors.T
            good = scores >= some["least"].to_numpy()[:, None]
            for i in np.flatnonzero(good.sum(axis=1) > n):
                # Where equal scores straddle the cut, the smaller ids win.
                cut = np.partition(scores[i], len(keys) - n)[len(keys) - n]
                tied = np.flatnonzero(scores[i] >= cut)
                good[i] = False
                good[i, tied[np.argsort(-scores[i][tied], kind="stable")][:n]] = True
            rows, columns = np.nonzero(good)
            asked.append(queries[rows])
            hits.append(keys[columns])
            values.append(scores[rows, columns])
        return pd.DataFrame(
            {"query": np.concatenate(asked), "vec_id": np.concatenate(hits), "score": np.concatenate(values)}
        )

    return best


def _searched(visits: DataFrame, index: DataFrame, n: int) -> DataFrame:
    """The best rows of each visited leaf by block: query, vec_id, score.

    Leaves and their visits meet in blocks of about ``BLOCK_ROWS`` rows on either side; the
    tables of sizes have one row per leaf.
    """
    find_package(visits)

    def blocks(df: DataFrame, name: str) -> DataFrame:
        size = F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int")
        return df.groupBy("leaf").agg(size.alias(name))

    sizes = blocks(index, "rows").join(blocks(visits, "asks"), "leaf")
    left = (
        visits.join(sizes, "leaf")
        .withColumn("ask", F.pmod(F.xxhash64("query"), F.col("asks")))
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
        .select("leaf", "ask", F.col("row").cast("bigint").alias("row"), "query", "embedding", "least")
    )
    right = (
        index.join(sizes, "leaf")
        .withColumn("row", F.pmod(F.xxhash64("vec_id"), F.col("rows")))
        .withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
        .select("leaf", F.col("ask").cast("bigint").alias("ask"), "row", "vec_id", "embedding")
    )
    key = ["leaf", "ask", "row"]
    return (
        left.groupBy(*key).cogroup(right.groupBy(*key))
        .applyInPandas(_block_best(n), "query bigint, vec_id bigint, score double")
    )


def nearest(table: DataFrame, is_query, neighbours: int = 20) -> DataFrame:
    """Per query row: query_id, rank from 1, vec_id, score; ``is_query`` is a condition on vec_id."""
    spark = table.sparkSession
    n = neighbours + 1  # a query may meet itself
    rows = usable(table).dropDuplicates(["vec_id", "embedding"])
    same = Window.partitionBy("embedding").orderBy("vec_id")
    distinct = stored(
        rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= n)
        .groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("vec_id"), "ids", "embedding"),
        "distinct-vectors",
    )
    sample = distinct.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    if not sample:
        return spark.createDataFrame([], RESULT)
    tree = Tree.fit(np.array([r["embedding"] for r in sample], dtype=np.float64))
    del sample
    sent = spark.sparkContext.broadcast(tree)
    fields = [
        ("vec_id", pa.int64(), "bigint"), ("leaf", pa.int64(), "bigint"),
        ("ids", pa.list_(pa.int64()), "array<bigint>"), ("embedding", *_kept_type(table)),
    ]
    index = stored(_mapped(distinct.select("vec_id", "ids", "embedding"), _leaves, fields, sent), "vector-leaves")
    # Each query row with the vector of the index that equals it.
    asked = stored(
        rows.filter(is_query).withColumnRenamed("vec_id", "query_id")
        .join(index.select(F.col("vec_id").alias("query"), "embedding"), "embedding")
        .select("query_id", "query"),
        "queries",
    )
    wanted = asked.select(F.col("query").alias("vec_id")).distinct()
    queries = stored(wanted.join(index.select("vec_id", "embedding"), "vec_id"), "distinct-queries")
    count, _ = calibrated_visits(index, tree, queries, n)
    fields = [("query", pa.int64(), "bigint"), ("leaf", pa.int64(), "bigint"), ("place", pa.int64(), "bigint"), ("embedding", *_kept_type(table))]
    visits = stored(_mapped(queries.select("vec_id", "embedding"), _visits, fields, sent, count), "visits")

    # The first leaves give every query a score to beat; the others return only what reaches it.
    open_ = visits.filter(F.col("place") < FIRST_LEAVES).withColumn("least", F.lit(float("-inf")))
    first = stored(_top(_searched(open_, index, n), ["query"], n), "first-leaves")
    reached = F.when(F.count(F.lit(1)) >= n, F.min("score")).otherwise(F.lit(float("-inf")))
    rest = visits.filter(F.col("place") >= FIRST_LEAVES).join(
        first.groupBy("query").agg(reached.alias("least")), "query"
    )
    best = _top(first.unionByName(_searched(rest, index, n)), ["query"], n)
    named = best.join(index.select("vec_id", "ids"), "vec_id").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    lists = (
        _top(named, ["query"], n).groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("loss"), "vec_id"))).alias("best"))
    )
    own = F.filter("best", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        asked.join(lists, "query")
        .select("query_id", F.posexplode(F.slice(own, 1, neighbours)).alias("at", "hit"))
        .select(
            "query_id", (F.col("at") + 1).cast("int").alias("rank"),
            F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.loss")).alias("score"),
        )
    )
