"""Hard negatives by rotated one-bit codes with an exact interval for every score.

Vectors are rotated by two rounds of random signs and a Hadamard transform. A row keeps the signs
of its rotated components (one bit each), its length, and how well the code's direction agrees
with it (the alignment). An anchor's rotated components are cut into a few bit planes, so the
agreement of anchor and code is a sum of popcounts, but for an error known from the rounding.
Row and anchor each split into a part along the code and a rest; by Cauchy-Schwarz the rests'
product lies within the product of their lengths. That gives an interval that holds the score for
certain. Where the interval cannot reach the scores still wanted, the row is passed over; all
others are scored in integers. So the result is exact, whatever the codes are worth.

The anchors are a stated query set. They are searched in blocks of bounded bytes, each block
against all rows in one pass: a task keeps the best few per anchor, and a window over these
merges tasks. A sample of the rows goes first, and what it finds is a floor below which a task
passes nothing on, so the rows that tasks return do not grow with their number.

Defined cases: rows with a NULL id or label, a NULL or empty vector, or a NULL or non-finite
component take no part, nor those whose integer vector has a squared length of 2^62 or more,
whose scores a long cannot hold. A row of another number of components than the anchor's is not
compared with it. Rows that repeat an id are rows of their own, but none is compared with the
anchor of that id, and a repeated anchor counts once, with its least label and components. Ties
go to the smaller id. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.llm.rows import batch_of, find_package, stored

#: Scale of the integer components, as the contract of the query states it.
SCALE = 256
#: Bit planes of an anchor's rotated components.
PLANES = 6
#: Bytes of the anchors that one pass searches for, about: blocks are dealt by a hash.
BLOCK_BYTES = 4 << 20
#: Rows that a task compares with an anchor at once.
CHUNK_ROWS = 8192
#: One row in this many is searched first, for the floors.
SAMPLED = 32
#: Slack of the intervals for rounding, relative to the greatest possible score.
SLACK = 1e-6
#: Squared length from which a vector takes no part, and up to which doubles add integers exactly.
TOO_LONG, EXACT = 2.0**62, 2.0**52

CODED = pa.schema(
    [("id", pa.int64()), ("label", pa.int64()), ("dims", pa.int32()), ("components", pa.binary()),
     ("code", pa.binary()), ("length", pa.float64()), ("alignment", pa.float64())]
)
CODED_DDL = "id bigint, label bigint, dims int, components binary, code binary, length double, alignment double"
FOUND = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "anchor bigint, place int, id bigint, score bigint"


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows turned by a fixed random rotation, filled up with zeros to a power of two of 64 or more."""
    count, dims = vectors.shape
    size = max(64, 1 << (dims - 1).bit_length())
    turned = np.zeros((count, size))
    turned[:, :dims] = vectors
    for signs in np.random.default_rng(13).integers(0, 2, (2, size)) * 2.0 - 1.0:
        turned *= signs
        half = 1
        while half < size:
            pairs = turned.reshape(count, size // (2 * half), 2, half)
            turned = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, size)
            half *= 2
        turned /= np.sqrt(size)
    return turned


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("vector")
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
        for dims in np.unique(sizes[sizes > 0]).tolist():
            at = np.flatnonzero(sizes == dims)
            for few in np.array_split(at, max(1, at.size * dims // (1 << 20))):
                with np.errstate(over="ignore", invalid="ignore"):
                    whole = np.floor(SCALE * flat[starts[few][:, None] + np.arange(dims)])
                    squared = np.square(whole).sum(axis=1)
                fits = squared < TOO_LONG  # false for NaN and infinity
                few, whole, length = few[fits], whole[fits], np.sqrt(squared[fits])
                turned = rotated(whole)
                aligned = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1]) / np.where(length > 0, length, 1)
                codes = np.packbits(turned > 0, axis=1, bitorder="little")
                rows = [
                    (int(ids[i]), int(labels[i]), dims, w.tobytes(), c.tobytes(), n, min(a, 1.0))
                    for i, w, c, n, a in zip(few, whole.astype("<i4"), codes, length.tolist(), aligned.tolist())
                ]
                if rows:
                    yield batch_of(rows, CODED)


def coded(vectors: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """Rows that take part: id, label, dims, integer components, code, length, alignment."""
    find_package(vectors)
    picked = vectors.select(
        vec_id.cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        vector.cast("array<double>").alias("vector"),
    )
    return picked.filter("id is not null and label is not null and vector is not null").mapInArrow(_code, CODED_DDL)


@dataclass(frozen=True)
class Wanted:
    """An anchor and, for each list of partners wanted, its bounds of score and its floor."""

    id: int
    label: int
    components: np.ndarray
    bounds: list[tuple[int, int]]
    floors: list[int]


@dataclass
class _Prepared:
    """What an anchor's popcounts need: planes and sums of its rotated components."""

    wanted: Wanted
    length: float = field(init=False)
    planes: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        whole = self.wanted.components.astype(np.float64)
        turned = rotated(whole[None, :])[0]
        self.length, self.size = float(np.sqrt(np.square(whole).sum())), len(turned)
        self.low = turned.min()
        self.step = max((turned.max() - self.low) / ((1 << PLANES) - 1), 1e-300)
        steps = np.clip(np.rint((turned - self.low) / self.step), 0, (1 << PLANES) - 1).astype(np.int64)
        bits = (steps[None, :] >> np.arange(PLANES)[:, None] & 1).astype(bool)
        self.planes = np.packbits(bits, axis=1, bitorder="little").view("<u8")
        self.total = int(steps.sum())
        self.error = float(np.abs(turned - (self.low + self.step * steps)).sum()) / np.sqrt(self.size)

    def interval(self, codes: np.ndarray, ones: np.ndarray, lengths: np.ndarray, alignments: np.ndarray):
        """Least and greatest score that the rows can have with the anchor."""
        if self.length == 0:
            return np.zeros(len(codes)), np.zeros(len(codes))
        dot = np.zeros(len(codes), dtype=np.int64)
        for j, plane in enumerate(self.planes):
            dot += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << j
        along = self.low * (2.0 * ones - self.size) + self.step * (2.0 * dot - self.total)
        along /= np.sqrt(self.size) * self.length
        error = self.error / self.length + SLACK
        rest = np.sqrt(1 - np.square(alignments))

        def bound(best: np.ndarray, sign: float) -> np.ndarray:
            # The bound is extreme where anchor and row lie on the same side of the code.
            near = np.clip(np.clip(best, along - error, along + error), -1, 1)
            return alignments * near + sign * rest * np.sqrt(1 - np.square(near))

        reach = lengths * self.length
        slack = reach * SLACK + SLACK
        return reach * bound(-alignments, -1.0) - slack, reach * bound(alignments, 1.0) + slack


class _Best:
    """The best ``count`` (score, id) of one list, greatest score first, ties by smaller id."""

    def __init__(self, count: int, floor: int):
        self.count, self.floor = count, floor
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.count]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.count:
            self.floor = max(self.floor, int(self.scores[-1]))


def _search(batches: Iterator[pa.RecordBatch], sent: Broadcast, count: int, same: bool) -> Iterator[pa.RecordBatch]:
    prepared = [_Prepared(w) for w in sent.value]
    best = [[_Best(count, f) for f in p.wanted.floors] for p in prepared]
    for batch in batches:
        sizes = batch.column("dims").to_numpy()
        for dims in np.unique(sizes).tolist():
            chosen = [i for i, p in enumerate(prepared) if len(p.wanted.components) == dims]
            at = np.flatnonzero(sizes == dims) if chosen else []
            for start in range(0, len(at), CHUNK_ROWS):
                part = batch.take(pa.array(at[start : start + CHUNK_ROWS]))
                _compare(part, dims, [(prepared[i], best[i]) for i in chosen], same)
    rows = [
        (p.wanted.id, place, i, s)
        for p, lists in zip(prepared, best)
        for place, b in enumerate(lists)
        for s, i in zip(b.scores.tolist(), b.ids.tolist())
    ]
    for start in range(0, len(rows), 100_000):
        yield batch_of(rows[start : start + 100_000], FOUND)


def _compare(part: pa.RecordBatch, dims: int, anchors: list[tuple[_Prepared, list[_Best]]], same: bool) -> None:
    """Offer the rows of ``part`` to the lists of the anchors: their label only, or all others."""
    ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
    lengths, alignments = part.column("length").to_numpy(), part.column("alignment").to_numpy()
    whole = np.frombuffer(b"".join(part.column("components").to_pylist()), dtype="<i4").reshape(-1, dims)
    codes = np.frombuffer(b"".join(part.column("code").to_pylist()), dtype="<u8").reshape(len(ids), -1)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    longest = float(lengths.max()) ** 2
    for anchor, lists in anchors:
        wanted = anchor.wanted
        at = np.flatnonzero(((labels == wanted.label) if same else (labels != wanted.label)) & (ids != wanted.id))
        if not at.size:
            continue
        low, high = anchor.interval(codes[at], ones[at], lengths[at], alignments[at])
        open_ = np.zeros(len(at), dtype=bool)
        for (least, most), b in zip(wanted.bounds, lists):
            open_ |= (high >= max(least, b.floor)) & (low <= most)
        at = at[open_]
        if not at.size:
            continue
        kind = np.float64 if max(longest, anchor.length**2) < EXACT else np.int64
        scores = (whole[at].astype(kind) @ wanted.components.astype(kind)).astype(np.int64)
        for (least, most), b in zip(wanted.bounds, lists):
            fits = np.flatnonzero((scores >= max(least, b.floor)) & (scores <= most))
            if fits.size:
                b.add(scores[fits], ids[at[fits]])


#: Scores without a bound of their own.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _ranked(rows: DataFrame, block: list[Wanted], count: int, same: bool) -> DataFrame:
    """Per anchor of ``block`` and list: anchor, place, rank, id, score of the best ``count`` rows."""
    sent = rows.sparkSession.sparkContext.broadcast(block)  # BLOCK_BYTES, about

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, sent, count, same)

    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    found = rows.drop("sampled").mapInArrow(run, FOUND_DDL).withColumn("rank", F.row_number().over(order))
    return found.filter(F.col("rank") <= count)


def best_partners(rows: DataFrame, block: list[Wanted], count: int, same: bool) -> DataFrame:
    """As ``_ranked``, with the floors that the sampled rows give: their last rank, where they have one."""
    if not block:
        return _ranked(rows.limit(0), block, count, same)
    last = _ranked(rows.filter("sampled"), block, count, same).filter(F.col("rank") == count)
    known = {(r["anchor"], r["place"]): r["score"] for r in last.collect()}  # at most one row per list
    raised = [
        replace(w, floors=[max(f, known.get((w.id, i), LOWEST)) for i, f in enumerate(w.floors)]) for w in block
    ]
    return _ranked(rows, raised, count, same)


def anchor_blocks(anchors: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[Wanted]]:
    """The anchors, one row per id, in blocks of about ``block_bytes`` of components."""
    least = F.min(F.struct("label", "components")).alias("one")
    distinct = stored(anchors.groupBy("id").agg(least).select("id", "one.label", "one.components"), "anchors")
    held = distinct.agg(F.sum(F.length("components"))).first()[0] or 0
    blocks = -(-held // block_bytes)
    for number in range(blocks):
        rows = distinct.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).orderBy("id").collect()
        yield [
            Wanted(r["id"], r["label"], np.frombuffer(bytes(r["components"]), dtype="<i4"), [(LOWEST, HIGHEST)], [LOWEST])
            for r in rows
        ]


def _negative_bounds(score: int, least_percent: int, most_percent: int) -> tuple[int, int]:
    """Integer scores s with least * score <= 100 * s <= most * score."""
    return -(-least_percent * score // 100), most_percent * score // 100


def mined(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the vector's id under the name ``id``; ``label`` may name any
    column of ``vectors``. Per anchor its best ``positives`` rows of the same label, and for each of
    these the best ``negatives`` rows of other labels whose score is ``least_percent`` to
    ``most_percent`` of the positive's.
    """
    sampled = F.pmod(F.xxhash64("id"), F.lit(SAMPLED)) == 0
    rows = stored(coded(vectors, F.col(vec_id), label, F.col(vector)).withColumn("sampled", sampled), "codes")
    result = None
    for block in anchor_blocks(rows.filter(is_anchor), block_bytes):
        chosen: dict[int, list[tuple[int, int]]] = {w.id: [] for w in block}
        # At most ``positives`` rows for each anchor of the block.
        for r in best_partners(rows, block, positives, True).orderBy("anchor", "rank").collect():
            chosen[r["anchor"]].append((r["id"], r["score"]))
        asked = [
            replace(
                w, bounds=[_negative_bounds(s, least_percent, most_percent) for _, s in chosen[w.id]],
                floors=[LOWEST] * len(chosen[w.id]),
            )
            for w in block
            if chosen[w.id]
        ]
        pairs = [(a, place, i, s) for a, found in chosen.items() for place, (i, s) in enumerate(found)]
        named = vectors.sparkSession.createDataFrame(
            pairs, "anchor bigint, place int, positive_id bigint, positive_score bigint"
        )
        found = stored(best_partners(rows, asked, negatives, False), "negatives")
        found = found.join(named, ["anchor", "place"]).select(
            F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
            F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        )
        found = stored(found, "hard-negatives")
        result = found if result is None else result.unionByName(found)
    if result is None:
        return vectors.sparkSession.createDataFrame(
            [],
            "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
        )
    return result
