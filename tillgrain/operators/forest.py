"""Random forests grown by Spark: histograms of all tasks for large nodes, one task for each small one.

The bootstrap of a tree is a Poisson(1) count per row, drawn from a hash of row and tree, so every
task knows it without storing it. Both labels weigh the same in every bootstrap. All trees grow
together: as long as a node holds more than ``local_rows`` rows, tasks return histograms of it
(a few kilobytes per node) and its best split is taken from their sum. The rows of a smaller node
go to one task, which grows the rest of that tree below it, to any depth. So a task holds a
bounded number of rows however many there are, and a tree is not bounded in depth.

A node tries the first inputs, in an order drawn for it, that vary in it. Trees are a table: a row
per top node that is a leaf or has been grown locally, with the nodes below it as packed arrays.
Scoring sends rows to the tasks that hold bundles of trees and adds up the bundles per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.operators.binning import BINS, LOCAL_ROWS, bin_edges, coded, drawn, key_of, mixed, unpacked
from tillgrain.operators.materialize import materialize
from tillgrain.session import prepare_workers

CODES = 256
#: Histograms that a task holds at once; more trees than fit go in further passes.
HISTOGRAM_BYTES = 256 << 20
#: A drawn count and a label as one number below KINDS.
KINDS = 64
#: Rows that are grown together in one go: they stay in a core's cache.
GROUP_ROWS = 1 << 17
#: Sums per code are taken while nodes hold more than one row for so many codes; else rows are sorted.
SPARSE = 8
#: More rows than a batch has, so that its rows and drawn counts can be summed as one number.
ROWS_UNIT = 1 << 26
#: Bytes of a grown node in a bundle of the scoring, of a bundle at most, and bundles at least.
BYTES_PER_NODE, BUNDLE_BYTES, LEAST_BUNDLES = 15, 32 << 20, 32
#: Gains within this share of the greatest are equal, so that rounding does not choose between splits.
EQUAL = 1e-10
#: Cumulative probabilities of a Poisson(1) count.
POISSON = np.cumsum([np.exp(-1) / np.prod(np.arange(1, n + 1)) for n in range(20)])

ROWS = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("labels", pa.binary()), ("counts", pa.binary()), ("codes", pa.binary())])
ROWS_DDL = "tree int, node int, labels binary, counts binary, codes binary"
GROWN = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("n", pa.int64()), ("feature", pa.binary()), ("cut", pa.binary()), ("child", pa.binary()), ("value", pa.binary())])
GROWN_DDL = "tree int, node int, n bigint, feature binary, cut binary, child binary, value binary"
SPLITS = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("cut", pa.int32()), ("left", pa.int64()), ("right", pa.int64()), ("value", pa.float64())])
SPLITS_DDL = "tree int, node int, feature int, cut int, left bigint, right bigint, value double"


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 300
    leaf_rows: int = 5
    tried_inputs: int = 2
    bins: int = BINS
    seed: int = 42
    local_rows: int = LOCAL_ROWS
    #: Greatest depth of a tree, where one is wanted.
    depth: int | None = None


@dataclass
class Top:
    """The nodes of one tree above the local ones, by number; child is the left one, right follows."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [-1])
    hashes: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.child[node] = feature, cut, left
        for side in (0, 1):
            self.feature.append(-1), self.cut.append(0), self.child.append(-1)
            self.hashes.append(child_hash(self.hashes[node], side))
            self.depths.append(self.depths[node] + 1)
        return left, left + 1

    def route(self, codes: np.ndarray) -> np.ndarray:
        return descend(codes, np.array(self.feature), np.array(self.cut), np.array(self.child))


@dataclass(frozen=True)
class Forest:
    """Trees as a table, what lies above their rows, and the bins of the inputs."""

    inputs: tuple[str, ...]
    edges: list[list[float]]
    tops: list[Top]
    grown: DataFrame


def child_hash(parent: int, side: int) -> int:
    return int(mixed(np.array([(parent * 2 + 1 + side) & (1 << 64) - 1], dtype=np.uint64))[0])


def root_hash(seed: int, tree: int) -> int:
    return int(mixed(np.array([(seed << 32) + tree + 1], dtype=np.uint64))[0])


def input_order(hashes: np.ndarray, width: int) -> np.ndarray:
    """Per node the order in which its inputs are tried."""
    with np.errstate(over="ignore"):
        keys = mixed(hashes[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.argsort(keys, axis=1, kind="stable")


def steps_of(feature: np.ndarray, cut: np.ndarray, child: np.ndarray) -> np.ndarray:
    """Every node as one number: left child, cut and input. Leaves lead to themselves."""
    leaf = feature < 0
    led, cuts = np.where(leaf, np.arange(len(feature)), child), np.where(leaf, CODES - 1, cut)
    return led.astype(np.int64) << 16 | cuts.astype(np.int64) << 8 | np.where(leaf, 0, feature).astype(np.int64)


def descended(codes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Number of the leaf of every row: left where its code is at most the cut."""
    flat, at = codes.ravel(), np.zeros(len(codes), dtype=np.int64)
    rows, now, first = np.arange(len(codes)), at.copy(), np.arange(0, codes.size, codes.shape[1])
    while rows.size:
        for _ in range(4):  # some levels at once; rows at leaves stay there
            step = steps[now]
            now = (step >> 16) + (flat[first + (step & 255)] > (step >> 8 & 255))
        open_ = steps[now] >> 16 != now
        at[rows[~open_]] = now[~open_]
        rows, now, first = rows[open_], now[open_], first[open_]
    return at


def descend(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, child: np.ndarray) -> np.ndarray:
    return descended(codes, steps_of(feature, cut, child))


def counts_of(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    return np.searchsorted(POISSON, drawn(keys, seed, tree), side="right").astype(np.uint8)


def _purity(ones: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """What a side adds to the gain: the greater, the purer (Gini)."""
    zeros = whole - ones
    return (np.square(ones) + np.square(zeros)) / np.maximum(whole, 1e-300)


class _Nodes:
    """Nodes of a tree as arrays that grow; the children of a split lie side by side."""

    def __init__(self) -> None:
        self.size = 1
        self.arrays = [np.empty(64, dtype=k) for k in (np.int16, np.uint8, np.int32, np.float64)]
        self._clear(0, 1)

    def _clear(self, first: int, end: int) -> None:
        for array, blank in zip(self.arrays, (-1, 0, -1, 0.0)):
            array[first:end] = blank

    def split(self, numbers: np.ndarray, features: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Numbers of the children, left and right in turn."""
        first, self.size = self.size, self.size + 2 * len(numbers)
        while self.size > len(self.arrays[0]):
            self.arrays = [np.concatenate([a, np.empty_like(a)]) for a in self.arrays]
        self._clear(first, self.size)
        for array, values in zip(self.arrays, (features, cuts, first + 2 * np.arange(len(numbers)))):
            array[numbers] = values
        return np.arange(first, self.size)

    def valued(self, numbers: np.ndarray, values: np.ndarray) -> None:
        self.arrays[3][numbers] = values


def grow(
    codes: np.ndarray, labels: np.ndarray, counts: np.ndarray, weights: Sequence[float], hash_: int,
    settings: ForestSettings, depth: int = 0,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1 at leaves), cut, left child and share of label 1 of the nodes of one tree.

    The rows of a node lie together and are moved when it is split, so that they are read in the order
    in which they lie. A node of more than ``GROUP_ROWS`` rows is split alone; smaller ones are put
    together to about as many rows, which stay in a core's cache, and each group grows to its end.
    """
    nodes, kind = _Nodes(), labels * np.uint8(KINDS // 2) + counts
    drawn_as = np.arange(KINDS // 2) * np.asarray(weights, dtype=np.float64)[:, None]
    worth, ones = drawn_as.ravel(), np.concatenate([np.zeros(KINDS // 2), drawn_as[1]])
    open_ = [(0, codes, kind, np.uint64(hash_), depth)]
    group: list[tuple] = []
    held = 0
    while open_:
        part = open_.pop()
        if len(part[2]) > GROUP_ROWS:
            open_ += _split_alone(nodes, *part, worth, ones, settings)
            continue
        if held + len(part[2]) > GROUP_ROWS:
            _grow_group(nodes, group, worth, ones, settings)
            group, held = [], 0
        group.append(part)
        held += len(part[2])
    if group:
        _grow_group(nodes, group, worth, ones, settings)
    return tuple(a[: nodes.size] for a in nodes.arrays)


def _split_alone(
    nodes: _Nodes, number: int, codes: np.ndarray, kind: np.ndarray, hash_: np.uint64, depth: int,
    worth: np.ndarray, ones: np.ndarray, settings: ForestSettings,
) -> list[tuple]:
    """Split one large node by the rows per code and kind of each tried input; its children."""
    per_kind, size = np.bincount(kind, minlength=KINDS), len(kind)
    whole, one = per_kind @ worth, per_kind @ ones
    nodes.valued(number, one / whole)
    if not (one > 1e-9 and whole - one > 1e-9 and size >= 2 * settings.leaf_rows) or depth == settings.depth:
        return []
    best, tried = (-np.inf, -1, 0), 0
    for f in input_order(np.array([hash_]), codes.shape[1])[0].tolist():
        table = np.bincount(codes[:, f] * np.int64(KINDS) + kind, minlength=CODES * KINDS).reshape(CODES, KINDS)
        n = table.sum(axis=1)
        if np.count_nonzero(n) < 2:
            continue
        left, lw, lo = np.cumsum(n), np.cumsum(table @ worth), np.cumsum(table @ ones)
        gain = _purity(lo, lw) + _purity(one - lo, whole - lw)
        gain[(n == 0) | (left < settings.leaf_rows) | (size - left < max(settings.leaf_rows, 1))] = -np.inf
        most = gain.max()
        if most > best[0] * (1 + EQUAL):
            best = (most, f, int(np.argmax(gain >= most * (1 - EQUAL))))
        tried += 1
        if tried == settings.tried_inputs:
            break
    if best[1] < 0:
        return []
    right = codes[:, best[1]] > best[2]
    sides = nodes.split(np.array([number]), np.array([best[1]]), np.array([best[2]])).tolist()
    return [
        (child, np.compress(kept, codes, axis=0), kind[kept], np.uint64(child_hash(int(hash_), side)), depth + 1)
        for side, (child, kept) in enumerate(zip(sides, (~right, right)))
    ]


def _grow_group(nodes: _Nodes, group: list[tuple], worth: np.ndarray, ones_of: np.ndarray, settings: ForestSettings) -> None:
    """Grow all that lies below some small nodes, a level at a time.

    A split is a place in the rows sorted by node and code. Where nodes are large, sums per code take
    the place of the sort.
    """
    numbers, depths = np.array([p[0] for p in group]), np.array([p[4] for p in group])
    here, kind = np.concatenate([p[1] for p in group]), np.concatenate([p[2] for p in group])
    hashes, sizes = np.array([p[3] for p in group], dtype=np.uint64), np.array([len(p[2]) for p in group])
    width = here.shape[1]
    while True:
        starts = np.cumsum(sizes) - sizes
        w, one = worth[kind], ones_of[kind]
        whole, ones = np.add.reduceat(w, starts), np.add.reduceat(one, starts)
        nodes.valued(numbers, ones / whole)
        mixed_node = (ones > 1e-9) & (whole - ones > 1e-9) & (sizes >= 2 * settings.leaf_rows)
        if settings.depth is not None:
            mixed_node &= depths != settings.depth
        if not mixed_node.any():
            return
        if not mixed_node.all():
            kept = np.repeat(mixed_node, sizes)
            here, kind, w, one = np.compress(kept, here, axis=0), kind[kept], w[kept], one[kept]
            numbers, depths, sizes, hashes, whole, ones = (
                x[mixed_node] for x in (numbers, depths, sizes, hashes, whole, ones)
            )
            starts = np.cumsum(sizes) - sizes
        node = np.repeat(np.arange(len(sizes)), sizes)
        varies = np.minimum.reduceat(here, starts, axis=0) < np.maximum.reduceat(here, starts, axis=0)
        order = input_order(hashes, width)
        ranked = np.take_along_axis(varies, order, axis=1)
        place = np.where(ranked, np.cumsum(ranked, axis=1), 0)
        gain, best, at = np.full(len(sizes), -np.inf), np.full(len(sizes), -1), np.zeros(len(sizes), dtype=np.int64)
        for turn in range(1, settings.tried_inputs + 1):
            has = (place == turn).any(axis=1)
            tried = np.where(has, order[np.arange(len(sizes)), np.argmax(place == turn, axis=1)], -1)
            if not has.any():
                break
            cuts = _best_cuts if len(node) * SPARSE < CODES * len(sizes) else _best_cuts_of_large
            found, where = cuts(here, tried, node, starts, sizes, w, one, whole, ones, settings.leaf_rows)
            better = has & (found > gain * (1 + EQUAL))  # -inf stays below any
            gain[better], best[better], at[better] = found[better], tried[better], where[better]
        splits = best >= 0
        if not splits.any():
            return
        if not splits.all():
            kept = np.repeat(splits, sizes)
            here, kind = np.compress(kept, here, axis=0), kind[kept]
            numbers, depths, sizes, hashes, best, at = (x[splits] for x in (numbers, depths, sizes, hashes, best, at))
        numbers = nodes.split(numbers, best, at)
        # Rows keep their order on both sides of their node.
        right = _picked(here, np.repeat(best, sizes)) > np.repeat(at, sizes)
        ends = np.cumsum(sizes)
        passed = np.concatenate([[0], np.cumsum(right)])
        over = passed[ends] - passed[ends - sizes]
        moved = np.empty(len(right), dtype=np.int64)
        first_left, first_right = ends - sizes - (ends - sizes - passed[ends - sizes]), ends - over - passed[ends - sizes]
        to_left, to_right = np.flatnonzero(~right), np.flatnonzero(right)
        moved[np.arange(len(to_left)) + np.repeat(first_left, sizes - over)] = to_left
        moved[np.arange(len(to_right)) + np.repeat(first_right, over)] = to_right
        here, kind = np.take(here, moved, axis=0), kind[moved]
        sizes = np.column_stack([sizes - over, over]).ravel()
        depths = np.repeat(depths + 1, 2)
        with np.errstate(over="ignore"):
            hashes = mixed(np.repeat(hashes, 2) * np.uint64(2) + np.tile(np.array([1, 2], dtype=np.uint64), len(hashes)))


def _picked(here: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The code of every row in a column of its own."""
    return here.ravel()[np.arange(0, here.size, here.shape[1]) + column]


def _best_cuts(here, tried, node, starts, sizes, w, one, whole, ones, least):
    """Greatest gain and its code per node for the input tried in it; -inf where none is allowed."""
    code = _picked(here, np.repeat(np.maximum(tried, 0), sizes))
    # Numbers that hold their row are sorted faster than an order is found, and equal codes keep theirs.
    bits = max(len(node) - 1, 1).bit_length()
    keys = np.sort((node * CODES + code) << bits | np.arange(len(node)))
    order = keys & (1 << bits) - 1
    cell, w, one = keys >> bits, np.cumsum(w[order]), np.cumsum(one[order])
    left = np.arange(1, len(node) + 1) - np.repeat(starts, sizes)
    last = np.concatenate([cell[:-1] < cell[1:], [False]])  # of its code
    allowed = last & (left >= least) & (np.repeat(sizes, sizes) - left >= max(least, 1)) & np.repeat(tried >= 0, sizes)
    spot = np.flatnonzero(allowed)
    owner = node[spot]
    before_w = np.concatenate([[0.0], w])[starts[owner]]
    before_one = np.concatenate([[0.0], one])[starts[owner]]
    return _greatest(owner, cell[spot] & CODES - 1, w[spot] - before_w, one[spot] - before_one, whole, ones)


def _best_cuts_of_large(here, tried, node, starts, sizes, w, one, whole, ones, least):
    """``_best_cuts`` by sums per node and code, for nodes that hold many of the codes."""
    cell = _picked(here, np.repeat(np.maximum(tried, 0), sizes)) + node * CODES
    n, lw, lo = (np.bincount(cell, v, len(sizes) * CODES).reshape(-1, CODES) for v in (None, w, one))
    left, lw, lo = np.cumsum(n, axis=1), np.cumsum(lw, axis=1), np.cumsum(lo, axis=1)
    allowed = (n > 0) & (left >= least) & (sizes[:, None] - left >= max(least, 1)) & (tried >= 0)[:, None]
    spot = np.flatnonzero(allowed)
    return _greatest(spot // CODES, spot % CODES, lw.ravel()[spot], lo.ravel()[spot], whole, ones)


def _greatest(owner, code, lw, lo, whole, ones):
    """Greatest gain per node, and the first code that reaches it, of cuts in order of node and code."""
    gain, at = np.full(len(whole), -np.inf), np.zeros(len(whole), dtype=np.int64)
    if not owner.size:
        return gain, at
    found = _purity(lo, lw) + _purity(ones[owner] - lo, whole[owner] - lw)
    heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    gain[owner[heads]] = np.maximum.reduceat(found, heads)
    hit = np.flatnonzero(found >= gain[owner] * (1 - EQUAL))
    firsts = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])]
    at[owner[firsts]] = code[firsts]
    return gain, at


def _row_blobs(batches: Iterator[pa.RecordBatch], tops: Sequence[Top], wanted: dict[int, set[int]], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The rows of the wanted nodes, as one blob per node and batch."""
    for keys, labels, codes in unpacked(batches, key=np.int64, label=np.int64, codes=np.uint8):
        labels, codes = labels.astype(np.uint8), codes.reshape(-1, width)
        found = []
        for tree, nodes in wanted.items():
            counts = counts_of(keys, seed, tree)
            at = tops[tree].route(codes)
            for node in nodes:
                chosen = np.flatnonzero((at == node) & (counts > 0))
                if chosen.size:
                    found.append((tree, node, labels[chosen].tobytes(), counts[chosen].tobytes(), codes[chosen].tobytes()))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*found), ROWS)], schema=ROWS)


def _bootstrap_totals(rows: DataFrame, settings: ForestSettings) -> dict[int, tuple[float, float, int]]:
    """Per tree the drawn counts of label 0 and 1 and its distinct rows."""
    schema = pa.schema([("tree", pa.int32()), ("zeros", pa.int64()), ("ones", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((settings.trees, 3), dtype=np.int64)
        for keys, labels in unpacked(batches, key=np.int64, label=np.int64):
            labels = labels == 1
            for tree in range(settings.trees):
                counts = counts_of(keys, settings.seed, tree)
                sums[tree] += (int(counts[~labels].sum()), int(counts[labels].sum()), int((counts > 0).sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(settings.trees, dtype=np.int32)), *[pa.array(c) for c in sums.T]], schema=schema
        )

    found = prepare_workers(rows).mapInArrow(run, "tree int, zeros bigint, ones bigint, n bigint").groupBy("tree")
    totals = found.agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "n")]).collect()  # a row per tree
    return {r["tree"]: (float(r["zeros"]), float(r["ones"]), r["n"]) for r in totals}


def _large_splits(
    rows: DataFrame, tops: list[Top], nodes: dict[int, list[int]], weights: dict[int, tuple[float, float]], settings: ForestSettings, width: int
) -> list:
    """Best split, and rows on both sides, of the given nodes of the given trees, from histograms."""
    places = [(t, n) for t, found in nodes.items() for n in found]
    schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())])
    number = {p: i for i, p in enumerate(places)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Drawn counts of both labels, and distinct rows, per node, input and code.
        sums = np.zeros((len(places), 3, width * CODES), dtype=np.int64)
        for keys, labels, codes in unpacked(batches, key=np.int64, label=np.int64, codes=np.uint8):
            codes = codes.reshape(-1, width)
            cells = codes + np.arange(width) * CODES
            for tree, found in nodes.items():
                counts = counts_of(keys, settings.seed, tree)
                at = np.where(counts > 0, tops[tree].route(codes), -1)
                for node in found:
                    for label in (0, 1):
                        mine = np.flatnonzero((at == node) & (labels == label))
                        # Drawn counts and rows share one sum of whole numbers, which is exact.
                        both = np.bincount(
                            cells[mine].ravel(), np.repeat(counts[mine] * float(ROWS_UNIT) + 1, width), width * CODES
                        ).astype(np.int64)
                        sums[number[tree, node], label] += both // ROWS_UNIT
                        sums[number[tree, node], 2] += both % ROWS_UNIT
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in places], type=pa.int32()), pa.array([p[1] for p in places], type=pa.int32()),
             pa.array([s.tobytes() for s in sums], type=pa.binary())],
            schema=schema,
        )

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = int(key[0].as_py()), int(key[1].as_py())
        sums = sum(np.frombuffer(b, dtype=np.int64) for b in table.column("sums").to_pylist()).reshape(3, width, CODES)
        zeros, ones = sums[0] * weights[tree][0], sums[1] * weights[tree][1]
        whole, one, n = float((zeros + ones)[0].sum()), float(ones[0].sum()), int(sums[2, 0].sum())
        best = (-np.inf, -1, 0, 0)
        open_ = tops[tree].depths[node] != settings.depth and n >= 2 * settings.leaf_rows
        if open_ and one > 1e-9 and whole - one > 1e-9:
            order = input_order(np.array([tops[tree].hashes[node]], dtype=np.uint64), width)[0]
            varying = [f for f in order.tolist() if np.count_nonzero(sums[2, f]) > 1][: settings.tried_inputs]
            for f in varying:
                left_n = np.cumsum(sums[2, f])
                lw, lo = np.cumsum(zeros[f] + ones[f]), np.cumsum(ones[f])
                gain = _purity(lo, lw) + _purity(one - lo, whole - lw)
                gain[(left_n < settings.leaf_rows) | (n - left_n < settings.leaf_rows) | (sums[2, f] == 0)] = -np.inf
                at = int(np.argmax(gain >= gain.max() * (1 - EQUAL)))
                if gain[at] > best[0] * (1 + EQUAL):
                    best = (float(gain[at]), f, at, int(left_n[at]))
        row = (tree, node, best[1], best[2], best[3], n - best[3], one / whole)
        return pa.Table.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, SPLITS)], schema=SPLITS)

    found = prepare_workers(rows).mapInArrow(count, "tree int, node int, sums binary")
    return found.groupBy("tree", "node").applyInArrow(choose, SPLITS_DDL).collect()  # a row per node


def fit_forest(rows: DataFrame, inputs: Sequence[str], label: str, key: Sequence[str], settings: ForestSettings = ForestSettings()) -> Forest:
    """Grow a forest for a label of 0 and 1; ``key`` names columns that tell rows apart."""
    width = len(inputs)
    edges = bin_edges(rows, inputs, settings.bins)
    table = materialize(
        coded(rows, inputs, edges, True, key=key_of(*key), label=F.col(label).cast("bigint")), "forest-rows"
    )
    totals = _bootstrap_totals(table, settings)
    # Both labels weigh half of a bootstrap, each row as often as it was drawn.
    weights = {
        t: tuple((zeros + ones) / (2 * c) if c else 0.0 for c in (zeros, ones)) for t, (zeros, ones, _) in totals.items()
    }
    tops = [Top(hashes=[root_hash(settings.seed, t)]) for t in range(settings.trees)]
    local: dict[int, set[int]] = {t: set() for t in totals}
    leaves: list[tuple] = []
    large: dict[int, list[int]] = {}
    for t, (_, _, n) in totals.items():
        if n > settings.local_rows:
            large[t] = [0]
        elif n:
            local[t].add(0)
    while large:
        grown: dict[int, list[int]] = {}
        for wave in _waves(large, 3 * width * CODES * 8):
            for r in _large_splits(table, tops, wave, weights, settings, width):
                if r["feature"] < 0:
                    leaves.append((r["tree"], r["node"], r["left"] + r["right"], r["value"]))
                    continue
                sides = tops[r["tree"]].split(r["node"], r["feature"], r["cut"])
                for node, n in zip(sides, (r["left"], r["right"])):
                    if n > settings.local_rows:
                        grown.setdefault(r["tree"], []).append(node)
                    else:
                        local[r["tree"]].add(node)
        large = grown

    def finish(key_: tuple, part: pa.Table) -> pa.Table:
        tree, node = int(key_[0].as_py()), int(key_[1].as_py())
        labels, counts = (np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint8) for c in ("labels", "counts"))
        codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, width)
        found = grow(codes, labels, counts, weights[tree], tops[tree].hashes[node], settings, tops[tree].depths[node])
        row = (tree, node, len(codes), *[x.tobytes() for x in found])
        return pa.Table.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, GROWN)], schema=GROWN)

    blobs = prepare_workers(table).mapInArrow(lambda b: _row_blobs(b, tops, local, width, settings.seed), ROWS_DDL)
    # Several tasks per core: nodes differ in their rows, and a core that is done takes the next.
    nodes = sum(len(found) for found in local.values())
    dealt = blobs.repartition(max(1, min(nodes, 4 * _partitions(rows))), "tree", "node")
    subtrees = dealt.groupBy("tree", "node").applyInArrow(finish, GROWN_DDL)
    if leaves:
        packed = [
            (t, n, size, *[np.array([v], dtype=k).tobytes() for v, k in zip((-1, 0, -1, value), ("<i2", "u1", "<i4", "<f8"))])
            for t, n, size, value in leaves
        ]
        subtrees = subtrees.unionByName(rows.sparkSession.createDataFrame(packed, GROWN_DDL))
    return Forest(tuple(inputs), edges, tops, materialize(subtrees, "forest"))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _waves(nodes: dict[int, list[int]], size: int) -> Iterator[dict[int, list[int]]]:
    """Nodes in groups whose histograms fit in ``HISTOGRAM_BYTES``."""
    wave: dict[int, list[int]] = {}
    held = 0
    for tree, found in nodes.items():
        for node in found:
            if held and (held + 1) * size > HISTOGRAM_BYTES:
                yield wave
                wave, held = {}, 0
            wave.setdefault(tree, []).append(node)
            held += 1
    if wave:
        yield wave


PARTS = pa.schema([("batch", pa.int64()), ("bundle", pa.int32()), ("slice", pa.int32()), ("rows", pa.binary()), ("codes", pa.binary())])
PARTS_DDL = "batch bigint, bundle int, slice int, rows binary, codes binary"
VALUES = pa.schema([("batch", pa.int64()), ("bundle", pa.int32()), ("rows", pa.binary()), ("values", pa.binary())])
VALUES_DDL = "batch bigint, bundle int, rows binary, values binary"
SCORES = pa.schema([("row", pa.int64()), ("score", pa.float64())])


def _bundles(grown: DataFrame) -> dict[tuple[int, int], int]:
    """A bundle for every grown node: nodes in order, up to ``BUNDLE_BYTES`` or a share of the forest."""
    found = grown.select("tree", "node", (F.octet_length("value") * BYTES_PER_NODE / 8).alias("size"))
    sizes = sorted((r["tree"], r["node"], r["size"]) for r in found.collect())  # a row per top node
    most = min(BUNDLE_BYTES, sum(size for *_, size in sizes) / LEAST_BUNDLES)
    bundles: dict[tuple[int, int], int] = {}
    number, held = 0, 0.0
    for tree, node, size in sizes:
        if held and held + size > most:
            number, held = number + 1, 0.0
        bundles[tree, node] = number
        held += size
    return bundles


def forest_scores(forest: Forest, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` and ``name``, the mean share of label 1 in the leaves that a row falls into.

    Trees are put into bundles of bounded size. Rows travel to the tasks that hold the bundles with
    their nodes, a blob per batch and bundle, and back as one number per bundle; with many rows several
    tasks hold a bundle, each for a slice of the batches. A batch's numbers are added up in order.
    """
    width, tops, trees = len(forest.inputs), forest.tops, len(forest.tops)
    numbered = materialize(rows.withColumn("_place", F.monotonically_increasing_id()), "scored-rows")
    table = coded(numbered, forest.inputs, forest.edges, True, row=F.col("_place"))
    bundles, slices = _bundles(forest.grown), numbered.count() // LOCAL_ROWS + 1
    held: dict[int, dict[int, list[int]]] = {}  # bundle -> tree -> nodes
    for (tree, node), bundle in bundles.items():
        held.setdefault(bundle, {}).setdefault(tree, []).append(node)
    leaves = [top.feature.count(-1) for top in tops]
    whole = {b for b, found in held.items() if any(len(nodes) == leaves[tree] for tree, nodes in found.items())}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places, codes in unpacked(batches, row=np.int64, codes=np.uint8):
            codes, found, batch = codes.reshape(-1, width), [], int(places[0])
            part = int(drawn(places[:1], slices)[0] * slices)
            for bundle, nodes_of in held.items():
                mine = np.ones(len(codes), dtype=bool)
                if bundle not in whole:
                    mine = np.zeros(len(codes), dtype=bool)
                    for tree, nodes in nodes_of.items():
                        mine |= np.isin(tops[tree].route(codes), nodes)
                if mine.any():
                    found.append((batch, bundle, part, places[mine].tobytes(), codes[mine].tobytes()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*found), PARTS)], schema=PARTS)

    def fall(parts: pa.Table, grown: pa.Table) -> pa.Table:
        nodes_of: dict[int, dict[int, tuple]] = {}
        for r in sorted(grown.to_pylist(), key=lambda r: (r["tree"], r["node"])):
            *splits, value = (
                np.frombuffer(r[c], dtype=k) for c, k in zip(("feature", "cut", "child", "value"), ("<i2", "u1", "<i4", "<f8"))
            )
            nodes_of.setdefault(r["tree"], {})[r["node"]] = steps_of(*splits), value
        # A tree's nodes stay in the cache while all batches fall through it.
        blobs = parts.select(["batch", "bundle", "rows", "codes"]).to_pylist()
        codes = [np.frombuffer(p["codes"], dtype=np.uint8).reshape(-1, width) for p in blobs]
        sums = [np.zeros(len(c)) for c in codes]
        for tree, nodes in nodes_of.items():
            single = len(tops[tree].feature) == 1
            for each, total in zip(codes, sums):
                at = None if single else tops[tree].route(each)
                for node, (steps, value) in nodes.items():
                    if single:
                        total += value[descended(each, steps)]
                        continue
                    mine = np.flatnonzero(at == node)
                    total[mine] += value[descended(each[mine], steps)]
        found = [(p["batch"], p["bundle"], p["rows"], v.tobytes()) for p, v in zip(blobs, sums)]
        columns = list(zip(*found)) or [[] for _ in VALUES]
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, VALUES)], schema=VALUES)

    def add(part: pa.Table) -> pa.Table:
        part = part.sort_by([("bundle", "ascending")])
        places = np.unique(np.concatenate([np.frombuffer(b, dtype=np.int64) for b in part.column("rows").to_pylist()]))
        sums = np.zeros(len(places))
        for where, values in zip(part.column("rows").to_pylist(), part.column("values").to_pylist()):
            sums[np.searchsorted(places, np.frombuffer(where, dtype=np.int64))] += np.frombuffer(values, dtype=np.float64)
        return pa.Table.from_arrays([pa.array(places), pa.array(sums / trees)], schema=SCORES)

    spark = rows.sparkSession
    numbers = spark.createDataFrame([(*k, b) for k, b in bundles.items()] or [], "tree int, node int, bundle int")
    bundled = forest.grown.join(F.broadcast(numbers), ["tree", "node"]).crossJoin(
        F.broadcast(spark.range(slices).select(F.col("id").cast("int").alias("slice")))
    )
    tasks = max(1, min(len(held) * slices, 4 * _partitions(rows)))
    parts, bundled = (
        df.repartition(tasks, "bundle", "slice").groupBy("bundle", "slice")
        for df in (prepare_workers(table).mapInArrow(spread, PARTS_DDL), bundled)
    )
    values = parts.cogroup(bundled).applyInArrow(fall, VALUES_DDL)
    scores = values.groupBy("batch").applyInArrow(add, "row bigint, score double")
    found = scores.select(F.col("row").alias("_place"), F.col("score").alias(name))
    return numbered.join(found, "_place").select(*rows.columns, name)
