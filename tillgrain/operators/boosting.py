"""Gradient boosting of leaf-wise trees for squared error, over histograms.

A tree grows best first: of all leaves the one whose split gains most is split next, up to a number
of leaves. Since a split depends on the rows of its node alone, a pass may look at many leaves at
once, and the order is settled afterwards. Leaves with more than ``local_rows`` rows are split by
histograms summed over all tasks; the rows of a smaller one go to one task, which grows all that
can still be chosen below it, best first, with the histogram of the larger child as the parent's
less its sibling's. The driver holds the chosen splits only.

Missing values have a code of their own and go to the side that gains more. With enough rows, a
fixed share is held out, and boosting stops when its loss has not fallen for some rounds.
Predictions are stored with the rows from time to time; between that the last trees are applied
on the way.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.operators.binning import BINS, MISSING, bin_edges, coded, codes_of, drawn, key_of, unpacked
from tillgrain.operators.materialize import materialize, recording_intermediates
from tillgrain.session import prepare_workers
from tillgrain.sources.paths import delete

CODES = 256
#: Rows of a node that one task grows on its own, in about 0.3 GB. It looks at few of them more than once,
#: so that a pass over all rows for every level of larger nodes takes longer than its work.
LOCAL_ROWS = 3_000_000


@dataclass(frozen=True)
class BoostingSettings:
    rounds: int = 200
    step: float = 0.05
    leaves: int = 31
    leaf_rows: int = 20
    bins: int = BINS
    seed: int = 42
    local_rows: int = LOCAL_ROWS
    #: More rows than this are stopped early, by a share held out and rounds without a fall.
    stops_above: int = 10_000
    held_out: float = 0.1
    patience: int = 10
    fall: float = 1e-7
    #: Rounds after which predictions are stored with the rows; until then every pass applies their trees.
    stored_every: int = 5


@dataclass(frozen=True)
class Split:
    """A split with the rows and the sums of residuals on both sides; ``missing_left`` places NULLs."""

    gain: float
    feature: int
    cut: int
    missing_left: bool
    n: tuple[int, int]
    sums: tuple[float, float]


@dataclass
class Tree:
    """Nodes by number: feature is -1 at leaves, whose value is added to the prediction."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    child: np.ndarray
    value: np.ndarray


@dataclass
class _Node:
    n: int
    total: float
    split: Split | None = None
    children: tuple[int, int] | None = None
    known: bool = False


@dataclass(frozen=True)
class Boosted:
    inputs: tuple[str, ...]
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    losses: list[float] = field(default_factory=list)


def descend(codes: np.ndarray, tree: Tree) -> np.ndarray:
    at, open_ = np.zeros(len(codes), dtype=np.int64), np.arange(len(codes))
    while True:
        open_ = open_[tree.feature[at[open_]] >= 0]
        if not open_.size:
            return at
        node = at[open_]
        code = codes[open_, tree.feature[node]]
        right = np.where(code == MISSING, ~tree.missing_left[node], code > tree.cut[node])
        at[open_] = tree.child[node] + right


def histogram(codes: np.ndarray, residuals: np.ndarray) -> np.ndarray:
    """Sums of residuals and rows per input and code: (2, inputs, CODES)."""
    width = codes.shape[1]
    found = np.empty((2, width, CODES))
    for f in range(width):
        found[0, f] = np.bincount(codes[:, f], weights=residuals, minlength=CODES)
        found[1, f] = np.bincount(codes[:, f], minlength=CODES)
    return found


def best_split(sums: np.ndarray, least: int) -> Split | None:
    """The split of greatest gain; ties go to the first input, missing values right, the lowest cut."""
    total, n = sums[0, 0].sum(), sums[1, 0].sum()
    best: Split | None = None
    if n < 2 * least:
        return None
    lost = sums[:, :, MISSING]
    left_sum, left_n = np.cumsum(sums[0, :, :MISSING], axis=1), np.cumsum(sums[1, :, :MISSING], axis=1)
    for missing_left in (False, True):
        if missing_left and not lost[1].any():
            break
        s = left_sum + (lost[0][:, None] if missing_left else 0)
        c = left_n + (lost[1][:, None] if missing_left else 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.square(s) / c + np.square(total - s) / (n - c) - total * total / n
        gain = np.where((c >= least) & (n - c >= least), gain, -np.inf)
        f, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
        # What rounding leaves of no gain at all is none.
        if gain[f, cut] > 1e-12 * (1 + total * total / n) and (best is None or gain[f, cut] > best.gain):
            counts = (int(c[f, cut]), int(n - c[f, cut]))
            best = Split(float(gain[f, cut]), int(f), int(cut), missing_left, counts, (float(s[f, cut]), float(total - s[f, cut])))
    return best


def grow_below(codes: np.ndarray, residuals: np.ndarray, splits: int, least: int) -> list[tuple[int, Split]]:
    """Up to ``splits`` splits below a node, best first: (number of the split node, split).

    The node is number 0; the children of the i-th split are 2 i + 1 and 2 i + 2.
    """
    found: list[tuple[int, Split]] = []
    queue: list[tuple[float, int, Split]] = []
    rows = {0: np.arange(len(codes))}
    held = {0: histogram(codes, residuals)}

    def offer(node: int) -> None:
        if (split := best_split(held[node], least)) is not None:
            heapq.heappush(queue, (-split.gain, node, split))

    offer(0)
    while queue and len(found) < splits:
        _, node, split = heapq.heappop(queue)
        sides = (2 * len(found) + 1, 2 * len(found) + 2)
        found.append((node, split))
        here = rows.pop(node)
        code = codes[here, split.feature]
        right = np.where(code == MISSING, not split.missing_left, code > split.cut)
        parts = (here[~right], here[right])
        small = int(len(parts[1]) < len(parts[0]))
        sums = histogram(codes[parts[small]], residuals[parts[small]])
        held[sides[small]], held[sides[1 - small]] = sums, held.pop(node) - sums
        for side, part in zip(sides, parts):
            rows[side] = part
            offer(side)
    return found


def choose(nodes: list[_Node], splits: int) -> tuple[list[int], list[int]]:
    """Nodes split best first, and those reached whose children are still unknown.

    Without unknown ones the first list is the tree; else they must be looked into, and nothing
    that is not among them can change the order.
    """
    queue = [(-nodes[0].split.gain, 0)] if nodes[0].split else []
    taken, unknown = [], []
    while queue and len(taken) < splits:
        _, at = heapq.heappop(queue)
        taken.append(at)
        if nodes[at].children is None:
            unknown.append(at)
            continue
        for child in nodes[at].children:
            if not nodes[child].known:
                unknown.append(child)
            elif nodes[child].split:
                heapq.heappush(queue, (-nodes[child].split.gain, child))
    return taken, unknown


FOUND = pa.schema(
    [("node", pa.int32()), ("place", pa.int32()), ("at", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()),
     ("cut", pa.int32()), ("missing_left", pa.bool_()), ("n_left", pa.int64()), ("n_right", pa.int64()),
     ("sum_left", pa.float64()), ("sum_right", pa.float64())]
)
FOUND_DDL = (
    "node int, place int, at int, gain double, feature int, cut int, missing_left boolean,"
    " n_left bigint, n_right bigint, sum_left double, sum_right double"
)
PARTS = pa.schema([("node", pa.int32()), ("sums", pa.binary()), ("residuals", pa.binary()), ("codes", pa.binary())])
PARTS_DDL = "node int, sums binary, residuals binary, codes binary"
#: The held-out rows' squared errors and the residuals of all others travel under numbers of their own.
LOSS = -1


class _Trainer:
    """The rows with their predictions, and passes over them."""

    def __init__(self, table: DataFrame, width: int, base: float, settings: BoostingSettings, stopping: bool):
        self.rows, self.base = table, base
        self.width, self.settings, self.stopping = width, settings, stopping
        self.recent: list[Tree] = []
        self.stored: list[str] = []

    def added(self, tree: Tree) -> None:
        self.recent.append(tree)
        if len(self.recent) >= self.settings.stored_every:
            with recording_intermediates() as paths:
                self.rows = materialize(self._predicted(), "boosted-rows")
            for path in self.stored:  # the predictions before these
                delete(self.rows.sparkSession, path)
            self.recent, self.stored = [], paths

    def _parts(self):
        """Of a task's batches, per packed row: keys, targets, codes, and predictions with the last trees."""
        trees, width, base = list(self.recent), self.width, self.base
        kinds = {"key": np.int64, "target": np.float64, "codes": np.uint8}
        if "prediction" in self.rows.columns:
            kinds["prediction"] = np.float64

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
            for keys, target, codes, *stored in unpacked(batches, **kinds):
                codes = codes.reshape(-1, width)
                made = stored[0].copy() if stored else np.full(len(keys), base)
                for tree in trees:
                    made += tree.value[descend(codes, tree)]
                yield keys, target, codes, made

        return run

    def _predicted(self) -> DataFrame:
        parts = self._parts()
        names = ("key", "target", "codes", "prediction")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts(batches):
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], type=pa.binary()) for x in part], names=names)

        return prepare_workers(self.rows).mapInArrow(run, ", ".join(f"{n} binary" for n in names))

    def look(self, tree: Tree, nodes: dict[int, int], splits: int) -> list:
        """For each of the leaves ``nodes`` (number: rows) of ``tree`` the splits found, as FOUND rows.

        Number LOSS gives the held-out rows (n_left) and their squared errors (sum_left) before ``tree``.
        """
        parts, width, settings, stopping = self._parts(), self.width, self.settings, self.stopping
        large = {i for i, n in nodes.items() if n > settings.local_rows}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {i: np.zeros((2, width, CODES)) for i in large}
            errors, out = 0.0, 0
            for keys, target, codes, made in parts(batches):
                residual = target - made
                kept = np.arange(len(codes))
                if stopping:
                    held = is_held_out(keys, settings)
                    errors, out = errors + float(np.square(residual[held]).sum()), out + int(held.sum())
                    kept = kept[~held]
                at, found = descend(codes[kept], tree), []
                for i in nodes:
                    mine = kept[at == i]
                    if i in large:
                        sums[i] += histogram(codes[mine], residual[mine])
                    elif mine.size:
                        found.append((i, b"", residual[mine].tobytes(), codes[mine].tobytes()))
                if found:
                    yield _batch(found, PARTS)
            rest = [(i, s.tobytes(), b"", b"") for i, s in sums.items()]
            if stopping:
                rest.append((LOSS, np.array([errors, out]).tobytes(), b"", b""))
            if rest:
                yield _batch(rest, PARTS)

        def settle(key: tuple, part: pa.Table) -> pa.Table:
            node = int(key[0].as_py())
            whole = sum(np.frombuffer(b) for b in part.column("sums").to_pylist() if b)
            if node == LOSS:
                rows = [(node, 0, 0, 0.0, 0, 0, False, int(whole[1]), 0, float(whole[0]), 0.0)]
            elif node in large:
                split = best_split(whole.reshape(2, width, CODES), settings.leaf_rows)
                rows = [_as_row(node, 0, 0, split)] if split else []
            else:
                residuals = np.frombuffer(b"".join(part.column("residuals").to_pylist()))
                codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, width)
                found = grow_below(codes, residuals, splits, settings.leaf_rows)
                rows = [_as_row(node, place, at, split) for place, (at, split) in enumerate(found)]
            return pa.Table.from_batches([_batch(rows, FOUND)], schema=FOUND)

        return prepare_workers(self.rows).mapInArrow(run, PARTS_DDL).groupBy("node").applyInArrow(settle, FOUND_DDL).collect()


def is_held_out(keys: np.ndarray, settings: BoostingSettings) -> np.ndarray:
    return drawn(keys, settings.seed) < settings.held_out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def _as_row(node: int, place: int, at: int, split: Split) -> tuple:
    return (node, place, at, split.gain, split.feature, split.cut, split.missing_left, *split.n, *split.sums)


def _as_split(r) -> Split:
    return Split(r["gain"], r["feature"], r["cut"], r["missing_left"], (r["n_left"], r["n_right"]), (r["sum_left"], r["sum_right"]))


def _hang(nodes: list[_Node], at: int, split: Split) -> None:
    """Add the children of a split, whose own splits are not known yet."""
    nodes[at].split = split
    nodes[at].children = (len(nodes), len(nodes) + 1)
    nodes.extend(_Node(n, s) for n, s in zip(split.n, split.sums))


def _as_tree(nodes: list[_Node], taken: Sequence[int], step: float) -> Tree:
    """The tree of the taken splits; nodes are numbered as they come, children side by side."""
    size = 2 * len(taken) + 1
    tree = Tree(
        np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int64), np.zeros(size, dtype=bool),
        np.full(size, -1, dtype=np.int64), np.zeros(size),
    )
    number, filled = {0: 0}, 1
    for at in taken:
        i, split = number.pop(at), nodes[at].split
        tree.feature[i], tree.cut[i], tree.missing_left[i], tree.child[i] = split.feature, split.cut, split.missing_left, filled
        for child in nodes[at].children:
            number[child], filled = filled, filled + 1
    for at, i in number.items():
        tree.value[i] = step * nodes[at].total / max(nodes[at].n, 1)
    return tree


def _partial(nodes: list[_Node]) -> tuple[Tree, list[int]]:
    """All nodes known so far as one tree, and the node behind each of its numbers."""
    inner = [i for i, n in enumerate(nodes) if n.children]
    tree, number = _as_tree(nodes, inner, 0.0), {0: 0}
    filled = 1
    for at in inner:
        for child in nodes[at].children:
            number[child], filled = filled, filled + 1
    return tree, [at for at, _ in sorted(number.items(), key=lambda x: x[1])]


def grow_tree(trainer: _Trainer, n: int, settings: BoostingSettings) -> tuple[list[_Node], list[int], tuple[float, int]]:
    """Nodes looked into, those split in the tree, and the held-out error before it with its rows."""
    nodes, loss = [_Node(n, 0.0)], (0.0, 0)
    taken, unknown = [], [0]
    while unknown:
        tree, behind = _partial(nodes)
        place = {at: i for i, at in enumerate(behind)}
        asked = {place[at]: nodes[at].n for at in unknown}
        rows = trainer.look(tree, asked, settings.leaves - 1)
        found: dict[int, list] = {}
        for r in rows:
            if r["node"] == LOSS:
                loss = (r["sum_left"], r["n_left"])
            else:
                found.setdefault(behind[r["node"]], []).append(r)
        for at in unknown:
            nodes[at].known = True
            below, local = {0: at}, nodes[at].n <= settings.local_rows
            for r in sorted(found.get(at, []), key=lambda r: r["place"]):
                own = below[r["at"]]
                _hang(nodes, own, _as_split(r))
                if own == 0:
                    nodes[0].total = r["sum_left"] + r["sum_right"]
                for i, child in enumerate(nodes[own].children):
                    below[2 * r["place"] + 1 + i] = child
                    nodes[child].known = local
        taken, unknown = choose(nodes, settings.leaves - 1)
    return nodes, taken, loss


def fit_boosted(
    rows: DataFrame, inputs: Sequence[str], target: str, key: Sequence[str], settings: BoostingSettings = BoostingSettings()
) -> Boosted:
    """Boost trees on ``target``; ``key`` names columns that tell rows apart."""
    edges = bin_edges(rows, inputs, min(settings.bins, BINS))
    table = materialize(
        coded(rows, inputs, edges, True, key=key_of(*key), target=F.col(target).cast("double")), "boosting-rows"
    )
    n = (table.agg(F.sum(F.octet_length("key"))).first()[0] or 0) // 8
    stopping = n > settings.stops_above
    base, kept = _mean_target(table, settings, stopping)
    trainer = _Trainer(table, len(inputs), base, settings, stopping)
    trees: list[Tree] = []
    losses: list[float] = []
    for _ in range(settings.rounds):
        nodes, taken, (error, out) = grow_tree(trainer, kept, settings)
        if stopping:
            losses.append(error / max(out, 1) / 2)
            if _stalled(losses, settings):
                break
        if not taken:
            break  # nothing is left to gain
        trees.append(_as_tree(nodes, taken, settings.step))
        trainer.added(trees[-1])
    return Boosted(tuple(inputs), edges, base, trees, losses)


def _mean_target(table: DataFrame, settings: BoostingSettings, stopping: bool) -> tuple[float, int]:
    """Mean target and number of the rows that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0.0, 0
        for keys, target in unpacked(batches, key=np.int64, target=np.float64):
            values = target[~is_held_out(keys, settings)] if stopping else target
            total, n = total + float(values.sum()), n + len(values)
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([n])], names=["total", "n"])

    found = prepare_workers(table.select("key", "target")).mapInArrow(run, "total double, n bigint").agg(F.sum("total"), F.sum("n")).first()
    return (found[0] / found[1] if found[1] else 0.0), found[1] or 0


def _stalled(losses: Sequence[float], settings: BoostingSettings) -> bool:
    """No loss of the last rounds is below the one before them by more than ``fall``."""
    if len(losses) <= settings.patience:
        return False
    return min(losses[-settings.patience :]) >= losses[-settings.patience - 1] - settings.fall


def boosted_scores(model: Boosted, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` and ``name``, the prediction. The trees have a fixed number of leaves, so every task holds them."""
    inputs, edges, trees, base = model.inputs, model.edges, list(model.trees), model.base
    packed = rows.select(F.struct("*").alias("row"), *[F.col(c).cast("double").alias(f"_in_{i}") for i, c in enumerate(inputs)])
    row = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f"_in_{i}").to_numpy(zero_copy_only=False) for i in range(len(inputs))]
            codes = np.column_stack([codes_of(np.asarray(v, dtype=np.float64), e) for v, e in zip(columns, edges)])
            made = np.full(batch.num_rows, base)
            for tree in trees:
                made += tree.value[descend(codes, tree)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made)], names=["row", "made"])

    return prepare_workers(packed).mapInArrow(run, f"row {row}, made double").select("row.*", F.col("made").alias(name))
