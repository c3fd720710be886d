"""Models against plain versions: k-means, silhouette, logistic regression, forest and boosting."""

from __future__ import annotations

import dataclasses
import heapq
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillgrain.operators import binning, boosting, forest, lloyd, materialize, newton
from tillgrain.plans import clusters, training
from tillgrain.sources import star_schema

XYZ = ("x", "y", "z")


def points_of(spark, n=400, seed=1):
    pick = np.random.default_rng(seed)
    rows = np.concatenate([pick.normal(c, 0.4, (n // 4, 3)) for c in (-3, 0, 3, 6)])
    return rows, spark.createDataFrame(rows.tolist(), ", ".join(f"{c} double" for c in XYZ)).repartition(3)


# --- k-means ---------------------------------------------------------------------------------


def plain_pass(rows, centres):
    far = np.square(rows[:, None] - centres).sum(axis=2)
    label = far.argmin(axis=1)
    moved = np.array([rows[label == i].mean(axis=0) if (label == i).any() else c for i, c in enumerate(centres)])
    return moved, label, far.min(axis=1).sum()


def test_all_starts_move_as_each_alone(spark):
    rows, df = points_of(spark)
    starts = [lloyd.spread_centres(rows[:100], k, (5, k)) for k in (1, 2, 3, 4, 4)]
    starts[4] = np.concatenate([starts[4][:3], [[99.0, 99, 99]]])  # a centre without rows stays
    found = lloyd.lloyd_steps(df, XYZ, starts, 3)
    for start, got in zip(starts, found):
        wanted = start
        for _ in range(3):
            wanted, label, _ = plain_pass(rows, wanted)
        assert np.allclose(got, wanted)
        assert lloyd.costs(df, XYZ, [got])[0] == pytest.approx(plain_pass(rows, got)[2])


def test_starts_settle_and_drop_out(spark):
    rows, df = points_of(spark)
    starts = [lloyd.spread_centres(rows, 4, (i,)) for i in range(5)] + [rows[:4].copy()]
    found = lloyd.settled_centres(df, XYZ, starts, 1e-9, 100)
    for centres in found:
        assert np.allclose(plain_pass(rows, centres)[0], centres, atol=1e-4)
    # Four clear groups: the best of the starts finds them.
    assert min(lloyd.costs(df, XYZ, found)) == pytest.approx(
        sum(((rows[i : i + 100] - rows[i : i + 100].mean(axis=0)) ** 2).sum() for i in range(0, 400, 100))
    )
    number = df.withColumn("k", lloyd.nearest_centre(XYZ, found[0]))
    assert sorted(r["count"] for r in number.groupBy("k").count().collect()) == sorted(
        np.bincount(plain_pass(rows, found[0])[1]).tolist()
    )


def test_silhouette(spark):
    rows, df = points_of(spark, 120)
    labelled = df.withColumns({
        "two": (F.col("x") > 1).cast("int") * 7, "one": F.lit(3),
        "lonely": F.when(F.col("x") == float(rows[0, 0]), 0).when(F.col("x") > 1, 1).otherwise(2),
    })
    found = {r["labelling"]: r["silhouette"] for r in lloyd.silhouettes(labelled, XYZ, ["two", "one", "lonely"]).collect()}
    far = np.sqrt(np.square(rows[:, None] - rows).sum(axis=2))
    for name, label in (("two", (rows[:, 0] > 1) * 1), ("lonely", np.where(np.arange(120) == 0, 0, np.where(rows[:, 0] > 1, 1, 2)))):
        scores = []
        for i in range(len(rows)):
            own = label == label[i]
            if own.sum() == 1:
                scores.append(0.0)
                continue
            a = far[i][own].sum() / (own.sum() - 1)
            b = min(far[i][label == other].mean() for other in set(label.tolist()) - {label[i]})
            scores.append((b - a) / max(a, b))
        assert found[name] == pytest.approx(np.mean(scores))
    assert found["one"] is None


def test_clustering_keeps_the_best_restart_and_numbers_by_revenue(spark):
    pick = np.random.default_rng(3)
    rows = [(f"c{i}", int(r), int(f), float(m)) for i, (r, f, m) in enumerate(
        [*zip(pick.integers(1, 9, 60), pick.integers(20, 30, 60), pick.normal(9000, 50, 60)),
         *zip(pick.integers(200, 400, 90), pick.integers(1, 3, 90), pick.normal(40, 3, 90))]
    )]
    df = spark.createDataFrame(rows, "customer_id string, recency_days int, frequency int, monetary double")
    found = clusters.fit_rfm_clusters(df, range(2, 5), 3, 5)
    assert found.selected_k == 2 and set(found.silhouettes) == {2, 3, 4}
    sizes = {r["rfm_cluster"]: r["customers"] for r in found.profiles.collect()}
    assert sizes == {0: 60, 1: 90}
    again = clusters.ClusterModel.read(found.model.table(spark))
    assert again.assign(df).exceptAll(found.assigned).isEmpty()


# --- Logistic regression -----------------------------------------------------------------------


def test_newton_equals_the_library(spark):
    pick = np.random.default_rng(2)
    x = pick.normal(size=(600, 3)) * [1, 20, 0.1] + [0, 5, 3]
    y = (pick.random(600) < 1 / (1 + np.exp(-(x @ [1.0, -0.05, 4] - 11.5)))).astype(int)
    rows = [(*map(float, a), int(b), 2.0 if b else 0.5) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "x double, y double, z double, label int, weight double")
    found = newton.fit_logistic(df, XYZ, "label", "weight")
    scaled = df.select(
        *[((F.col(c) - m) / d).alias(c) for c, m, d in zip(XYZ, found.means, found.deviations)], "label", "weight"
    )
    total = sum(r[4] for r in rows)
    library = LogisticRegression(
        labelCol="label", weightCol="weight", featuresCol="v", regParam=1.0 / total, tol=1e-12, maxIter=500, standardization=False
    ).fit(VectorAssembler(inputCols=list(XYZ), outputCol="v").transform(scaled))
    assert np.allclose(found.coefficients, library.coefficients.toArray(), atol=1e-6)
    assert found.intercept == pytest.approx(library.intercept, abs=1e-6)
    p = df.select(found.probability().alias("p")).first()["p"]
    margin = found.intercept + sum(c * (v - m) / d for c, v, m, d in zip(found.coefficients, rows[0], found.means, found.deviations))
    assert p == pytest.approx(1 / (1 + np.exp(-margin)))


def test_newton_on_separable_rows_and_constant_inputs(spark):
    rows = [(float(i), 1.0, 0.0, int(i > 10), 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "x double, y double, z double, label int, weight double")
    found = newton.fit_logistic(df, XYZ, "label", "weight")
    assert found.coefficients[0] > 1 and abs(found.coefficients[1]) < 1e-9
    assert found.deviations[1] == 0.0


# --- Trees -------------------------------------------------------------------------------------

INPUTS = ("a", "b", "c", "d")


def table_of(spark, n, seed=0, missing=0.0):
    pick = np.random.default_rng(seed)
    x = np.column_stack([pick.normal(size=n), pick.integers(0, 6, n), pick.exponential(size=n), np.full(n, 2.0)])
    noise = pick.normal(size=n) * 0.3
    target = np.sin(2 * x[:, 0]) + 0.5 * (x[:, 1] > 2) * x[:, 2] + noise
    x[pick.random((n, 4)) < missing] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t), int(t > 0.3)) for i, (r, t) in enumerate(zip(x, target))]
    ddl = "id bigint, a double, b double, c double, d double, target double, label int"
    return rows, spark.createDataFrame(rows, ddl).repartition(3)


def plain_codes(spark, df, edges):
    table = binning.coded(df, INPUTS, edges, key=binning.key_of("id"), id=F.col("id")).orderBy("id").collect()
    return np.array([r["key"] for r in table]), np.array([list(r["codes"]) for r in table], dtype=np.uint8)


def plain_tree(codes, labels, weight, hash_, settings, depth=0):
    """A tree as nested tuples, grown node by node."""
    share = weight[labels == 1].sum() / weight.sum()
    if not 1e-12 < share < 1 - 1e-12 or len(codes) < 2 * settings.leaf_rows or depth == settings.depth:
        return share
    order = forest.input_order(np.array([hash_], dtype=np.uint64), codes.shape[1])[0]
    varying = [f for f in order if len(set(codes[:, f].tolist())) > 1][: settings.tried_inputs]
    best = None
    for f in varying:
        for cut in sorted(set(codes[:, f].tolist()))[:-1]:
            left = codes[:, f] <= cut
            if min(left.sum(), (~left).sum()) < settings.leaf_rows:
                continue
            gain = 0.0
            for side in (left, ~left):
                w, one = weight[side].sum(), weight[side & (labels == 1)].sum()
                gain += (one**2 + (w - one) ** 2) / w
            if best is None or gain > best[0] * (1 + forest.EQUAL):
                best = (gain, f, cut, left)
    if best is None:
        return share
    _, f, cut, left = best
    sides = [
        plain_tree(codes[s], labels[s], weight[s], forest.child_hash(hash_, i), settings, depth + 1)
        for i, s in enumerate((left, ~left))
    ]
    return (int(f), int(cut), *sides)


def plain_score(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("local_rows,depth", [(10_000, None), (60, None), (25, 4)])
def test_forest_equals_the_plain_one(spark, local_rows, depth):
    """With few rows to a task the upper levels come from histograms, and nothing changes."""
    rows, df = table_of(spark, 500)
    settings = forest.ForestSettings(trees=6, leaf_rows=5, bins=40, seed=3, local_rows=local_rows, depth=depth)
    found = forest.fit_forest(df, INPUTS, "label", ["id"], settings)
    keys, codes = plain_codes(spark, df, found.edges)
    labels, scores = np.array([r[6] for r in rows]), np.zeros(len(rows))
    for tree in range(settings.trees):
        counts = forest.counts_of(keys, settings.seed, tree).astype(float)
        each = [counts.sum() / (2 * counts[labels == c].sum()) for c in (0, 1)]
        kept = counts > 0
        weight = counts * np.where(labels == 1, each[1], each[0])
        plain = plain_tree(codes[kept], labels[kept], weight[kept], forest.root_hash(settings.seed, tree), settings)
        scores += [plain_score(plain, r) for r in codes]
    got = {r["id"]: r["p"] for r in forest.forest_scores(found, df, "p").collect()}
    assert len(got) == len(rows)
    # Equal gains may be told apart by rounding, so a few rows may fall elsewhere.
    off = sum(abs(got[i] - s / settings.trees) > 1e-9 for i, s in enumerate(scores))
    assert off <= 0.02 * len(rows)


def test_cuts_of_large_nodes_equal_those_by_sorting():
    pick = np.random.default_rng(9)
    sizes = np.array([700, 3, 1200, 40])
    node, starts = np.repeat(np.arange(4), sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    here = pick.integers(0, 60, (sizes.sum(), 3)).astype(np.uint8)
    here[node == 3, 1] = 7  # nothing to cut
    w = pick.integers(1, 4, sizes.sum()) * 0.5
    one = w * pick.integers(0, 2, sizes.sum())
    whole, ones = np.add.reduceat(w, starts), np.add.reduceat(one, starts)
    for tried in ([0, 1, 2, 1], [2, -1, 0, 0]):
        given = (here, np.array(tried), node, starts, sizes, w, one, whole, ones, 5)
        gain, at = forest._best_cuts_of_large(*given)
        wanted, places = forest._best_cuts(*given)
        found = np.isfinite(wanted)
        assert np.array_equal(found, np.isfinite(gain)) and np.array_equal(at[found], places[found])
        assert np.allclose(gain[found], wanted[found])


def scores_of(tree, codes):
    return tree[3][forest.descend(codes, *tree[:3])]


def test_nodes_split_alone_and_in_groups_give_one_tree(monkeypatch):
    pick = np.random.default_rng(11)
    codes = pick.integers(0, 50, (900, 4)).astype(np.uint8)
    labels = ((codes[:, 0] > 20) ^ (pick.random(900) < 0.2)).astype(np.uint8)
    counts = forest.counts_of(pick.integers(1, 2**62, 900), 42, 3)
    codes, labels, counts = (x[counts > 0] for x in (codes, labels, counts))
    given = (codes, labels, counts, (1.5, 0.75), forest.root_hash(42, 3))
    for depth in (None, 4):
        settings = forest.ForestSettings(leaf_rows=3, depth=depth)
        plain = plain_tree(codes, labels, counts * np.where(labels == 1, 0.75, 1.5), given[-1], settings)
        wanted = np.array([plain_score(plain, r) for r in codes])
        for rows in (10, 100, 10_000):
            monkeypatch.setattr(forest, "GROUP_ROWS", rows)
            found = forest.grow(*given, settings)
            # Equal gains may be told apart by rounding.
            assert (np.abs(scores_of(found, codes) - wanted) > 1e-9).mean() < 0.02


def test_large_nodes_are_dealt_to_more_tasks_than_cores(spark):
    _, df = table_of(spark, 400, seed=12)
    found = forest.fit_forest(df, INPUTS, "label", ["id"], forest.ForestSettings(trees=60))
    assert len(found.grown.inputFiles()) > 8  # of four shuffle partitions


@pytest.mark.parametrize("local_rows", [10_000, 60])
def test_scores_do_not_depend_on_the_bundles(spark, monkeypatch, local_rows):
    _, df = table_of(spark, 300, seed=13)
    found = forest.fit_forest(df, INPUTS, "label", ["id"], forest.ForestSettings(trees=8, local_rows=local_rows))
    wanted = None
    for least, slices_of in ((1, 10**6), (4, 10**6), (10**6, 10**6), (10**6, 100)):
        monkeypatch.setattr(forest, "LEAST_BUNDLES", least)
        monkeypatch.setattr(forest, "LOCAL_ROWS", slices_of)
        scores = {r["id"]: r["p"] for r in forest.forest_scores(found, df, "p").collect()}
        wanted = wanted or scores
        assert len(scores) == 300 and all(abs(scores[i] - v) < 1e-12 for i, v in wanted.items())


def test_packed_rows_come_back_whole(spark):
    rows, df = table_of(spark, 300, seed=10, missing=0.2)
    edges = binning.bin_edges(df, INPUTS, 20)
    plain = {r["id"]: r["codes"] for r in binning.coded(df, INPUTS, edges, id=F.col("id")).collect()}
    packed = binning.coded(df, INPUTS, edges, True, id=F.col("id")).toArrow().to_batches()
    found = {}
    for ids, codes in binning.unpacked(iter(packed), id=np.int64, codes=np.uint8):
        found |= {i: c.tobytes() for i, c in zip(ids.tolist(), codes.reshape(-1, len(INPUTS)))}
    assert len(found) == len(rows) and found == {i: bytes(c) for i, c in plain.items()}
    empty = binning.coded(df.filter("id < 0"), INPUTS, edges, True, id=F.col("id"))
    assert empty.isEmpty()


def test_forest_learns_and_counts_are_poisson(spark):
    rows, df = table_of(spark, 1500, seed=4)
    found = forest.fit_forest(df, INPUTS, "label", ["id"], forest.ForestSettings(trees=25))
    _, fresh = table_of(spark, 600, seed=5)
    scored = forest.forest_scores(found, fresh.withColumn("codes", F.lit("clash")), "p")
    right = scored.filter((F.col("p") >= 0.5).cast("int") == F.col("label")).count()
    assert right > 0.8 * 600 and "codes" in scored.columns
    counts = forest.counts_of(np.random.default_rng(1).integers(-(2**62), 2**62, 40_000), 42, 7)
    assert abs(counts.mean() - 1) < 0.02 and abs(counts.var() - 1) < 0.04


def plain_boosted_tree(codes, residual, settings):
    """Leaf-wise tree by trying every cut of every leaf; returns the prediction of all rows."""
    width = codes.shape[1]

    def best(rows):
        found, total, n = None, residual[rows].sum(), len(rows)
        for f in range(width):
            code = codes[rows, f]
            for missing_left in ((False, True) if (code == 255).any() else (False,)):
                for cut in range(255):
                    left = np.where(code == 255, missing_left, code <= cut)
                    a, b = left.sum(), n - left.sum()
                    if min(a, b) < settings.leaf_rows:
                        continue
                    s = residual[rows][left].sum()
                    gain = s * s / a + (total - s) ** 2 / b - total * total / n
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, rows[left], rows[~left])
        return found

    leaves, queue, order = {0: np.arange(len(codes))}, [], 0
    if (split := best(leaves[0])) is not None:
        heapq.heappush(queue, (-split[0], 0, split[1], split[2]))
    while queue and len(leaves) < settings.leaves:
        _, node, left, right = heapq.heappop(queue)
        del leaves[node]
        for part in (left, right):
            order += 1
            leaves[order] = part
            if (split := best(part)) is not None:
                heapq.heappush(queue, (-split[0], order, split[1], split[2]))
    out = np.zeros(len(codes))
    for rows in leaves.values():
        out[rows] = settings.step * residual[rows].mean()
    return out


@pytest.mark.parametrize("local_rows", [10_000, 90])
def test_boosting_equals_the_plain_one(spark, local_rows):
    rows, df = table_of(spark, 300, seed=6, missing=0.1)
    settings = boosting.BoostingSettings(rounds=3, step=0.3, leaves=7, leaf_rows=15, bins=20, local_rows=local_rows, stored_every=2)
    found = boosting.fit_boosted(df, INPUTS, "target", ["id"], settings)
    _, codes = plain_codes(spark, df, found.edges)
    target = np.array([r[5] for r in rows])
    made = np.full(len(rows), target.mean())
    for _ in range(settings.rounds):
        made += plain_boosted_tree(codes, target - made, settings)
    got = {r["id"]: r["p"] for r in boosting.boosted_scores(found, df, "p").collect()}
    assert len(found.trees) == 3 and all((t.feature >= 0).sum() <= 6 for t in found.trees)
    assert np.allclose([got[i] for i in range(len(rows))], made)


def test_boosting_keeps_one_table_of_predictions(spark):
    _, df = table_of(spark, 200, seed=14)
    folder = Path(materialize.intermediates(spark))
    before = set(folder.glob("boosted-rows-*"))
    boosting.fit_boosted(df, INPUTS, "target", ["id"], boosting.BoostingSettings(rounds=6, leaf_rows=10, stored_every=2))
    assert len(set(folder.glob("boosted-rows-*")) - before) == 1


def test_boosting_stops_when_the_held_out_loss_no_longer_falls(spark):
    _, df = table_of(spark, 1200, seed=7)
    settings = boosting.BoostingSettings(rounds=60, step=0.5, leaves=8, stops_above=1000, patience=4)
    found = boosting.fit_boosted(df, INPUTS, "target", ["id"], settings)
    losses = found.losses
    assert len(found.trees) < 60 and losses[-1] < losses[0]
    assert min(losses[-4:]) >= losses[-5] - settings.fall
    longer = boosting.fit_boosted(df, INPUTS, "target", ["id"], dataclasses.replace(settings, rounds=3))
    assert longer.losses == pytest.approx(losses[:3]) and len(longer.trees) == 3
    constant = df.withColumn("target", F.lit(2.0))
    assert boosting.fit_boosted(constant, INPUTS, "target", ["id"], settings).trees == []


def test_value_model_is_read_back(spark, tmp_path):
    pick = np.random.default_rng(8)
    rows = [(star_schema.SNAPSHOTS[0], f"c{i}", *map(float, pick.exponential(size=8)), float(pick.exponential())) for i in range(200)]
    names = ", ".join(f"{c} double" for c in training.FEATURES)
    df = spark.createDataFrame(rows, f"snapshot_date date, customer_id string, {names}, future_revenue double")
    settings = training.ModelSettings(boosting_rounds=3)
    model = training.fit_value_model(df, {"avg_days_between_orders": 1.0}, settings)
    model.write(spark, str(tmp_path / "value"))
    again = training.ValueModel.read(spark, str(tmp_path / "value"))
    assert again.scores(df).exceptAll(model.scores(df)).isEmpty()
