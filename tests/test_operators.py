from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillgrain.operators import ordered
from tillgrain.operators.distinct import extended_dictionary, merged_reach, reach, reach_state, rolled_up
from tillgrain.operators.distinct import totals_with_distinct
from tillgrain.operators.materialize import dropping_intermediates, materialize
from tillgrain.operators.neighbours import with_previous
from tillgrain.session import shared_folder
from tillgrain.sources.paths import exists


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one value."""
    pick = random.Random(7)
    rows = [(f"c{i:04d}", 1 if i % 3 == 0 else pick.randrange(60)) for i in range(503)]
    return spark.createDataFrame(rows, "id string, v int").withColumn(
        "m", F.col("v").cast("decimal(20,2)")
    )


def test_slices_hold_contiguous_parts_of_the_order(spark, values):
    rows = ordered.spread_in_order(values, ["v", "id"]).collect()
    assert len({r["_slice"] for r in rows}) > 1
    rows.sort(key=lambda r: (r["_slice"], r["_position"]))
    keys = [(r["v"], r["id"]) for r in rows]
    assert keys == sorted(keys)


def test_number_rows_equals_a_plain_window(values):
    mine = {r["id"]: r["n"] for r in ordered.number_rows(values, ["v", "id"], "n").collect()}
    plain = values.withColumn("n", F.row_number().over(Window.orderBy("v", "id")))
    assert mine == {r["id"]: r["n"] for r in plain.collect()}


@pytest.mark.parametrize("rows", [1, 3, 6, 503])
def test_tile_scores_equal_ntile(values, rows):
    df = values.orderBy("id").limit(rows)
    scores = ordered.tile_scores(df, {"up": F.col("m"), "down": -F.col("m")}, "id")
    mine = df.withColumns(scores).collect()
    plain = df.withColumns(
        {
            "up": F.ntile(4).over(Window.orderBy("v", "id")),
            "down": F.ntile(4).over(Window.orderBy(F.desc("v"), "id")),
        }
    ).collect()
    assert sorted(mine) == sorted(plain)


def test_tile_sizes_with_remainder(spark):
    df = spark.range(6).select(F.col("id"), F.col("id").cast("decimal(20,2)").alias("m"))
    scored = df.withColumns(ordered.tile_scores(df, {"tile": F.col("m")}, "id"))
    sizes = [scored.filter(F.col("tile") == t).count() for t in (1, 2, 3, 4)]
    assert sizes == [2, 2, 1, 1]


def test_exact_medians(spark):
    rows = [(1.0, 5.0), (4.0, None), (9.0, 2.0), (2.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    found = ordered.exact_medians(df, ["a", "b"])
    assert found == {"a": statistics.median([1, 4, 9, 2]), "b": 2.0}


def test_previous_row_of_groups_over_several_slices(spark):
    pick = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 40}", pick.randrange(1000), i) for i in range(400)]
    rows += [("hot", None, 1000)]
    df = materialize(spark.createDataFrame(rows, "g string, v int, i long"), "test")
    mine = with_previous(df, ["g"], ["i"], "v", "before")
    plain = df.withColumn("before", F.lag("v").over(Window.partitionBy("g").orderBy("i")))
    assert sorted(mine.select("g", "i", "before").collect(), key=str) == sorted(
        plain.select("g", "i", "before").collect(), key=str
    )


def test_previous_row_of_missing_groups_and_without_a_second_shuffle(spark):
    rows = [(None, i * 7, i) for i in range(300)] + [("a", 5, 0)]
    df = spark.createDataFrame(rows, "g string, v int, i long").repartition(4)
    mine = with_previous(df, ["g"], ["i"], "v", "before")
    found = {(r["g"], r["i"]): r["before"] for r in mine.collect()}
    assert found == {("a", 0): None} | {(None, i): (i - 1) * 7 if i else None for i in range(300)}
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    empty = with_previous(df.limit(0), ["g"], ["i"], "v", "before")
    assert empty.columns == ["g", "v", "i", "before"] and empty.count() == 0


def test_intermediates_go_to_the_shared_folder_and_can_be_dropped(spark):
    kept = materialize(spark.range(3), "kept")
    assert shared_folder(spark) in kept.inputFiles()[0]
    with dropping_intermediates(spark):
        path = materialize(spark.range(3), "gone").inputFiles()[0]
        assert exists(spark, path)
    assert not exists(spark, path)
    assert kept.count() == 3


def test_totals_with_distinct_counts_have_no_expand(spark):
    rows = [(i % 7, None if i % 5 == 0 else f"v{i % 11}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string, n long").repartition(4)
    n = F.col("n")
    found = totals_with_distinct(df, {"a": F.col("a"), "b": F.col("b")}, {"total": n}, {"low": n}, {"high": n})
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.first().asDict() == {"_rows": 300, "total": sum(range(300)), "low": 0, "high": 299, "a": 7, "b": 11}
    empty = totals_with_distinct(df.limit(0), {"a": F.col("a")}, {"total": n}).first()
    assert (empty["_rows"], empty["total"], empty["a"]) == (0, None, 0)


def test_stored_reach_takes_in_a_new_period(spark, tmp_path):
    """The state of the first rows and that of the new ones give the counts of all rows."""
    rows = [(f"m{i % 3}" if i % 4 else None, f"c{i * 7919 % 401}" if i % 9 else None) for i in range(4000)]
    old, new = (
        spark.createDataFrame(part, "month string, customer string").repartition(3) for part in (rows[:2500], rows[2300:])
    )
    group, place = ["month"], str(tmp_path)
    first = materialize(extended_dictionary(None, old, "customer"), "dictionary")
    numbers = sorted(r["number"] for r in first.collect())
    assert numbers == list(range(1, len(numbers) + 1))
    reach_state(old, group, "customer", first).write.parquet(f"{place}/state")
    second = materialize(extended_dictionary(first, new, "customer"), "dictionary")
    assert first.exceptAll(second).isEmpty()  # every value keeps its number
    numbers = sorted(r["number"] for r in second.collect())
    assert numbers == list(range(1, len(numbers) + 1))
    stored = spark.read.parquet(f"{place}/state")
    whole = merged_reach([stored, reach_state(new, group, "customer", second)], group)
    found = {r["month"]: r["n"] for r in reach(whole, group, "n").collect()}
    wanted = {}
    for month, customer in rows:
        if customer:
            wanted.setdefault(month, set()).add(customer)
    assert found == {m: len(c) for m, c in wanted.items()}
    everyone = reach(rolled_up(whole, []), [], "n").first()["n"]
    assert everyone == len({c for _, c in rows if c})


def test_bitmaps_span_buckets(spark):
    df = spark.range(70_000).selectExpr("cast(id as string) as v", "1 as g")
    dictionary = materialize(extended_dictionary(None, df, "v"), "dictionary")
    state = reach_state(df, ["g"], "v", dictionary)
    assert state.count() == 3 and reach(state, ["g"], "n").first()["n"] == 70_000
