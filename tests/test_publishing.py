from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillgrain.operators import ordered
from tillgrain.operators.materialize import materialize, recording_intermediates
from tillgrain.plans import customers, dashboard, full_run, orders, quality, reports, snapshots, training
from tillgrain.schemas import CUSTOMER_ANALYTICS, EXPORT_COLUMNS, SOURCE_COLUMNS, TRANSACTIONS
from tillgrain.sources import commits, export, layout, star_schema
from tillgrain.sources.export import export_dataset, validate_export
from tillgrain.sources.raw_lines import load_periods
from tillgrain.sources.tables import read_csv, write_csv, write_table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def dataset(spark):
    lines = [
        (i, f"10{i}", "00001", 'a "mug", red', 1, dt.datetime(2010, 1, i, 9), Decimal(2), f"{i % 3}",
         "A", "P", Decimal(2))
        for i in range(1, 9)
    ]
    transactions = spark.createDataFrame(lines, TRANSACTIONS)
    features = customers.customer_features(transactions)
    scores = [("0", 0, Decimal("0.5"), "Medium", Decimal(3), "m"), ("1", 1, Decimal("0.9"), "High", Decimal(4), "m")]
    analytics = spark.createDataFrame(scores, CUSTOMER_ANALYTICS)
    return dashboard.dashboard_dataset(transactions, features, analytics)


def test_dataset_follows_the_contract_and_keeps_unscored_customers(dataset):
    assert tuple(dataset.columns) == EXPORT_COLUMNS
    assert dashboard.check_integrity(dataset) == {"Transaction": 8, "Customer": 3}
    unscored = dataset.filter("record_id = 'C-2'").first()
    assert unscored["churn_probability"] is None and unscored["country"] == "A"
    assert {r[0]: r[1] for r in dashboard.record_counts(dataset).collect()} == {
        "Transaction": 8, "Customer": 3,
    }


@pytest.mark.parametrize(
    ("column", "value", "message"),
    [
        ("revenue", "if(record_type = 'Customer', 1, revenue)", "transaction measures"),
        ("monetary", "1", "customer measures"),
        ("record_id", "'same'", "duplicate"),
        ("record_type", "'Transaction'", "empty"),
        ("record_type", "'Other'", "unknown"),
    ],
)
def test_integrity_rejects(dataset, column, value, message):
    with pytest.raises(ValueError, match=message):
        dashboard.check_integrity(dataset.withColumn(column, F.expr(value)))


def test_export_is_ordered_and_replaces_the_old_one(spark, dataset, tmp_path):
    target = str(tmp_path / "export")
    write_csv(spark.range(1), target)
    assert export_dataset(dataset, target) == {"Transaction": 8, "Customer": 3}
    ids = []
    for part in sorted(Path(target).glob("part-*.csv")):
        rows = part.read_text().splitlines()
        assert rows[0] == ",".join(EXPORT_COLUMNS)
        ids += [row.split(",")[1] for row in rows[1:]]
    assert ids == ["C-0", "C-1", "C-2", *[f"T-{i}" for i in range(1, 9)]]
    assert [p.name for p in tmp_path.iterdir()] == ["export"]


def test_failed_export_keeps_the_old_one(spark, dataset, tmp_path):
    target = str(tmp_path / "export")
    export_dataset(dataset, target)
    before = sorted(p.name for p in Path(target).iterdir())
    with pytest.raises(ValueError):
        export_dataset(dataset.filter("record_type = 'Customer'"), target)
    assert sorted(p.name for p in Path(target).iterdir()) == before
    with pytest.raises(ValueError, match="expected"):
        validate_export(spark, target, {"Transaction": 9, "Customer": 3})


def test_key_checks(spark):
    left = spark.createDataFrame([("1", "x"), ("2", None)], "id string, a string")
    twice = spark.createDataFrame([("1",), ("1",)], "id string")
    with pytest.raises(ValueError, match="more than one row"):
        quality.joined_one_to_one(left, twice, "id", [], "pair")
    with pytest.raises(ValueError, match="a missing"):
        quality.joined_one_to_one(left, left.select("id"), "id", ["a"], "pair")
    with pytest.raises(ValueError, match="parent"):
        quality.require_reference(left, left.filter("id = '1'"), "id", "child")


SMALL = training.ModelSettings(trees=5, forest_depth=4, boosting_rounds=3, logistic_iterations=50)


def test_full_run_from_raw_csv_to_reports(spark, tmp_path, monkeypatch):
    raw = star_schema.dirty_lines(spark, FOLDER)
    periods = {}
    for period in ("Period A", "Period B"):
        periods[period] = str(tmp_path / "raw" / period)
        part = raw.filter(F.col("source_period") == period).select(*SOURCE_COLUMNS)
        write_csv(part, periods[period])
    out = str(tmp_path / "out")
    options = {
        "country_map": star_schema.COUNTRY_SPELLINGS,
        "snapshot_dates": star_schema.SNAPSHOTS,
        "settings": SMALL,
        "sweep_restarts": 1,
        "final_restarts": 2,
        "clean_csv": True,
    }
    counts = full_run.run(spark, periods, out, **options)

    first = full_run.published(spark, out, "")
    at = lambda name: full_run.published(spark, out, name)
    assert {p.name for p in Path(first).iterdir()} == {
        *full_run.TABLES, *full_run.REPORTS, *full_run.MODELS, full_run.EXPORT, "clean_transactions",
    }
    report = spark.read.json(at("data_quality_report")).first()
    assert report["raw_rows"] == raw.count()
    assert counts["Transaction"] == report["clean_rows"]
    assert counts["Customer"] == report["clean_customers"]
    metadata = spark.read.json(at("model_metadata")).first()
    assert metadata["test_snapshot"] == "2001-03-01"
    assert metadata["validation_snapshot"] == "2000-12-01"
    assert metadata["selected_k"] in range(2, 7)

    found = spark.read.parquet(at("model_metrics"))
    chosen = found.filter("evaluation_split = 'test' AND selected_model")
    assert chosen.count() == found.filter("evaluation_split = 'test'").count() == 8
    assert found.filter("evaluation_split = 'validation'").count() == 10
    assert found.filter("metric = 'roc_auc' AND NOT value BETWEEN 0 AND 1").isEmpty()

    profiles = spark.read.parquet(at("cluster_profiles")).orderBy("rfm_cluster").collect()
    means = [p["avg_monetary"] for p in profiles]
    assert means == sorted(means, reverse=True)
    assert sum(p["customers"] for p in profiles) == counts["Customer"]

    # The published models give the published scores and clusters.
    current = snapshots.current_features(spark.read.parquet(at("transactions")))
    again = full_run.published_models(spark, out)
    features = spark.read.parquet(at("customer_features"))
    models = training.TrainedModels("", again["churn_classifier"], again["customer_value"], found, None, None)
    scored = training.score_customers(current, models, again["rfm_clusters"].assign(features))
    analytics = spark.read.parquet(at("customer_analytics"))
    assert scored.select(*analytics.columns).exceptAll(analytics).isEmpty()
    assert scored.count() == analytics.count()
    reports = full_run.analyst_reports(spark, out)
    assert len(reports) == 10 and all(not df.isEmpty() for df in reports.values())

    full_run.register_views(spark, out)
    rows = spark.sql("SELECT count(*) FROM dashboard_dataset").first()[0]
    assert rows == counts["Transaction"] + counts["Customer"]
    assert spark.sql(
        "SELECT customer_id FROM customer_dashboard WHERE churn_probability IS NULL"
    ).isEmpty()

    # A run that fails half-way leaves the earlier one current and whole.
    before = sorted(p.name for p in Path(out).iterdir())
    rows = spark.read.parquet(at("customer_features")).count()
    with pytest.raises(ValueError, match="three snapshot"):
        full_run.run(spark, periods, out, **{**options, "snapshot_dates": star_schema.SNAPSHOTS[:2]})
    assert sorted(p.name for p in Path(out).iterdir()) == before
    monkeypatch.setattr(full_run.performance, "product_performance", lambda _: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        full_run.run(spark, periods, out, **options)
    assert sorted(p.name for p in Path(out).iterdir()) == before
    assert full_run.published(spark, out, "") == first
    assert spark.read.parquet(at("customer_features")).count() == rows
    with pytest.raises(FileNotFoundError):
        full_run.run(spark, {"x": str(tmp_path / "absent")}, out)


def test_a_line_break_in_a_text_survives_the_export(spark, dataset, tmp_path):
    odd = "a\nb\r\\n \\ \"q\", x"
    changed = dataset.withColumn(
        "description", F.when(F.col("record_type") == "Transaction", F.lit(odd))
    )
    target = str(tmp_path / "odd")
    counts = export_dataset(changed, target)
    back = read_csv(spark, target, changed.select(*EXPORT_COLUMNS).schema)
    assert back.filter(F.col("description") == odd).count() == counts["Transaction"]
    assert back.count() == sum(counts.values())


def test_files_of_one_period_must_share_their_header(spark, tmp_path):
    folder = tmp_path / "period"
    folder.mkdir()
    names = list(SOURCE_COLUMNS)
    row = dict(zip(names, ["1", "85123A", "x", "3", "2010-01-01 10:00:00", "7", "5", "France"]))
    for i, order in enumerate((names, [*names[:3], "Price", "InvoiceDate", "Quantity", *names[6:]])):
        (folder / f"{i}.csv").write_text(",".join(order) + "\n" + ",".join(row[n] for n in order) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_periods(spark, {"p": str(folder)}).collect()


def test_commits_of_two_runs_at_once_are_both_in_the_log(spark, tmp_path):
    base = str(tmp_path / "out")
    assert commits.latest(spark, base) is None and commits.versions(spark, base) == []
    seen = commits.commit(spark, base, "run-a", 0).version
    # Both looked at version 1; the second is refused, or follows.
    assert commits.commit(spark, base, "run-b", seen).version == 2
    with pytest.raises(commits.CommitRefused, match="run-b"):
        commits.commit(spark, base, "run-c", seen, retry=False)
    assert commits.commit(spark, base, "run-c", seen).version == 3
    assert commits.latest(spark, base).run == "run-c"
    assert [(r["version"], r["run"]) for r in commits.history(spark, base).orderBy("version").collect()] == [
        (1, "run-a"), (2, "run-b"), (3, "run-c"),
    ]


def test_many_writers_get_a_version_each(spark, tmp_path):
    base = str(tmp_path / "out")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: commits.commit(spark, base, f"run-{i}", 0), range(24)))
    assert sorted(c.version for c in made) == list(range(1, 25))
    found = commits.history(spark, base).collect()
    assert {r["run"] for r in found} == {f"run-{i}" for i in range(24)}
    assert not [n for n in (tmp_path / "out" / commits.LOG).iterdir() if n.name.endswith(".new")]


def test_a_run_leaves_the_folders_of_others_alone(spark, tmp_path, monkeypatch):
    """A run that another one overtakes is published after it; folders not in the log stay."""
    base = tmp_path / "out"

    def build(_spark, _raw, staging, *_):
        Path(staging).mkdir(parents=True)
        if len(list(base.glob("run-*"))) == 1:  # while the first run builds, a second one ends
            full_run.run(spark, {}, str(base))
        return None

    monkeypatch.setattr(full_run, "load_periods", lambda *_: None)
    monkeypatch.setattr(full_run, "_build", build)
    monkeypatch.setattr(full_run, "export_dataset", lambda *_: {})
    (base / "run-unfinished").mkdir(parents=True)
    (base / "run-unfinished").rename(base / "elsewhere-unfinished")
    full_run.run(spark, {}, str(base))
    assert commits.versions(spark, str(base)) == [1, 2]
    assert len(list(base.glob("run-*"))) == 2 and (base / "elsewhere-unfinished").exists()
    full_run.run(spark, {}, str(base))
    kept = {commits.commit_at(spark, str(base), v).run for v in (2, 3)}
    assert {p.name for p in base.glob("run-*")} == kept


def test_checks_are_counted_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else "x") for i in range(1000)], "n int, t string")
    rules = {"t missing": F.col("t").isNotNull(), "n above 900": F.col("n") <= 900}
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "one job")
    written, found = quality.observed_write(df, str(tmp_path / "a"), rules)
    assert len(jobs.getJobIdsForGroup("observed")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == quality.violations(written, rules) == {"rows": 1000, "t missing": 100, "n above 900": 99}
    with pytest.raises(ValueError, match="a breaks"):
        quality.written_checked(df, str(tmp_path / "b"), rules, "a")
    with pytest.raises(ValueError, match="a is empty"):
        quality.written_checked(df.limit(0), str(tmp_path / "c"), rules, "a")
    assert quality.written_checked(df, str(tmp_path / "d"), {"n": F.col("n") >= 0}, "a").count() == 1000


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_customers_join_without_an_exchange(spark, tmp_path):
    rows = [(f"c{i}", i) for i in range(500)]
    names = [f.name for f in CUSTOMER_ANALYTICS]
    features = spark.createDataFrame(rows, "customer_id string, monetary int").withColumns(
        {c: F.lit("x") for c in ("primary_country", "rfm_segment")} | {c: F.lit(1) for c in ("recency_days", "frequency")}
    )
    scores = spark.createDataFrame(rows, "customer_id string, n int").select(
        "customer_id", *[F.lit("High").alias(c) for c in names if c != "customer_id"]
    )
    one = layout.write_bucketed(features, str(tmp_path / "features"), "customer_id", 4)
    two = layout.write_bucketed(scores, str(tmp_path / "scores"), "customer_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(reports.retention_targets(one, two))
        assert "SortMergeJoin" in plan and "hashpartitioning(customer_id" not in plan
        plain = plan_of(reports.retention_targets(features, scores))
        assert "hashpartitioning(customer_id" in plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert one.exceptAll(features).isEmpty() and one.count() == 500
    # Another session knows the buckets from the note beside the files.
    spark.sql(f"DROP TABLE {layout._catalog_name(str(tmp_path / 'features'))}")
    again = layout.read_bucketed(spark, str(tmp_path / "features"))
    assert again.count() == 500 and layout.is_bucketed(spark, str(tmp_path / "features"))
    assert not layout.is_bucketed(spark, str(tmp_path))


def test_snapshots_read_the_months_of_their_windows_only(spark, tmp_path):
    lines = star_schema.clean_lines(spark, FOLDER)
    path = str(tmp_path / "lines")
    stored = write_table(layout.with_month(lines), path, layout.MONTH)
    dates = star_schema.SNAPSHOTS[1:3]
    sequence = materialize(orders.sequenced(orders.invoice_totals(lines)), "sequence")
    found = snapshots.snapshot_dataset(stored, dates, sequenced_invoices=sequence)
    assert sorted(found.collect()) == sorted(snapshots.snapshot_dataset(lines, dates, sequenced_invoices=sequence).collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(invoice_month" in plan
    months = layout.within_months(stored, dates[0] - dt.timedelta(180), dates[-1])
    read = {Path(r[0]).parent.name for r in months.select(F.input_file_name()).distinct().collect()}
    whole = {p.name for p in Path(path).glob("invoice_month=*")}
    first, last = (dates[0] - dt.timedelta(180)).replace(day=1), dates[-1]
    assert read == {n for n in whole if str(first) <= n.split("=")[1] <= str(last)} and len(read) < len(whole) / 4
    current = snapshots.current_features(stored, sequenced_invoices=sequence)
    assert sorted(current.collect(), key=str) == sorted(
        snapshots.current_features(lines, sequenced_invoices=sequence).collect(), key=str
    )


def test_the_exported_dataset_is_not_stored_before_the_export(spark):
    with recording_intermediates() as written:
        found = entry.queries()["export_rows"](spark, "/root/testdata/sf0.001")
        assert found.count() > 0
    assert not [p for p in written if "/dataset-" in p]


@pytest.mark.parametrize("most_files,records", [(256, 0), (256, 7), (2, 0)])
def test_numbered_rows_lie_in_order_without_a_second_sort(spark, monkeypatch, most_files, records):
    monkeypatch.setattr(ordered, "MOST_FILES", most_files)
    rows = spark.range(100).select((F.col("id") * 37 % 100).alias("id"), (F.col("id") % 7).alias("v")).repartition(3)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", records)
    try:
        found = ordered.number_rows_in_order(rows, ["v", "id"], "n")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert [tuple(r) for r in found.select("v", "id", "n").collect()] == [
        (v, i, n) for n, (v, i) in enumerate(sorted((r["v"], r["id"]) for r in rows.collect()), 1)
    ]
    assert ("Exchange" in found._jdf.queryExecution().executedPlan().toString()) == (most_files == 2)
    assert ordered.number_rows_in_order(rows.filter("id < 0"), ["v", "id"], "n").collect() == []


def test_the_registered_export_sorts_lines_once_and_lies_in_order(spark, monkeypatch):
    found = {}

    def written(rows, path):
        found["plan"] = rows._jdf.queryExecution().executedPlan().toString()
        write_csv(rows, path)
        found["ids"] = [
            row.split(",")[1] for part in sorted(Path(path).glob("part-*.csv")) for row in part.read_text().splitlines()[1:]
        ]

    monkeypatch.setattr(export, "write_csv", written)
    entry.queries()["export_rows"](spark, "/root/testdata/sf0.001")
    customers = [i for i in found["ids"] if i.startswith("C-")]
    lines = len(found["ids"]) - len(customers)
    assert customers == sorted(customers) and lines > 1000
    assert found["ids"] == [*customers, *[f"T-{i}" for i in range(1, lines + 1)]]
    assert not [x for x in found["plan"].splitlines() if "rangepartitioning" in x and "transaction_id" in x]


def test_lines_stored_for_customers_lack_what_these_do_not_read(spark):
    with recording_intermediates() as written:
        entry.queries()["churn_distribution"](spark, "/root/testdata/sf0.001").collect()
    stored = [p for p in written if "lines-" in p]
    assert len(stored) == 1 and "description" not in spark.read.parquet(stored[0]).columns
