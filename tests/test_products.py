from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillgrain.functions.exact import percent
from tillgrain.functions.labels import churn_status, rfm_segment, risk_band
from tillgrain.plans import customers, orders, performance, reports, scoring, snapshots
from tillgrain.plans.metrics import classifier_metrics, regression_metrics
from tillgrain.schemas import TRANSACTIONS


def tx(spark, *rows):
    """Rows of (customer, invoice, moment, product, country, revenue)."""
    full = [
        (i, inv, sku, "thing", 1, dt.datetime.fromisoformat(at), Decimal(rev), cust, land, "A", Decimal(rev))
        for i, (cust, inv, at, sku, land, rev) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(full, TRANSACTIONS)


def test_an_order_is_dated_by_its_first_line_and_votes_for_a_country(spark):
    history = orders.order_history(
        tx(
            spark,
            ("1", "10", "2010-01-05 23:00", "00001", "B", "1.005"),
            ("1", "10", "2010-01-05 10:00", "00002", "A", "1.000"),
            ("1", "10", "2010-01-05 11:00", "00002", "B", "1.000"),
            ("1", "10", "2010-01-05 12:00", "00003", "A", "1.000"),
        )
    ).first()
    assert history["order_timestamp"] == dt.datetime(2010, 1, 5, 10)
    assert history["country"] == "A"
    assert history["unique_products"] == 3
    assert history["order_revenue"] == Decimal("4.01")
    assert history["previous_order_date"] is None


def gap_lines(spark):
    return tx(
        spark,
        ("1", "10", "2010-01-01 23:00", "00001", "A", "5"),
        ("1", "11", "2010-01-03 01:00", "00001", "A", "7"),
        ("2", "12", "2010-01-02 01:00", "00001", "A", "9"),
    )


def test_gaps_are_calendar_days_in_history_and_elapsed_days_in_features(spark):
    lines = gap_lines(spark)
    history = {r["invoice_no"]: r for r in orders.order_history(lines).collect()}
    assert history["11"]["days_since_previous_order"] == 2
    found = {r["customer_id"]: r for r in snapshots.current_features(lines).collect()}
    assert found["1"]["avg_days_between_orders"] == 1.0
    assert found["2"]["avg_days_between_orders"] is None


def test_single_order_customer_and_meaning_of_recency_and_tenure(spark):
    lines = gap_lines(spark)
    lifetime = {r["customer_id"]: r for r in customers.customer_features(lines).collect()}
    assert lifetime["2"]["avg_days_between_orders"] is None
    assert lifetime["2"]["tenure_days"] == 0 and lifetime["2"]["recency_days"] == 1
    assert lifetime["1"]["avg_days_between_orders"] == Decimal("2.00")
    current = {r["customer_id"]: r for r in snapshots.current_features(lines).collect()}
    assert current["2"]["recency_days"] == 2 and current["2"]["tenure_days"] == 2


def test_split_customers_get_the_same_history(spark):
    lines = tx(
        spark,
        *[
            ("big" if i % 3 else f"s{i % 7}", str(i), f"2010-01-{1 + i % 28:02d} 10:00", "00001", "A", "1")
            for i in range(200)
        ],
    )
    plain = orders.order_history(lines).collect()
    split = orders.order_history(lines).collect()
    assert sorted(split, key=str) == sorted(plain, key=str)


def test_segments_statuses_and_bands(spark):
    scores = [(4, 3, 3), (4, 3, 2), (4, 2, 4), (2, 4, 3), (1, 4, 2), (3, 1, 1)]
    df = spark.createDataFrame(scores, "r int, f int, m int")
    found = [r[0] for r in df.select(rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert found == [
        "Champions", "Loyal Customers", "New / Potential", "High-Value At Risk", "At Risk",
        "Regular Customers",
    ]
    days = spark.createDataFrame([(91,), (90,), (61,), (60,)], "d int")
    assert [r[0] for r in days.select(churn_status(F.col("d"))).collect()] == [
        "High Risk", "Watchlist", "Watchlist", "Active",
    ]
    ps = spark.createDataFrame([(0.40,), (0.400001,), (0.70,), (0.700001,)], "p double")
    assert [r[0] for r in ps.select(risk_band(F.col("p"))).collect()] == ["Low", "Medium", "Medium", "High"]


def test_invoices_meet_in_one_shuffle_and_customers_need_no_expand(spark):
    lines = gap_lines(spark)
    totals = orders.invoice_totals(lines)
    assert totals._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    measures = customers.lifetime_measures(lines, totals)
    assert "Expand" not in measures._jdf.queryExecution().optimizedPlan().toString()


def test_snapshot_window_edges(spark):
    s = dt.date(2010, 9, 1)
    start, end = s - dt.timedelta(180), s + dt.timedelta(90)
    lines = tx(
        spark,
        ("1", "10", f"{start} 00:00", "00001", "A", "5"),
        ("1", "11", f"{start - dt.timedelta(1)} 23:59", "00002", "A", "50"),
        ("1", "12", f"{s} 00:00", "00003", "A", "7"),
        ("1", "13", f"{end} 00:00", "00004", "A", "500"),
        ("2", "14", f"{s - dt.timedelta(1)} 12:00", "00004", "A", "3"),
        ("3", "15", f"{s} 12:00", "00004", "A", "3"),
    )
    rows = {r["customer_id"]: r for r in snapshots.snapshot_dataset(lines, [s]).collect()}
    assert set(rows) == {"1", "2"}
    one = rows["1"]
    assert (one["frequency"], one["monetary"], one["unique_products"]) == (1, Decimal("5"), 1)
    assert (one["future_orders"], one["future_revenue"], one["churn"]) == (1, Decimal("7"), 0)
    assert one["avg_days_between_orders"] is None
    assert one["recency_days"] == 180 and one["tenure_days"] == 181
    assert rows["2"]["churn"] == 1 and rows["2"]["future_revenue"] == 0


def test_snapshots_must_not_overlap_their_outcomes(spark):
    with pytest.raises(ValueError, match="closer"):
        snapshots.check_spacing([dt.date(2001, 2, 1), dt.date(2001, 5, 1)], 90)


def test_inactive_customers_follow_the_rule(spark):
    lines = tx(
        spark,
        ("old", "10", "2010-01-01 10:00", "00001", "A", "5"),
        ("new", "11", "2010-07-20 10:00", "00001", "A", "5"),
    )
    current = snapshots.current_features(lines).withColumn("rfm_cluster", F.lit(0))
    scored = scoring.customer_analytics(current, F.lit(0.40004), F.lit(-3.0))
    rows = {r["customer_id"]: r for r in scored.collect()}
    old, new = rows["old"], rows["new"]
    assert (old["churn_probability"], old["predicted_90d_value"]) == (Decimal("0.99"), 0)
    assert old["churn_risk_band"] == "High"
    assert old["churn_score_method"] == "Rule: no purchase in observation window"
    assert new["churn_probability"] == Decimal("0.4") and new["churn_risk_band"] == "Medium"
    assert new["predicted_90d_value"] == 0
    assert new["churn_score_method"] == "Selected classification model"


def test_growth_compares_with_the_previous_month_that_has_sales(spark):
    lines = tx(
        spark,
        ("1", "10", "2010-01-05 10:00", "00001", "A", "8"),
        ("1", "11", "2010-03-05 10:00", "00001", "A", "6"),
    )
    january, march = reports.month_growth(lines).collect()
    assert january["month_over_month_growth_pct"] is None
    assert march["previous_month_revenue"] == 8
    assert march["month_over_month_growth_pct"] == Decimal("-25.00")


def test_percent_rounds_exact_ties_away_from_zero(spark):
    df = spark.createDataFrame([(1, 800), (-1, 800), (1, 3), (5, 0)], "a long, b long")
    found = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert found == [Decimal("0.13"), Decimal("-0.13"), Decimal("33.33"), None]


def pareto_of(spark, amounts):
    rows = [(f"c{i:03d}", Decimal(a)) for i, a in enumerate(amounts)]
    return reports.pareto(spark.createDataFrame(rows, "customer_id string, monetary decimal(14,2)"))


def test_pareto_peers_share_the_total(spark):
    rows = pareto_of(spark, [5, 5, 1]).collect()
    assert [r["customer_rank"] for r in rows] == [1, 2, 3]
    assert [r["cumulative_revenue_pct"] for r in rows] == [
        Decimal("90.91"), Decimal("90.91"), Decimal("100.00"),
    ]


@pytest.mark.parametrize("amounts", [[7] * 60, [9] * 3 + [4] * 70 + [1] * 5, list(range(1, 90))])
def test_pareto_with_ties_across_slices(spark, amounts):
    rows = pareto_of(spark, amounts).collect()
    total = sum(amounts)
    for rank, row in enumerate(rows, 1):
        peers = sum(a for a in amounts if a >= row["monetary"])
        assert row["customer_rank"] == rank
        assert abs(row["cumulative_revenue_pct"] - Decimal(100 * peers) / total) <= Decimal("0.005")
    assert [r["monetary"] for r in rows] == sorted(amounts, reverse=True)


def test_average_precision_and_roc_auc(spark):
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.5, 1)]
    found = classifier_metrics(spark.createDataFrame(rows, "p double, y int"), "p", "y").first()
    assert found["pr_auc"] == pytest.approx((1 + 2 / 3 + 3 / 5) / 3)
    assert found["roc_auc"] == pytest.approx(0.5)
    assert found["recall"] == 1.0 and found["precision"] == pytest.approx(0.6)
    assert found["f1"] == pytest.approx(0.75)


def test_metrics_with_equal_scores_and_without_predictions(spark):
    rows = [(0.2, 1), (0.2, 0), (0.1, 0), (0.1, 1)]
    found = classifier_metrics(spark.createDataFrame(rows, "p double, y int"), "p", "y").first()
    assert found["roc_auc"] == pytest.approx(0.5)
    assert (found["f1"], found["precision"], found["recall"]) == (0.0, 0.0, 0.0)


def test_regression_metrics(spark):
    rows = [(1.0, 2.0), (3.0, 3.0), (5.0, 1.0)]
    found = regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    assert found["mae"] == pytest.approx(5 / 3)
    assert found["rmse"] == pytest.approx((17 / 3) ** 0.5)
    assert found["r2"] == pytest.approx(1 - 17 / 8)


def test_revenue_agrees_across_products(spark):
    lines = gap_lines(spark)
    total = lines.agg(F.sum("revenue")).first()[0]
    history = orders.order_history(lines).agg(F.sum("order_revenue")).first()[0]
    assert history == total
    for product in (performance.monthly_sales, performance.country_performance):
        assert product(lines).agg(F.sum("revenue")).first()[0] == total
    features = customers.customer_features(lines)
    assert features.agg(F.sum("monetary")).first()[0] == total
    segments = reports.segment_contribution(features)
    assert segments.agg(F.sum("customers")).first()[0] == features.count()
