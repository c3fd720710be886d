"""Checks that stop a run. Each is one aggregate or one key-grain join."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillgrain.sources.tables import write_table


def violations(df: DataFrame, rules: Mapping[str, Column]) -> dict[str, int]:
    """Rows breaking each rule; a rule that evaluates to NULL counts as broken."""
    return df.agg(*_counts(rules)).first().asDict()


def violation_rows(df: DataFrame, rules: Mapping[str, Column], table: str) -> DataFrame:
    """One row per rule: table_name, rule, broken (rows); one aggregate over ``df``."""
    counted = df.agg(
        *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    )
    return counted.unpivot([], counted.columns, "rule", "broken").select(
        F.lit(table).alias("table_name"), "rule", "broken"
    )


def key_violations(child: DataFrame, parent: DataFrame, key: str, table: str) -> DataFrame:
    """Keys of ``child`` without a parent row, and keys that occur more than once."""
    orphans = child.select(key).join(parent.select(key), key, "left_anti")
    repeated = child.groupBy(key).count().filter(F.col("count") > 1)
    found = [(orphans, f"{key} without parent"), (repeated, f"{key} repeated")]
    rows = [
        df.agg(F.count(F.lit(1)).alias("broken")).select(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "broken"
        )
        for df, rule in found
    ]
    return rows[0].unionByName(rows[1])


def _counts(rules: Mapping[str, Column]) -> list[Column]:
    """Rows, and rows breaking each rule; a rule that evaluates to NULL counts as broken."""
    broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    return [F.count(F.lit(1)).alias("rows"), *broken]


def _accepted(found: Mapping[str, int], table: str) -> int:
    """The row count among ``found``; raises if it is 0 or a rule is broken."""
    broken = {name: n for name, n in found.items() if n and name != "rows"}
    if found["rows"] == 0:
        raise ValueError(f"{table} is empty.")
    if broken:
        raise ValueError(f"{table} breaks {broken}")
    return found["rows"]


def observed_write(
    df: DataFrame,
    path: str,
    rules: Mapping[str, Column],
    write: Callable[[DataFrame, str], DataFrame] = write_table,
) -> tuple[DataFrame, dict[str, int]]:
    """Write the Parquet table at ``path`` by ``write`` and count its rows and broken rules in the same job.

    Every written row passes the counting once, in the task that writes it, so no second scan follows.
    """
    seen = Observation()
    written = write(df.observe(seen, *_counts(rules)), path)
    # Tasks without rows report nothing, so an empty table has no counts of its own.
    return written, {"rows": 0, **dict.fromkeys(rules, 0), **{k: v or 0 for k, v in seen.get.items()}}


def written_checked(
    df: DataFrame,
    path: str,
    rules: Mapping[str, Column],
    table: str,
    write: Callable[[DataFrame, str], DataFrame] = write_table,
) -> DataFrame:
    """``observed_write``, raising if the table is empty or breaks a rule."""
    written, found = observed_write(df, path, rules, write)
    _accepted(found, table)
    return written


def require(df: DataFrame, rules: Mapping[str, Column], table: str) -> int:
    """Row count of ``df``; raises if it is empty or breaks a rule."""
    return _accepted(violations(df, rules), table)


def _filled(*names: str) -> dict[str, Column]:
    return {f"{name} missing": F.col(name).isNotNull() for name in names}


def transaction_rules() -> dict[str, Column]:
    return {
        **_filled(
            "invoice_no", "stock_code", "invoice_date", "customer_id", "country", "source_period"
        ),
        "quantity not positive": F.col("quantity") > 0,
        "unit_price not positive": F.col("unit_price") > 0,
        "revenue not positive": F.col("revenue") > 0,
        "revenue differs from quantity x price": F.col("revenue")
        == F.col("quantity") * F.col("unit_price"),
    }


def analytics_rules() -> dict[str, Column]:
    return {
        **_filled("customer_id", "churn_score_method"),
        "rfm_cluster negative": F.col("rfm_cluster") >= 0,
        "churn_probability outside 0-1": F.col("churn_probability").between(0, 1),
        "churn_risk_band unknown": F.col("churn_risk_band").isin("Low", "Medium", "High"),
        "predicted_90d_value negative": F.col("predicted_90d_value") >= 0,
    }


def profile_rules() -> dict[str, Column]:
    return {
        **_filled("rfm_cluster", "avg_recency", "avg_frequency", "avg_monetary", "total_revenue"),
        "customers not positive": F.col("customers") > 0,
    }


def metric_rules() -> dict[str, Column]:
    return {
        **_filled(
            "model_type", "model_name", "evaluation_snapshot", "metric", "value", "selected_model"
        ),
        "evaluation_split unknown": F.col("evaluation_split").isin("validation", "test"),
    }


def require_unique(df: DataFrame, keys: list[str], table: str) -> None:
    repeated = df.groupBy(*keys).count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"{table} has more than one row per {', '.join(keys)}.")


def require_reference(child: DataFrame, parent: DataFrame, key: str, table: str) -> None:
    """Every key of ``child`` must occur in ``parent``."""
    if not child.select(key).join(parent.select(key), key, "left_anti").isEmpty():
        raise ValueError(f"{table} has a {key} without a parent row.")


def joined_one_to_one(
    left: DataFrame, right: DataFrame, key: str, needed: list[str], table: str
) -> DataFrame:
    """Left join after checking that ``key`` is unique on both sides; ``needed`` columns
    must be filled in every joined row."""
    require_unique(left, [key], f"left side of {table}")
    require_unique(right, [key], f"right side of {table}")
    joined = left.join(right, key, "left")
    require(joined, _filled(*needed), table)
    return joined
