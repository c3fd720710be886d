"""Business labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillgrain.schemas import LOW_RISK_UP_TO, MEDIUM_RISK_UP_TO

# ---------------------------------------------------------------------------
# Segment names with their score ranges (recency, frequency and
# monetary, each from-to, scores run from 1 to 4), in order of precedence; and
# the recency above which a rule-based status applies, in days.
# ---------------------------------------------------------------------------
SEGMENTS = (
    ("Champions", (4, 4), (3, 4), (3, 4)),
    ("Loyal Customers", (3, 4), (3, 4), (1, 4)),
    ("New / Potential", (4, 4), (1, 2), (1, 4)),
    ("High-Value At Risk", (1, 2), (1, 4), (3, 4)),
    ("At Risk", (1, 1), (1, 4), (1, 4)),
)
OTHER_SEGMENT = "Regular Customers"
STATUSES = (("High Risk", 90), ("Watchlist", 60))
OTHER_STATUS = "Active"
# ---------------------------------------------------------------------------


def _first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    label = F.lit(otherwise)
    for condition, name in reversed(rules):
        label = F.when(condition, F.lit(name)).otherwise(label)
    return label


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    rules = [
        (recency.between(*r) & frequency.between(*f) & monetary.between(*m), name)
        for name, r, f, m in SEGMENTS
    ]
    return _first_match(rules, OTHER_SEGMENT)


def churn_status(recency_days: Column) -> Column:
    return _first_match([(recency_days > days, name) for name, days in STATUSES], OTHER_STATUS)


def risk_band(probability: Column) -> Column:
    """Bands closed on the right, taken on the unrounded probability."""
    rules = [(probability <= LOW_RISK_UP_TO, "Low"), (probability <= MEDIUM_RISK_UP_TO, "Medium")]
    return F.when(probability.isNotNull(), _first_match(rules, "High"))
