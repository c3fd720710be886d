"""Exact decimal arithmetic.

Quotients are computed on integers, so rounding half away from zero happens once, on
the true value. A decimal quotient of two very large sums would first be cut to the
digits that fit into 38 places.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money totals leave room for sums over a very large number of lines.
MONEY = "decimal(22,2)"


def _integer(value: Column, places: int) -> Column:
    """``value`` in units of its last decimal place."""
    return (value.cast(f"decimal(28,{places})") * 10**places).cast("decimal(28,0)")


def _shifted(units: Column, places: int, data_type: str) -> Column:
    unit = F.lit(f"1e-{places}").cast(f"decimal({places + 1},{places})")
    return (units.cast("decimal(20,0)") * unit).cast(data_type)


def mean(total: Column, count: Column, places: int, data_type: str, scale: int = 3) -> Column:
    """``total / count`` rounded to ``places``; NULL for a zero count.

    ``total`` has at most ``scale`` decimal places and is not negative.
    """
    top = _integer(total, scale) * (2 * 10**places)
    bottom = F.nullif(count, F.lit(0).cast("long")).cast("decimal(20,0)") * 10**scale
    return _shifted(F.call_function("div", top + bottom, bottom * 2), places, data_type)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two places; NULL where ``whole`` is zero or missing.

    ``whole`` is not negative; both have at most three decimal places.
    """
    top = _integer(part, 3)
    bottom = F.nullif(_integer(whole, 3), F.lit(0).cast("decimal(28,0)"))
    hundredths = F.call_function("div", F.abs(top) * 20_000 + bottom, bottom * 2)
    return _shifted(F.when(top < 0, -hundredths).otherwise(hundredths), 2, "decimal(18,2)")
