"""Exact decimal ratios.

Rates and means are rounded once, half up, by integer arithmetic:
``(2 * a * 10^s + b) div (2 * b)`` is ``a / b`` in units of ``10^-s`` for non-negative a and
positive b.  Doubles never take part, so equal rates compare equal.  The helpers
take SQL expressions (column names or aggregates).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scaled(num: str, den: str, factor: int) -> str:
    d = f"CAST({den} AS DECIMAL(30,0))"
    n = f"CAST({num} AS DECIMAL(30,0))"
    return f"CASE WHEN {d} <> 0 THEN CAST(({n} * {2 * factor} + {d}) div ({d} * 2) AS DECIMAL(20,0)) END"


def rate_percent_text(num: str, den: str) -> str:
    """num / den in percent, four decimals, as DECIMAL(10,4); null when den is 0."""
    return f"CAST({_scaled(num, den, 100 * 10 ** 4)} / 10000 AS DECIMAL(10,4))"


def mean_exact(total: str, count: str, scale: int = 4) -> Column:
    """total / count rounded half up to ``scale`` decimals, as DECIMAL(18, scale)."""
    return F.expr(f"CAST({_scaled(total, count, 10 ** scale)} / {10 ** scale} AS DECIMAL(18,{scale}))")
