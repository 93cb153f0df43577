"""Date expressions with MySQL meaning."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """Smart key YYYYMMDD as INT; null in, null out."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_label(c: Column) -> Column:
    """MySQL DATE_FORMAT(x, '%Y-%m') (F1)."""
    return F.date_format(c, "yyyy-MM")


def month_name(c: Column) -> Column:
    """MySQL MONTHNAME: full English name, e.g. 'June' (F4)."""
    return F.date_format(c, "MMMM")


def day_of_week_text(c: Column) -> Column:
    """MySQL DAYOFWEEK stored as text: '1' = Sunday .. '7' = Saturday."""
    return F.dayofweek(c).cast("string")


def is_weekend(c: Column, weekend_days=(6, 7)) -> Column:
    """CASE WHEN DAYOFWEEK(x) IN (6,7): Friday and Saturday by default (F6, ledger 8)."""
    return F.dayofweek(c).isin(*weekend_days)


def days_between(end: Column, start: Column) -> Column:
    """MySQL DATEDIFF(end, start): calendar days of the date parts."""
    return F.datediff(F.to_date(end), F.to_date(start))


def age_in_years(birth: Column, as_of: _dt.date | str) -> Column:
    """MySQL TIMESTAMPDIFF(YEAR, birth, as_of): full years, month/day compared."""
    ref = F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(as_of))
    md = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(ref) - F.year(birth) - F.when(md(ref) < md(birth), 1).otherwise(0)


# The six age bands of the patient load, upper bounds exclusive.
AGE_BANDS = [(5, "0-4"), (15, "5-14"), (45, "15-44"), (65, "45-64"), (75, "65-74")]
AGE_TOP = "75+"


def age_group(age: Column) -> Column:
    """CASE ladder of the patient load; a null age falls through to '75+' (F15, ledger 9)."""
    expr = None
    for bound, label in AGE_BANDS:
        expr = F.when(age < bound, label) if expr is None else expr.when(age < bound, label)
    return expr.otherwise(AGE_TOP)
