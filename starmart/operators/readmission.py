"""Return-within-window flags without a self-join (J7, J8, rewrite 2 of SURVEY §4).

Question per discharge row (key k, time t): is there an arrival of the same
k with ``t < a <= t + N days`` (``within``), and is there any arrival with
``a > t`` at all (``later``)?

The reference answers with a self-join on the patient, which grows with the
square of a patient's encounters.  Here:

1. arrivals and discharge days are aggregated together to one row per
   (k, day) holding the first and last arrival of the day (map-side partial
   aggregation, so a hot key is combined before the shuffle);
2. per k, a running ``min`` over *later* days gives the first arrival after
   the day (a growing frame, linear per group; the group holds at most one row
   per calendar day of that key, a bound set by the date span, not by volume);
3. the discharge rows look their (k, day) row up with an equi-join on a
   unique key (AQE splits a hot key on the discharge side).

Then ``later  = last_same_day > t  or  next_day_first is not null`` and
``within = last_same_day > t  or  next_day_first <= t + N days``: an arrival
later on the same day is always inside a window of at least one day.

The operator is a SQL builder (CTEs over any two relations); ``return_flags``
wraps it for DataFrames.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def return_flags_sql(discharges: str, arrivals: str, key: str, discharge_time: str, arrival_time: str,
                     days: int = 30, out: str = "flagged", discharge_days: str | None = None) -> str:
    """CTE definitions (no leading WITH) ending in ``out``: the discharge rows plus
    ``later`` and ``within``.  ``discharges`` / ``arrivals`` name relations.

    ``discharge_days`` may name a cheaper relation with the same key and time
    columns whose days are a superset of the discharge days (extra days only add
    empty rows to the day table); by default the discharges themselves are used.
    """
    day_src = discharge_days or discharges
    if int(days) < 1:
        raise ValueError("window must be at least one day")
    t = f"CAST(q.{discharge_time} AS TIMESTAMP_NTZ)"
    return f"""
{out}_days AS (
  SELECT _rk, _rd, _last,
         MIN(_first) OVER (PARTITION BY _rk ORDER BY _rd DESC
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _next
  FROM (SELECT _rk, to_date(_at) AS _rd, MIN(_ra) AS _first, MAX(_ra) AS _last
        FROM (SELECT {key} AS _rk, CAST({arrival_time} AS TIMESTAMP_NTZ) AS _ra,
                     CAST({arrival_time} AS TIMESTAMP_NTZ) AS _at
              FROM {arrivals} WHERE {key} IS NOT NULL AND {arrival_time} IS NOT NULL
              UNION ALL
              SELECT {key}, CAST(NULL AS TIMESTAMP_NTZ), CAST({discharge_time} AS TIMESTAMP_NTZ)
              FROM {day_src} WHERE {key} IS NOT NULL AND {discharge_time} IS NOT NULL)
        GROUP BY _rk, to_date(_at))),
{out} AS (
  SELECT q.*,
         COALESCE(d._last > {t}, FALSE) OR d._next IS NOT NULL AS later,
         COALESCE(d._last > {t}, FALSE) OR COALESCE(d._next <= {t} + INTERVAL {int(days)} DAYS, FALSE) AS within
  FROM {discharges} q
  LEFT JOIN {out}_days d ON q.{key} = d._rk AND to_date(q.{discharge_time}) = d._rd)"""


def return_flags(discharges: DataFrame, arrivals: DataFrame, key: str, discharge_time: str,
                 arrival_time: str, days: int = 30) -> DataFrame:
    """``discharges`` plus boolean columns ``later`` and ``within``.

    Times may be DATE or TIMESTAMP_NTZ (dates count as midnight).  Rows with a
    null key or time get ``later = within = false``.
    """
    tag = uuid.uuid4().hex[:8]
    dv, av = f"sm_dis_{tag}", f"sm_arr_{tag}"
    discharges.createOrReplaceTempView(dv)
    arrivals.createOrReplaceTempView(av)
    ctes = return_flags_sql(dv, av, key, discharge_time, arrival_time, days)
    return discharges.sparkSession.sql(f"WITH {ctes.strip()} SELECT * FROM flagged")
