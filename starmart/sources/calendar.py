"""Calendar generators (S5, A13): one row per day, inclusive range."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_START = _dt.date(2020, 1, 1)
DEFAULT_END = _dt.date(2040, 12, 31)
TAIL_DAYS = 30


def calendar_days(spark: SparkSession, start: _dt.date = DEFAULT_START,
                  end: _dt.date = DEFAULT_END) -> DataFrame:
    """Days start..end as ``full_date``; spread over tasks by ``spark.range``."""
    n = (end - start).days + 1
    return spark.range(0, max(n, 0)).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))


def calendar_between(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """Days between two aggregate bounds of a one-row frame (no driver round trip)."""
    return bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def calendar_for_encounters(encounters: DataFrame, tail_days: int = TAIL_DAYS) -> DataFrame:
    """min(encounter day) .. max(max(encounter day) + tail, max(discharge day)).

    The calendar grows with the date span only (a few thousand rows), never
    with the number of encounters.
    """
    b = encounters.agg(F.min(F.to_date("encounter_date")).alias("d0"),
                       F.max(F.to_date("encounter_date")).alias("d1"),
                       F.max(F.to_date("discharge_date")).alias("d2"))
    end = F.greatest(F.date_add("d1", tail_days), F.coalesce(F.col("d2"), F.date_add("d1", tail_days)))
    return calendar_between(b, F.col("d0"), end)
