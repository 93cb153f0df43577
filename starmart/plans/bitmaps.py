"""Exact distinct counts that merge (A3, A4): bitmaps over the dense patient keys.

``patient_bitmaps`` stores, by admission month, specialty and encounter type, which patients were seen: a bit a key, in
blocks of 32,768 keys, beside the number of encounters.  The keys of W1 are dense, so the blocks of a large group are
well filled.  Any coarser count is the number of bits of the OR of its blocks, read from the stored rows alone:
neither the fact nor a distinct set of patients is shuffled again, and a new month only adds rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import materialize

GRAIN = ("admission_month", "specialty_name", "encounter_type_name")
#: the counts of the registered roll-up, from fine to coarse
LEVELS = (GRAIN, GRAIN[:2], ("specialty_name",), ("admission_month",), ())


def patient_bitmaps(m: dict[str, DataFrame]) -> DataFrame:
    """(month, specialty, type, block, bits, encounters), written once."""
    f = m["fact_encounters"].select((F.col("admission_date_key") / 100).cast("int").alias("admission_month"), "provider_key",
                                    "encounter_type_key", "patient_key")
    named = (f.join(m["dim_provider"].select("provider_key", "specialty_name"), "provider_key")
             .join(m["dim_encounter_type"].select("encounter_type_key", "encounter_type_name"), "encounter_type_key"))
    rows = named.groupBy(*GRAIN, F.bitmap_bucket_number("patient_key").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("patient_key")).alias("bits"), F.count(F.lit(1)).alias("encounters"))
    return materialize(rows, "patient_bitmaps")


def rolled_up(bitmaps: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Encounters and distinct patients by some of the columns of the grain."""
    merged = bitmaps.groupBy(*columns, "block").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("encounters").alias("encounters"))
    counted = merged.select(*columns, F.bitmap_count("bits").alias("patients"), "encounters")
    if not columns:
        return counted.agg(F.coalesce(F.sum("encounters"), F.lit(0)).alias("total_encounters"),
                           F.coalesce(F.sum("patients"), F.lit(0)).alias("unique_patients"))
    return counted.groupBy(*columns).agg(F.sum("encounters").alias("total_encounters"), F.sum("patients").alias("unique_patients"))


def distinct_rollup(m) -> DataFrame:
    """Registered A3/A4: encounters and distinct patients at five levels, all from the stored bitmaps."""
    bitmaps = patient_bitmaps(m)
    kinds = dict(bitmaps.dtypes)
    parts = []
    for columns in LEVELS:
        rows = rolled_up(bitmaps, columns)
        parts.append(rows.select(F.lit("+".join(columns) or "all").alias("level"), *[
            F.col(c) if c in columns else F.lit(None).cast(kinds[c]).alias(c) for c in GRAIN], "total_encounters", "unique_patients"))
    return reduce(DataFrame.unionAll, parts)
