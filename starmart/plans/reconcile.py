"""Two-way reconciliation of sources and mart (K6): every encounter that differs, in either direction.

Totals hide errors that cancel.  Here each measure is summed with a weight per encounter, a hash of its id, so errors of
two encounters cancel only by chance.  The sums are linear: claims and links are weighted and summed as they
stand, without grouping them by encounter first, in one pass with a partial aggregate over each table.

1. Both sides are summed in ``FANOUT`` buckets of encounters.
2. Buckets that differ are summed again in ``FANOUT`` parts each, reading only their rows.
3. The encounters of the parts that still differ are compared one by one, both ways.

If nothing differs, step 1 is all the work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..sources.store import materialize

FANOUT = 256
MEASURES = ("encounter", "claim_amount", "allowed_amount", "diagnoses", "procedures")
_VALUE = "decimal(38,2)"


def _content() -> Column:
    """What an encounter row says, as a number below 2^31."""
    names = ["patient_id", "provider_id", "encounter_type", "admission_date_key", "discharge_date_key"]
    return F.pmod(F.xxhash64(*[x for c in names for x in (F.col(c).isNull(), F.col(c))]), F.lit(1 << 31))


def source_side(src: dict[str, DataFrame]) -> list[DataFrame]:
    """(encounter_id, measure, value) rows whose sums by encounter are what the mart must hold."""
    e = src["encounters"].withColumn("admission_date_key", dates.date_key(F.col("encounter_date"))).withColumn(
        "discharge_date_key", dates.date_key(F.col("discharge_date")))
    row = lambda df, measure, value: df.select("encounter_id", F.lit(measure).alias("measure"), value.cast(_VALUE).alias("value"))
    b = src["billing"]
    return [row(e, "encounter", _content()), row(b, "claim_amount", F.col("claim_amount")), row(b, "allowed_amount", F.col("allowed_amount")),
            row(src["encounter_diagnoses"], "diagnoses", F.lit(1)), row(src["encounter_procedures"], "procedures", F.lit(1))]


def mart_side(m: dict[str, DataFrame]) -> list[DataFrame]:
    f = m["fact_encounters"]
    for dim, key, name in (("dim_patient", "patient_key", "patient_id"), ("dim_provider", "provider_key", "provider_id"),
                           ("dim_encounter_type", "encounter_type_key", "encounter_type_name")):
        f = f.join(m[dim].select(key, name), key, "left")
    f = f.withColumnRenamed("encounter_type_name", "encounter_type")
    values = [_content(), F.col("total_claim_amount"), F.col("total_allowed_amount"), F.col("diagnosis_count"), F.col("procedure_count")]
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), v.cast(_VALUE).alias("value")) for n, v in zip(MEASURES, values)])
    return [f.select("encounter_id", F.inline(pairs))]


def _bucket(level: int) -> Column:
    return F.pmod(F.xxhash64("encounter_id"), F.lit(FANOUT ** level))


def _summed(side: list[DataFrame], level: int, within: DataFrame | None) -> DataFrame:
    """(bucket, measure, sum) of the rows in the buckets ``within`` of the level above."""
    weight = (F.pmod(F.xxhash64("encounter_id", F.lit(7)), F.lit((1 << 31) - 1)) + 1).cast("decimal(10,0)")
    parts = []
    for rows in side:
        if within is not None:
            rows = rows.withColumn("_b", _bucket(level - 1)).join(within, "_b", "left_semi")
        # the row of an encounter counts by its presence as well as by its content
        value = F.when(F.col("measure") == "encounter", F.col("value") + 1).otherwise(F.col("value")) * weight
        parts.append(rows.groupBy(_bucket(level).alias("_b"), "measure").agg(F.sum(value.cast(_VALUE)).alias("_s")))
    return reduce(DataFrame.unionAll, parts)


def differing_buckets(source: list[DataFrame], mart: list[DataFrame], level: int, within: DataFrame | None) -> DataFrame:
    """(_b): buckets with a measure whose weighted sums differ."""
    a, b = _summed(source, level, within), _summed(mart, level, within)
    signed = a.unionAll(b.withColumn("_s", -F.col("_s")))
    return materialize(signed.groupBy("_b", "measure").agg(F.sum("_s").alias("_s")).where("_s <> 0").select("_b").distinct(), "differing")


def reconcile(src: dict[str, DataFrame], m: dict[str, DataFrame], levels: int = 2) -> DataFrame:
    """(encounter_id, difference, measures): missing in mart, missing in source, or differs in some measures."""
    source, mart = source_side(src), mart_side(m)
    within = None
    for level in range(1, levels + 1):
        within = differing_buckets(source, mart, level, within)

    def each(side: list[DataFrame], name: str) -> DataFrame:
        rows = reduce(DataFrame.unionAll, [r.withColumn("_b", _bucket(levels)).join(within, "_b", "left_semi").drop("_b") for r in side])
        per = rows.groupBy("encounter_id").pivot("measure", list(MEASURES)).agg(F.sum("value"))
        present = per.where(F.col("encounter").isNotNull())
        return present.select("encounter_id", F.struct(*[F.coalesce(F.col(c), F.lit(0).cast(_VALUE)).alias(c) for c in MEASURES]).alias(name))

    met = each(source, "_s").join(each(mart, "_m"), "encounter_id", "full_outer")
    kind = (F.when(F.col("_m").isNull(), "missing in mart").when(F.col("_s").isNull(), "missing in source").otherwise("differs"))
    differing = F.array_compact(F.array(*[F.when(F.col(f"_s.{c}") != F.col(f"_m.{c}"), F.lit(c)) for c in MEASURES]))
    return (met.where(~F.col("_s").eqNullSafe(F.col("_m")))
            .select("encounter_id", kind.alias("difference"), F.concat_ws(",", differing).alias("measures")))


def damaged(m: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The mart with errors by rules on the id: amounts that cancel (1 and 2 of 97), rows lost (101), a count off (103), a
    patient mixed up (109), rows that no source has (negative ids of 107)."""
    f, i = m["fact_encounters"], F.col("encounter_id")
    extra = f.where((i % 107 == 0) & (i > 0)).withColumn("encounter_id", -i)
    first = m["dim_patient"].agg(F.min("patient_key").alias("_first"))
    shift = F.when(i % 97 == 1, 1).when(i % 97 == 2, -1).otherwise(0)
    f = (f.where(i % 101 != 0).crossJoin(first)  # one row
         .withColumn("total_allowed_amount", (F.col("total_allowed_amount") + shift).cast("decimal(12,2)"))
         .withColumn("diagnosis_count", F.col("diagnosis_count") + F.when(i % 103 == 0, 1).otherwise(0))
         .withColumn("patient_key", F.when(i % 109 == 0, F.col("_first")).otherwise(F.col("patient_key"))).drop("_first"))
    return dict(m, fact_encounters=f.unionByName(extra))


def dq_reconcile_encounters(src, m) -> DataFrame:
    """Registered K6: what the two-way check finds in a mart damaged by rules."""
    return reconcile(src, damaged(m))
