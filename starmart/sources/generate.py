"""Synthetic source generator (S4): one row per id and table, ids start..stop-1.

The reference fills the ten tables with a row-at-a-time loop; here each table
is one ``spark.range`` projection, spread over all tasks.  Random columns use
seeded ``rand`` so a run repeats, and ``today`` replaces the clock (F11).
Every foreign key equals the row's own id, as in the reference: this data
tests volume, not join logic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

DEFAULT_START, DEFAULT_STOP = 15000, 30000


def generate_sources(spark: SparkSession, start: int = DEFAULT_START, stop: int = DEFAULT_STOP,
                     seed: int = 42, today: _dt.date = _dt.date(2026, 1, 1)) -> dict[str, DataFrame]:
    ids = spark.range(start, stop)
    i = F.col("id")
    s = F.col("id").cast("string")
    day = F.lit(today)
    now = F.lit(_dt.datetime(today.year, today.month, today.day))

    def rnd(k: int):
        return F.rand(seed + k)

    out = {
        "specialties": ids.select(i.alias("specialty_id"), F.concat(F.lit("Specialty "), s).alias("specialty_name"),
                                  F.concat(F.lit("SP"), s).alias("specialty_code")),
        "departments": ids.select(i.alias("department_id"), F.concat(F.lit("Department "), s).alias("department_name"),
                                  F.floor(rnd(1) * 10 + 1).cast("int").alias("floor"),
                                  F.floor(rnd(2) * 100 + 10).cast("int").alias("capacity")),
        "providers": ids.select(i.alias("provider_id"), F.concat(F.lit("ProviderF"), s).alias("first_name"),
                                F.concat(F.lit("ProviderL"), s).alias("last_name"), F.lit("MD").alias("credential"),
                                i.alias("specialty_id"), i.alias("department_id")),
        "patients": ids.select(i.alias("patient_id"), F.concat(F.lit("PatientF"), s).alias("first_name"),
                               F.concat(F.lit("PatientL"), s).alias("last_name"),
                               F.date_sub(day, F.floor(rnd(3) * 25000).cast("int")).alias("date_of_birth"),
                               F.when(rnd(4) > 0.5, "M").otherwise("F").alias("gender"),
                               F.concat(F.lit("MRN"), s).alias("mrn")),
        "diagnoses": ids.select(i.alias("diagnosis_id"), F.concat(F.lit("ICD"), s).alias("icd10_code"),
                                F.concat(F.lit("Diagnosis Description "), s).alias("icd10_description")),
        "procedures": ids.select(i.alias("procedure_id"), F.concat(F.lit("CPT"), s).alias("cpt_code"),
                                 F.concat(F.lit("Procedure Description "), s).alias("cpt_description")),
        "encounters": ids.select(
            i.alias("encounter_id"), i.alias("patient_id"), i.alias("provider_id"),
            F.element_at(F.array(F.lit("Outpatient"), F.lit("Inpatient"), F.lit("ER")),
                         F.floor(rnd(5) * 3 + 1).cast("int")).alias("encounter_type"),
            F.timestamp_add("DAY", -F.floor(rnd(6) * 365).cast("int"), now).alias("encounter_date"),
            now.alias("discharge_date"), i.alias("department_id")),
        "encounter_diagnoses": ids.select(i.alias("encounter_id"), i.alias("diagnosis_id"),
                                          F.lit(1).alias("diagnosis_sequence")),
        "encounter_procedures": ids.select(i.alias("encounter_id"), i.alias("procedure_id"),
                                           day.alias("procedure_date")),
        "billing": ids.select(i.alias("encounter_id"),
                              F.round(rnd(7) * 10000, 2).alias("claim_amount"),
                              F.round(rnd(8) * 8000, 2).alias("allowed_amount"),
                              day.alias("claim_date"), F.lit("Submitted").alias("claim_status")),
    }
    return {k: schemas.conform(v, schemas.SOURCE[k]) for k, v in out.items()}
