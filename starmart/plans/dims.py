"""Dimension builds B1-B8, B12, B14.

Each build is a lazy frame except for the dense surrogate key, which
checkpoints once (see ``operators.keys``).  Keys follow the order of the
natural key, so a rebuild gives the same keys.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import codes, dates
from ..operators.keys import assign_dense_key
from ..sources import calendar


def date_attributes(days: DataFrame, weekend_days=(6, 7)) -> DataFrame:
    """B1 columns for a frame of ``full_date``."""
    d = F.col("full_date")
    return schemas.conform(days.select(
        dates.date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.month(d).alias("month"),
        dates.month_name(d).alias("month_name"), F.quarter(d).alias("quarter"),
        dates.day_of_week_text(d).alias("day_of_week"),
        dates.is_weekend(d, weekend_days).alias("is_weekend")), schemas.MART["dim_date"])


def build_dim_date(spark: SparkSession, start: _dt.date = calendar.DEFAULT_START,
                   end: _dt.date = calendar.DEFAULT_END, weekend_days=(6, 7)) -> DataFrame:
    """B1: calendar 2020-01-01..2040-12-31 by default; the date key is the key."""
    return date_attributes(calendar.calendar_days(spark, start, end), weekend_days)


def build_dim_date_for(encounters: DataFrame, weekend_days=(6, 7)) -> DataFrame:
    """B1 over the span of the data (A13), used for the driver tables."""
    return date_attributes(calendar.calendar_for_encounters(encounters), weekend_days)


def specialty_attributes(src: dict[str, DataFrame]) -> DataFrame:
    return src["specialties"].select("specialty_id", "specialty_name").distinct()


def build_dim_specialty(src: dict[str, DataFrame]) -> DataFrame:
    """B2: SELECT DISTINCT specialty_id, specialty_name + key."""
    d = specialty_attributes(src)
    return schemas.conform(assign_dense_key(d, ["specialty_id", "specialty_name"], "specialty_key"),
                           schemas.MART["dim_specialty"])


def department_attributes(src: dict[str, DataFrame]) -> DataFrame:
    return src["departments"].select("department_id", "department_name", "floor").distinct()


def build_dim_department(src: dict[str, DataFrame]) -> DataFrame:
    """Distinct (id, name, floor) + key; capacity is dropped."""
    d = department_attributes(src)
    return schemas.conform(assign_dense_key(d, ["department_id", "department_name", "floor"], "department_key"),
                           schemas.MART["dim_department"])


def encounter_class(type_name, mode: str = "general"):
    """Class of care; the load puts 'General' everywhere, 'setting' derives it."""
    if mode == "general":
        return F.lit("General")
    return (F.when(type_name == "Inpatient", "Inpatient care")
             .when(type_name == "ER", "Emergency care")
             .when(type_name == "Outpatient", "Ambulatory care")
             .otherwise("General"))


def encounter_type_attributes(src: dict[str, DataFrame], class_mode: str = "general") -> DataFrame:
    d = src["encounters"].select(F.col("encounter_type").alias("encounter_type_name")).distinct()
    return d.withColumn("encounter_class", encounter_class(F.col("encounter_type_name"), class_mode))


def build_dim_encounter_type(src: dict[str, DataFrame], class_mode: str = "general") -> DataFrame:
    """Distinct encounter type + class."""
    d = encounter_type_attributes(src, class_mode)
    return schemas.conform(assign_dense_key(d, ["encounter_type_name"], "encounter_type_key"),
                           schemas.MART["dim_encounter_type"])


def patient_attributes(patients: DataFrame, as_of: _dt.date) -> DataFrame:
    """B4 columns without the key: full name (null if a part is null), age band, flag."""
    p = F.col
    return patients.select(
        "patient_id",
        F.concat(p("first_name"), F.lit(" "), p("last_name")).alias("full_name"),
        "gender", "date_of_birth",
        dates.age_group(dates.age_in_years(p("date_of_birth"), as_of)).alias("age_group"),
        F.lit(True).alias("current_flag"))


def build_dim_patient(src: dict[str, DataFrame], as_of: _dt.date) -> DataFrame:
    """One row per source patient (no DISTINCT), age as of ``as_of`` (never today)."""
    d = patient_attributes(src["patients"], as_of)
    return schemas.conform(assign_dense_key(d, ["patient_id"], "patient_key"), schemas.MART["dim_patient"])


def provider_attributes(providers: DataFrame, dim_specialty: DataFrame,
                        dim_department: DataFrame) -> DataFrame:
    """B5 columns without the key: names copied in by two left lookups, credential NULL."""
    s = dim_specialty.select(F.col("specialty_id").alias("_s_id"), "specialty_name")
    d = dim_department.select(F.col("department_id").alias("_d_id"), "department_name")
    return (providers
            .join(s, providers.specialty_id == s._s_id, "left")
            .join(d, providers.department_id == d._d_id, "left")
            .select("provider_id",
                    F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("provider_name"),
                    F.lit(None).cast("string").alias("credential"),
                    "specialty_name", "department_name"))


def build_dim_provider(src: dict[str, DataFrame], dim_specialty: DataFrame,
                       dim_department: DataFrame) -> DataFrame:
    """B5."""
    d = provider_attributes(src["providers"], dim_specialty, dim_department)
    return schemas.conform(assign_dense_key(d, ["provider_id"], "provider_key"), schemas.MART["dim_provider"])


def diagnosis_attributes(src: dict[str, DataFrame], with_category: bool = False) -> DataFrame:
    d = src["diagnoses"].select(F.col("diagnosis_id"), F.col("icd10_code").alias("icd_code"),
                                F.col("icd10_description").alias("diagnosis_description")).distinct()
    cat = codes.icd_category(F.col("icd_code")) if with_category else F.lit(None).cast("string")
    return d.withColumn("category", cat)


def build_dim_diagnosis(src: dict[str, DataFrame], with_category: bool = False) -> DataFrame:
    """B6 (+B12): distinct id, code, description; category NULL as loaded, or derived."""
    d = diagnosis_attributes(src, with_category)
    return schemas.conform(assign_dense_key(d, ["diagnosis_id", "icd_code", "diagnosis_description"],
                                            "diagnosis_key"), schemas.MART["dim_diagnosis"])


def procedure_attributes(src: dict[str, DataFrame], with_category: bool = False) -> DataFrame:
    d = src["procedures"].select(F.col("procedure_id"), F.col("cpt_code"),
                                 F.col("cpt_description").alias("procedure_description")).distinct()
    cat = codes.cpt_category(F.col("cpt_code")) if with_category else F.lit(None).cast("string")
    return d.withColumn("category", cat)


def build_dim_procedure(src: dict[str, DataFrame], with_category: bool = False) -> DataFrame:
    """B7 (+B12)."""
    d = procedure_attributes(src, with_category)
    return schemas.conform(assign_dense_key(d, ["procedure_id", "cpt_code", "procedure_description"],
                                            "procedure_key"), schemas.MART["dim_procedure"])


UNKNOWN_KEY = -1


#: dimensions that a fact lookup can miss
UNKNOWN_MEMBERS = {"dim_encounter_type": "encounter_type_key", "dim_department": "department_key",
                   "dim_provider": "provider_key", "dim_patient": "patient_key"}


def add_unknown_member(dim: DataFrame, key: str, label: str = "Unknown") -> DataFrame:
    """The dimension plus one 'Unknown' row with key -1 (strings 'Unknown',
    other attributes null), so facts whose lookup failed still join."""
    if dim.where(F.col(key) == UNKNOWN_KEY).limit(1).count():
        return dim
    cols = []
    for f in dim.schema.fields:
        if f.name == key:
            cols.append(F.lit(UNKNOWN_KEY).cast(f.dataType).alias(f.name))
        elif f.dataType.simpleString() == "string":
            cols.append(F.lit(label).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return dim.unionByName(dim.sparkSession.range(1).select(*cols))
