"""Fact and bridge builds (B9-B11) and the full load in dependency order.

Plan shape of the fact at scale: the three per-encounter aggregates are
partial-aggregated and joined to encounters on ``encounter_id`` (one hash
partitioning shared by all four inputs), then the dimension lookups run;
small dimensions are broadcast by Catalyst's size check after they have been
written, large ones (patients, providers) shuffle-join.  No lookup fans out:
every dimension is unique on its natural key (checked by K1).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import dates
from ..operators.keys import assign_dense_key
from ..operators.upsert import as_of_versions
from ..session import fresh_path
from ..sources.normalize import normalize_sources
from ..sources.store import materialize, read_table
from ..sources.tables import Tables, replaced
from . import dims as D

UNKNOWN_KEY = -1


def encounter_measures(src: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A10: per-encounter sums and counts, joined on the encounter id."""
    bill = src["billing"].groupBy("encounter_id").agg(
        F.sum("claim_amount").alias("total_claim"), F.sum("allowed_amount").alias("total_allowed"))
    diag = src["encounter_diagnoses"].groupBy("encounter_id").agg(F.count(F.lit(1)).alias("diag_count"))
    proc = src["encounter_procedures"].groupBy("encounter_id").agg(F.count(F.lit(1)).alias("proc_count"))
    return bill, diag, proc


def _lookup(df: DataFrame, dim: DataFrame, left_col: str, dim_col: str, key: str, how: str,
            on_missing: str) -> DataFrame:
    """Attach ``key`` by natural id; 'unknown' keeps the row with key -1.

    A dimension with history (valid_from, valid_to) is looked up as of the admission day, or by
    its current version where there is none, so that no encounter meets two versions.
    """
    d = dim.where(F.col(key) != UNKNOWN_KEY)
    if "valid_from" in dim.columns:
        d = as_of_versions(d, dim_col)
        day = F.coalesce(F.to_date("encounter_date"), F.to_date(F.lit("9999-12-31")))
        valid = (F.col("_from").isNull() | (day >= F.col("_from"))) & (F.col("_to").isNull() | (day < F.col("_to")))
    else:
        valid = F.lit(True)
    d = d.select(F.col(dim_col).alias(f"_lk_{key}"), F.col(key), *[c for c in ("_from", "_to") if c in d.columns])
    met = (df[left_col] == d[f"_lk_{key}"]) & valid
    if on_missing == "unknown":
        out = df.join(d, met, "left")
        out = out.withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN_KEY).cast("bigint")))
    else:
        out = df.join(d, met, how)
    return out.drop(f"_lk_{key}", "_from", "_to")


def fact_rows(src: dict[str, DataFrame], dims: dict[str, DataFrame], on_missing: str = "drop",
              measured: DataFrame | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """B9 without the surrogate key: one row per encounter that passes the lookups.

    ``measured``: the sums and counts of ``encounter_measures`` as one table by encounter, whose columns ``carried`` go along.
    """
    e = src["encounters"]
    e = _lookup(e, dims["dim_encounter_type"], "encounter_type", "encounter_type_name", "encounter_type_key",
                "inner", on_missing)
    e = _lookup(e, dims["dim_department"], "department_id", "department_id", "department_key", "left", on_missing)
    e = _lookup(e, dims["dim_provider"], "provider_id", "provider_id", "provider_key", "inner", on_missing)
    e = _lookup(e, dims["dim_patient"], "patient_id", "patient_id", "patient_key", "inner", on_missing)
    # keys and days alone go on, so that the sums meet narrow rows
    e = e.select(
        "encounter_id",
        dates.date_key(F.col("encounter_date")).alias("admission_date_key"),
        dates.date_key(F.col("discharge_date")).alias("discharge_date_key"),
        "patient_key", "provider_key", "department_key", "encounter_type_key",
        dates.days_between(F.col("discharge_date"), F.col("encounter_date")).alias("length_of_stay"))
    for measure in encounter_measures(src) if measured is None else (measured,):
        e = e.join(measure, "encounter_id", "left")

    def money(c: str):
        # no claims: 0; a sum that DECIMAL(12,2) cannot hold fails the load instead of reading as 0
        big = F.abs(F.col(c)) >= F.lit(10 ** 10)
        return (F.when(F.col(c).isNull(), F.lit(0).cast("decimal(12,2)"))
                .when(big, F.raise_error(F.concat(F.lit(f"{c} does not fit DECIMAL(12,2): "), F.col(c).cast("string")))
                      .cast("decimal(12,2)"))
                .otherwise(F.col(c).cast("decimal(12,2)")))

    return e.select(
        "encounter_id", "admission_date_key", "discharge_date_key", "patient_key", "provider_key", "department_key",
        "encounter_type_key", "length_of_stay",
        money("total_claim").alias("total_claim_amount"),
        money("total_allowed").alias("total_allowed_amount"),
        F.coalesce(F.col("diag_count"), F.lit(0)).cast("int").alias("diagnosis_count"),
        F.coalesce(F.col("proc_count"), F.lit(0)).cast("int").alias("procedure_count"), *carried)


def build_fact_encounters(src: dict[str, DataFrame], dims: dict[str, DataFrame],
                          on_missing: str = "drop") -> DataFrame:
    """Keys in encounter-id order."""
    rows = fact_rows(src, dims, on_missing)
    return schemas.conform(assign_dense_key(rows, ["encounter_id"], "encounter_key"),
                           schemas.MART["fact_encounters"])


DIAGNOSIS_ORDER = ["encounter_key", "diagnosis_sequence", "diagnosis_key"]
PROCEDURE_ORDER = ["encounter_key", "procedure_key"]


def bridge_diagnosis_rows(src: dict[str, DataFrame], fact: DataFrame, dim_diagnosis: DataFrame,
                          carried: tuple[str, ...] = ()) -> DataFrame:
    """Junction -> fact key -> diagnosis key (both inner); ``carried``: columns of the fact that go along."""
    f = fact.select(F.col("encounter_id").alias("_f_id"), "encounter_key", *carried)
    d = dim_diagnosis.select(F.col("diagnosis_id").alias("_d_id"), "diagnosis_key")
    ed = src["encounter_diagnoses"]
    return (ed.join(f, ed.encounter_id == f._f_id).join(d, ed.diagnosis_id == d._d_id)
              .select("encounter_key", "diagnosis_key", "diagnosis_sequence", *carried))


def build_bridge_diagnoses(src, fact, dim_diagnosis) -> DataFrame:
    """B10."""
    rows = bridge_diagnosis_rows(src, fact, dim_diagnosis)
    return schemas.conform(assign_dense_key(rows, DIAGNOSIS_ORDER, "bridge_id"), schemas.MART["bridge_encounter_diagnoses"])


def bridge_procedure_rows(src, fact, dim_procedure, carried: tuple[str, ...] = ()) -> DataFrame:
    f = fact.select(F.col("encounter_id").alias("_f_id"), "encounter_key", *carried)
    d = dim_procedure.select(F.col("procedure_id").alias("_d_id"), "procedure_key")
    ep = src["encounter_procedures"]
    return (ep.join(f, ep.encounter_id == f._f_id).join(d, ep.procedure_id == d._d_id)
              .select("encounter_key", "procedure_key", *carried))


def build_bridge_procedures(src, fact, dim_procedure) -> DataFrame:
    """B11."""
    rows = bridge_procedure_rows(src, fact, dim_procedure)
    return schemas.conform(assign_dense_key(rows, PROCEDURE_ORDER, "bridge_id"),
                           schemas.MART["bridge_encounter_procedures"])


PERIOD_COL = "admission_period"
#: the layout is declared, not derived from the data: month, year or none
FACT_LAYOUT = "spark.starmart.factLayout"
LAYOUTS = ("month", "year", "none")


def period_expr(granularity: str | None, date_key="admission_date_key"):
    """Partition value of a date key: YYYYMM (month), YYYY (year)."""
    k = F.col(date_key) if isinstance(date_key, str) else date_key
    if granularity == "month":
        return (k / 100).cast("int")
    if granularity == "year":
        return (k / 10000).cast("int")
    return None


def declared_layout(spark) -> str | None:
    """Partitioning of the fact, the same at every size; ``none`` keeps plain files in key order."""
    layout = spark.conf.get(FACT_LAYOUT, "none")
    if layout not in LAYOUTS:
        raise ValueError(f"{FACT_LAYOUT} is {layout!r}; it must be one of {', '.join(LAYOUTS)}")
    return None if layout == "none" else layout


def fact_layout(fact: DataFrame, granularity: str | None) -> DataFrame:
    """Write layout: partition column admission_period, rows clustered by (period, key)
    with a range partitioning, so a hot period is split over several tasks."""
    p = period_expr(granularity)
    if p is None:
        # the dense-key step already left the rows range-partitioned in key order and
        # sized by row count: write them as they are, no second shuffle
        return fact
    n = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fact.withColumn(PERIOD_COL, p).repartitionByRange(n, PERIOD_COL, "encounter_key")


def write_fact(fact: DataFrame, path: str, granularity: str | None, mode: str = "overwrite") -> None:
    from ..sources.store import write_table
    write_table(fact_layout(fact, granularity), path, [PERIOD_COL] if granularity else None, mode=mode)


def stored_schema(granularity: str | None):
    """Schema of the written fact, with the partition column where the layout has one."""
    fact = schemas.MART["fact_encounters"]
    return T.StructType([*fact.fields, T.StructField(PERIOD_COL, T.IntegerType())]) if granularity else fact


def read_fact(stored: DataFrame) -> DataFrame:
    return stored.select(*schemas.MART["fact_encounters"].fieldNames())


def mart_tables(src: Mapping[str, DataFrame], as_of: _dt.date, calendar: str = "data",
                on_missing: str = "drop", store: bool = True) -> Tables:
    """Dims -> fact -> bridges; each stage is written before the next reads it, and made when it is first read.

    The bridges are written by their key step, and read from there.
    """
    src = normalize_sources(src)
    keep = (lambda df, label: materialize(df, label)) if store else (lambda df, _: df)

    def dim_date() -> DataFrame:
        return (D.build_dim_date_for(src["encounters"]) if calendar == "data"
                else D.build_dim_date(src["encounters"].sparkSession))

    builds = {"dim_date": dim_date,
              "dim_specialty": lambda: D.build_dim_specialty(src),
              "dim_department": lambda: D.build_dim_department(src),
              "dim_encounter_type": lambda: D.build_dim_encounter_type(src),
              "dim_patient": lambda: D.build_dim_patient(src, as_of),
              "dim_provider": lambda: D.build_dim_provider(src, plain["dim_specialty"], plain["dim_department"]),
              "dim_diagnosis": lambda: D.build_dim_diagnosis(src),
              "dim_procedure": lambda: D.build_dim_procedure(src)}
    plain = Tables({dim: (lambda dim=dim: keep(builds[dim](), dim)) for dim in builds})
    m = replaced(plain, {})
    if on_missing == "unknown":  # failed lookups must find their member
        m = replaced(plain, {dim: (lambda dim=dim, key=key: keep(D.add_unknown_member(plain[dim], key), dim))
                             for dim, key in D.UNKNOWN_MEMBERS.items()})

    def fact() -> DataFrame:
        rows = build_fact_encounters(src, m, on_missing)
        if not store:
            return rows
        spark = rows.sparkSession
        grain = declared_layout(spark)
        path = fresh_path(spark, "fact_encounters")
        write_fact(rows, path, grain)
        return read_fact(read_table(spark, path, stored_schema(grain)))

    full = replaced(m, {
        "fact_encounters": fact,
        "bridge_encounter_diagnoses": lambda: build_bridge_diagnoses(src, full["fact_encounters"], m["dim_diagnosis"]),
        "bridge_encounter_procedures": lambda: build_bridge_procedures(src, full["fact_encounters"], m["dim_procedure"])})
    return full


def build_all(src: Mapping[str, DataFrame], as_of: _dt.date, calendar: str = "data",
              on_missing: str = "drop", store: bool = True) -> dict[str, DataFrame]:
    """B13 as a whole: all tables of ``mart_tables``, in the order of their dependencies."""
    return dict(mart_tables(src, as_of, calendar, on_missing, store))
