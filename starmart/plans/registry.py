"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalog
from . import reports_source as RS
from . import reports_star as RM
from . import bitmaps as BM
from . import bucketed as BK
from . import mart_load as ML
from . import quality as K
from . import reconcile as RC
from . import refresh as R
from ..sources.normalize import normalize_sources
from ..streaming import feed as ST
from ..streaming import mart_feed as SF
from ..streaming import monthly as SM

Query = Callable[[SparkSession, str], DataFrame]


def _src(fn) -> Query:
    return lambda spark, sf_dir: fn(catalog.sources(spark, sf_dir))


def _mart(fn) -> Query:
    return lambda spark, sf_dir: fn(catalog.mart(spark, sf_dir))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: catalog.mart(spark, sf_dir)[name]


def _source_table(name: str) -> Query:
    return lambda spark, sf_dir: catalog.sources(spark, sf_dir)[name]


MART_TABLES = ("dim_date", "dim_specialty", "dim_department", "dim_encounter_type", "dim_patient",
               "dim_provider", "dim_diagnosis", "dim_procedure", "fact_encounters",
               "bridge_encounter_diagnoses", "bridge_encounter_procedures")
SOURCE_TABLES = ("specialties", "departments", "providers", "patients", "encounters", "diagnoses",
                 "encounter_diagnoses", "procedures", "encounter_procedures", "billing")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "q1_source": _src(RS.q1_source),
        "q2_source": _src(RS.q2_source),
        "q3_source": _src(RS.q3_source),
        "q3_source_provider": _src(RS.q3_source_provider),
        "q4_source": _src(RS.q4_source),
        "q1_star": _mart(RM.q1_star),
        "q1_star_monthname": _mart(RM.q1_star_monthname),
        "q2_star": _mart(RM.q2_star),
        "q3_star": _mart(RM.q3_star),
        "q3_corrected": _mart(RM.q3_corrected),
        "q4_star": _mart(RM.q4_star),
        "top_readmission_specialty": _mart(RM.top_readmission_specialty),
        "top_revenue_specialty": _mart(RM.top_revenue_specialty),
        "complex_encounters": _mart(RM.complex_encounters),
        "cohort_age_gender": _mart(RM.cohort_age_gender),
        "encounters_by_floor": _mart(RM.encounters_by_floor),
        "encounter_type_comparison": _mart(RM.encounter_type_comparison),
        "diagnosis_category": _mart(RM.diagnosis_category),
        "procedure_category": _mart(RM.procedure_category),
        "diagnosis_category_report": _mart(RM.diagnosis_category_report),
        "procedure_category_report": _mart(RM.procedure_category_report),
        "primary_diagnosis_counts": _mart(RM.primary_diagnosis_counts),
        "q2_star_pruned": _mart(RM.q2_star_pruned),
        "diagnosis_category_ranges": _mart(RM.diagnosis_category_ranges),
        "procedure_category_ranges": _mart(RM.procedure_category_ranges),
        "distinct_rollup": _mart(BM.distinct_rollup),
        "q2_star_bucketed": _mart(BK.q2_star_bucketed),
        "encounter_type_settings": _src(RM.encounter_type_settings),
    }
    both = lambda fn: (lambda spark, sf_dir: fn(catalog.sources(spark, sf_dir),
                                                 catalog.mart(spark, sf_dir)))
    q.update({
        "dq_key_uniqueness": both(lambda s, m: K.key_uniqueness(K.all_tables(s, m))),
        "dq_orphan_keys": both(lambda s, m: K.orphan_keys(K.all_tables(s, m))),
        "dq_required_columns": both(lambda s, m: K.required_columns(K.all_tables(s, m))),
        "dq_calendar_coverage": _mart(K.calendar_coverage),
        "dq_fact_grain": _mart(K.fact_grain),
        "dq_reconciliation": both(K.reconciliation),
        "dq_reconcile_encounters": both(RC.dq_reconcile_encounters),
        "dq_dropped_encounters": both(K.dropped_encounters),
        "dq_encounter_type_domain": _src(K.encounter_type_domain),
        "dq_odd_encounter_types": _src(lambda s: K.encounter_type_domain(normalize_sources(K.with_odd_types(s)))),
        "dq_string_lengths": both(lambda s, m: K.string_lengths(K.all_tables(s, m))),
    })
    for name in ("incremental_facts", "scd1_upsert_patient", "insert_ignore_patient", "scd2_patient",
                 "inferred_patients", "calendar_extend", "late_window_refresh", "unknown_member_fact",
                 "daily_refresh_fact", "daily_refresh_bridges", "history_patient", "history_fact"):
        q[name] = both(getattr(R, name))
    loaded = lambda fn: (lambda spark, sf_dir: fn(spark, sf_dir, catalog.sources(spark, sf_dir)))
    for name in ("digest_changes", "digest_refresh_fact", "digest_refresh_bridges", "month_rewrite"):
        q[name] = loaded(getattr(ML, name))
    for name in ("stream_mart_fact", "stream_mart_bridges", "stream_late_events"):
        q[name] = loaded(getattr(SF, name))
    q["stream_monthly_delta"] = SM.stream_monthly_delta
    q["scalar_subquery_counts"] = _src(RS.scalar_subquery_counts)
    q["stream_fact_load"] = ST.stream_fact_load
    q["stream_monthly"] = ST.stream_monthly
    for t in MART_TABLES:
        q[t] = _table(t)
    for t in SOURCE_TABLES:
        q[f"src_{t}"] = _source_table(t)
    return q
