"""Refresh: incremental load, late data, dimension history.

The reference only describes a daily refresh.  Here it runs as Spark jobs
over the whole tables, split by a *data-derived* high-water mark:

* ``cutoff``   = first day of the month three months before the last encounter
  month; the state "as loaded at cutoff" holds the encounters before it, the
  increment the encounters from it on;
* ``run_date`` = the day after the last encounter (age bands of the batch).

Every stage takes the current tables and returns the next ones; the caller writes them to
a new version directory (S7) and switches, so a refresh never changes files that
another reader is using.  ``daily_refresh`` chains the stages in the order of the load: dimensions,
placeholders, calendar, facts (new, changed and late ones together), bridges.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import upsert as U
from ..sources.store import materialize, read_table
from ..sources.tables import Tables, replaced
from ..session import fresh_path
from . import dims as D
from . import fact as FB

TRACKED_PATIENT = ["full_name", "gender", "date_of_birth", "age_group"]
MONTHS_BACK = 3          # the registered queries split the data three months before its end
LATE_WINDOW_DAYS = 60    # P13: encounters admitted that many days before the mark are recomputed


@dataclass(frozen=True)
class Marks:
    cutoff: _dt.date
    run_date: _dt.date
    window_start: _dt.date


def marks(src: dict[str, DataFrame], window_days: int = LATE_WINDOW_DAYS) -> Marks:
    """High-water marks from one aggregate row."""
    day = F.to_date(F.max("encounter_date"))
    r = src["encounters"].agg(F.add_months(F.trunc(day, "month"), -MONTHS_BACK).alias("c"),
                              F.date_add(day, 1).alias("r")).first()
    cutoff = r["c"]
    return Marks(cutoff, r["r"], cutoff - _dt.timedelta(days=window_days))


def with_encounters(src: dict[str, DataFrame], encounters: DataFrame) -> Tables:
    """Source dict restricted to ``encounters`` and their junction / billing rows (semi joins)."""
    ids = encounters.select("encounter_id")
    return replaced(src, {"encounters": lambda: encounters} | {
        t: (lambda t=t: src[t].join(ids, "encounter_id", "left_semi"))
        for t in ("encounter_diagnoses", "encounter_procedures", "billing")})


def split_encounters(src: dict[str, DataFrame], cutoff: _dt.date) -> tuple[dict, dict]:
    """(state at cutoff, increment) by encounter day (P11); null days go to the increment."""
    before = F.to_date("encounter_date") < F.lit(cutoff)
    e = src["encounters"]
    return with_encounters(src, e.where(before)), with_encounters(src, e.where(~F.coalesce(before, F.lit(False))))


def known_patients(src: dict[str, DataFrame], state: dict[str, DataFrame]) -> DataFrame:
    """Patients registered at the cutoff: those with an encounter before it."""
    return src["patients"].join(state["encounters"].select("patient_id"), "patient_id", "left_semi")


def initial_dim_patient(src, state, mk: Marks) -> DataFrame:
    return materialize(D.build_dim_patient({"patients": known_patients(src, state)}, mk.cutoff), "r_dim_patient0")


def patient_batch(src, mk: Marks) -> DataFrame:
    """Full patient extract of the run day: attributes with ages as of the run date."""
    return D.patient_attributes(src["patients"], mk.run_date)


# ---- T1 -------------------------------------------------------------------
def recompute(fact: DataFrame, src: dict[str, DataFrame], dims: dict[str, DataFrame], ids: DataFrame,
              on_missing: str = "drop") -> DataFrame:
    """The fact with the encounters ``ids`` (encounter_id) computed anew from the sources.

    The split is by id, whatever the dates say: rows of other encounters are carried unchanged
    (those without an admission date too), the others keep their key, and new ones
    get keys after the maximum.  An encounter of ``ids`` that is gone from the sources is carried.
    """
    # written once: claims, links, lookups and the carried rows all read it
    encounters = materialize(src["encounters"].join(ids.select("encounter_id").distinct(), "encounter_id", "left_semi"), "r_encounters")
    done = encounters.select("encounter_id")
    carried = fact.join(done, "encounter_id", "left_anti")
    old = fact.select(F.col("encounter_id").alias("_id"), F.col("encounter_key").alias("_key"))
    rows = FB.fact_rows(with_encounters(src, encounters), dims, on_missing)
    keyed = materialize(rows.join(old, rows.encounter_id == old._id, "left").drop("_id"), "r_rows")
    known = keyed.where(F.col("_key").isNotNull()).withColumnRenamed("_key", "encounter_key")
    fresh = U.with_new_keys(keyed.where(F.col("_key").isNull()).drop("_key"), ["encounter_id"], "encounter_key",
                            U.max_key(fact, "encounter_key"))
    schema = schemas.MART["fact_encounters"]
    return reduce(DataFrame.unionByName, [schemas.conform(x, schema) for x in (carried, known, fresh)])


def incremental_fact_load(fact: DataFrame, src: dict[str, DataFrame], dims: dict[str, DataFrame],
                          changed: DataFrame | None = None) -> DataFrame:
    """Encounters not yet loaded, and those that the extract says were modified (``changed``: encounter_id)."""
    ids = src["encounters"].select("encounter_id").join(fact.select("encounter_id"), "encounter_id", "left_anti")
    if changed is not None:
        ids = ids.unionByName(changed.select("encounter_id"))
    return recompute(fact, src, dims, ids)


def incremental_facts(src, mart) -> DataFrame:
    """Registered T1: load the state at cutoff, then the increment; result = fact after both."""
    mk = marks(src)
    state, _ = split_encounters(src, mk.cutoff)
    fact0 = materialize(FB.build_fact_encounters(state, mart), "r_fact0")
    return incremental_fact_load(fact0, src, mart)


# ---- T2 / T3 / T8 / T5 ------------------------------------------------------
def scd1_upsert_patient(src, mart) -> DataFrame:
    mk = marks(src)
    state, _ = split_encounters(src, mk.cutoff)
    return U.upsert_type1(initial_dim_patient(src, state, mk), patient_batch(src, mk), "patient_id", "patient_key")


def insert_ignore_patient(src, mart) -> DataFrame:
    mk = marks(src)
    state, _ = split_encounters(src, mk.cutoff)
    return U.insert_ignore(initial_dim_patient(src, state, mk), patient_batch(src, mk), "patient_id", "patient_key")


def scd2_patient(src, mart) -> DataFrame:
    mk = marks(src)
    state, _ = split_encounters(src, mk.cutoff)
    dim0 = (initial_dim_patient(src, state, mk)
            .withColumn("valid_from", F.lit(mk.cutoff)).withColumn("valid_to", F.lit(None).cast("date")))
    return U.scd_type2(dim0, patient_batch(src, mk), "patient_id", "patient_key", TRACKED_PATIENT, mk.run_date)


def inferred_patients(src, mart) -> DataFrame:
    """T5: placeholders for patients of increment encounters unknown to the dimension."""
    mk = marks(src)
    state, inc = split_encounters(src, mk.cutoff)
    return U.placeholders(initial_dim_patient(src, state, mk), inc["encounters"], "patient_id", "patient_key",
                          {"current_flag": F.lit(True)})


# ---- T6 ---------------------------------------------------------------------
def extend_calendar(dim_date: DataFrame, needed_days: DataFrame) -> DataFrame:
    """Add the days between the calendar and any needed day that lies outside it."""
    have = dim_date.select("full_date")
    bounds = have.unionByName(needed_days.select("full_date").where(F.col("full_date").isNotNull())) \
                 .agg(F.min("full_date").alias("d0"), F.max("full_date").alias("d1"))
    from ..sources.calendar import calendar_between
    missing = calendar_between(bounds, F.col("d0"), F.col("d1")).join(have, "full_date", "left_anti")
    return dim_date.unionByName(D.date_attributes(missing))


def calendar_extend(src, mart) -> DataFrame:
    mk = marks(src)
    state, inc = split_encounters(src, mk.cutoff)
    cal0 = materialize(D.build_dim_date_for(state["encounters"]), "r_dim_date0")
    e = inc["encounters"]
    needed = e.select(F.to_date("encounter_date").alias("full_date")).unionByName(
        e.select(F.to_date("discharge_date").alias("full_date")))
    return extend_calendar(cal0, needed)


# ---- T4 ---------------------------------------------------------------------
def late_ids(fact: DataFrame, src: dict[str, DataFrame], window_start: _dt.date) -> DataFrame:
    """Encounters admitted since ``window_start``, by the sources or by the stored fact: one whose
    date moved into or out of the window is recomputed in either case."""
    start_key = window_start.year * 10000 + window_start.month * 100 + window_start.day
    now = src["encounters"].where(F.to_date("encounter_date") >= F.lit(window_start)).select("encounter_id")
    return now.unionByName(fact.where(F.col("admission_date_key") >= start_key).select("encounter_id")).distinct()


def refresh_late_window(fact: DataFrame, src: dict[str, DataFrame], dims: dict[str, DataFrame],
                        window_start: _dt.date, on_missing: str = "drop") -> DataFrame:
    """T4: the next version of the fact, with the encounters of the late window recomputed."""
    return recompute(fact, src, dims, late_ids(fact, src, window_start), on_missing)


def late_window_refresh(src, mart) -> DataFrame:
    """Registered T4: the fact was loaded when only claims dated before the cutoff had
    arrived; the refresh brings the late claims of the window in."""
    mk = marks(src)
    early = replaced(src, {})
    early["billing"] = src["billing"].where(F.col("claim_date") < F.lit(mk.cutoff))
    spark = src["encounters"].sparkSession
    layout = FB.declared_layout(spark)
    path = fresh_path(spark, "r_fact_late")
    FB.write_fact(FB.build_fact_encounters(early, mart), path, layout)
    fact0 = FB.read_fact(read_table(spark, path, FB.stored_schema(layout)))
    switched = fresh_path(spark, "r_fact_late")
    FB.write_fact(refresh_late_window(fact0, src, mart, mk.window_start), switched, layout)
    return FB.read_fact(read_table(spark, switched, FB.stored_schema(layout)))


# ---- one day's refresh ---------------------------------------------------------
# natural key and surrogate key of the dimensions that are upserted (Type 1)
UPSERTS = {"dim_specialty": ("specialty_id", "specialty_key"), "dim_department": ("department_id", "department_key"),
           "dim_encounter_type": ("encounter_type_name", "encounter_type_key"),
           "dim_diagnosis": ("diagnosis_id", "diagnosis_key"), "dim_procedure": ("procedure_id", "procedure_key"),
           "dim_provider": ("provider_id", "provider_key"), "dim_patient": ("patient_id", "patient_key")}


def _bridge(old: DataFrame, fact: DataFrame, ids: DataFrame, rows: DataFrame, order: list[str], schema) -> DataFrame:
    """The links of other encounters, and the links of ``ids`` anew with ids after the maximum."""
    keys = fact.join(ids, "encounter_id", "left_semi").select("encounter_key")
    carried = old.join(keys, "encounter_key", "left_anti")
    fresh = U.with_new_keys(rows, order, "bridge_id", U.max_key(old, "bridge_id"))
    return schemas.conform(carried, schema).unionByName(schemas.conform(fresh, schema))


def daily_refresh(mart: dict[str, DataFrame], src: dict[str, DataFrame], run_date: _dt.date, mark: _dt.date,
                      window_days: int = LATE_WINDOW_DAYS, changed: DataFrame | None = None,
                  patient_changes: DataFrame | None = None) -> dict[str, DataFrame]:
    """The mart after one day's load; ``mark``: up to where facts were loaded (kept by the caller
    with the version it switches to), ``changed``: encounters that the extract marks as modified.
    ``patient_changes`` (patient attributes and ``changed_on``) keeps the history of patients (Type 2) in place of their
    upsert; the encounters of these patients are recomputed, as their versions may have moved.

    Facts and bridges are rewritten for the same encounters, so they never drift apart.
    """
    m = dict(mart)
    batches = {"dim_specialty": D.build_dim_specialty(src), "dim_department": D.build_dim_department(src),
               "dim_encounter_type": D.build_dim_encounter_type(src), "dim_diagnosis": D.build_dim_diagnosis(src),
               "dim_procedure": D.build_dim_procedure(src), "dim_patient": D.patient_attributes(src["patients"], run_date)}
    for dim, (nk, key) in UPSERTS.items():
        if dim == "dim_patient" and patient_changes is not None:
            m[dim] = materialize(U.version_chain(with_history(m[dim]), patient_changes, nk, key, TRACKED_PATIENT, "changed_on"), f"r_{dim}")
            continue
        if dim == "dim_provider":
            batches[dim] = D.build_dim_provider(src, m["dim_specialty"], m["dim_department"])
        m[dim] = materialize(U.upsert_type1(m[dim], batches[dim].drop(key), nk, key), f"r_{dim}")
    ids = late_ids(m["fact_encounters"], src, mark - _dt.timedelta(days=window_days))
    ids = ids.unionByName(src["encounters"].select("encounter_id")
                          .join(m["fact_encounters"].select("encounter_id"), "encounter_id", "left_anti"))
    if changed is not None:
        ids = ids.unionByName(changed.select("encounter_id"))
    if patient_changes is not None:
        ids = ids.unionByName(src["encounters"].join(patient_changes.select("patient_id").distinct(), "patient_id", "left_semi")
                              .select("encounter_id"))
    ids = materialize(ids.distinct(), "r_ids")
    touched = materialize(src["encounters"].join(ids, "encounter_id", "left_semi"), "r_touched")
    m["dim_patient"] = materialize(U.placeholders(m["dim_patient"], touched, "patient_id", "patient_key",
                                                  {"current_flag": F.lit(True)}), "r_dim_patient")
    days = touched.select(F.to_date("encounter_date").alias("full_date")).unionByName(
        touched.select(F.to_date("discharge_date").alias("full_date")))
    m["dim_date"] = materialize(extend_calendar(m["dim_date"], days), "r_dim_date")
    m["fact_encounters"] = materialize(recompute(m["fact_encounters"], src, m, ids), "r_fact")
    part = with_encounters(src, touched)
    m["bridge_encounter_diagnoses"] = materialize(_bridge(
        m["bridge_encounter_diagnoses"], m["fact_encounters"], ids,
        FB.bridge_diagnosis_rows(part, m["fact_encounters"], m["dim_diagnosis"]),
        ["encounter_key", "diagnosis_sequence", "diagnosis_key"], schemas.MART["bridge_encounter_diagnoses"]),
        "r_bridge_diagnoses")
    m["bridge_encounter_procedures"] = materialize(_bridge(
        m["bridge_encounter_procedures"], m["fact_encounters"], ids,
        FB.bridge_procedure_rows(part, m["fact_encounters"], m["dim_procedure"]),
        ["encounter_key", "procedure_key"], schemas.MART["bridge_encounter_procedures"]), "r_bridge_procedures")
    return m


def with_history(dim: DataFrame) -> DataFrame:
    """A dimension without history as the first version of every member."""
    if "valid_from" in dim.columns:
        return dim
    return dim.withColumn("valid_from", F.lit(None).cast("date")).withColumn("valid_to", F.lit(None).cast("date"))


def patient_change_batch(src, state, mk: Marks) -> DataFrame:
    """Changes of patients known at the cutoff, by rules on the id: three within a week, two of them equal (3); one that
    arrives late, from before the cutoff (5); one on the day of the stored version (7); and patients not known yet."""
    i, day = F.col("patient_id"), F.lit(mk.cutoff)
    known = D.patient_attributes(known_patients(src, state), mk.cutoff)
    on = lambda df, days: df.withColumn("changed_on", F.date_add(day, days))
    with_gender = lambda g: known.withColumn("gender", F.lit(g))
    third, fifth, seventh = i % 3 == 0, i % 5 == 0, i % 7 == 0
    new = D.patient_attributes(src["patients"].join(known.select("patient_id"), "patient_id", "left_anti"), mk.cutoff)
    return reduce(DataFrame.unionByName, [
        on(with_gender("X").where(third), 1), on(with_gender("X").where(third), 2), on(known.where(third), 5),
        on(known.withColumn("full_name", F.concat("full_name", F.lit(" Jr"))).where(fifth), -30),
        on(with_gender("Y").where(seventh), 0), on(new, 3)])


def history_patient(src, mart) -> DataFrame:
    """T8 with several versions of a member in a batch: the dimension with all spans."""
    mk = marks(src)
    state, _ = split_encounters(src, mk.cutoff)
    dim0 = initial_dim_patient(src, state, mk).withColumn("valid_from", F.lit(mk.cutoff)).withColumn("valid_to", F.lit(None).cast("date"))
    return U.version_chain(dim0, patient_change_batch(src, state, mk), "patient_id", "patient_key", TRACKED_PATIENT, "changed_on")


def history_fact(src, mart) -> DataFrame:
    """T8 in the load: encounters with the patient's name and gender as of the admission day."""
    dim = materialize(history_patient(src, mart), "r_history")
    fact = FB.fact_rows(src, dict(mart, dim_patient=dim))
    return fact.join(dim.select("patient_key", "patient_id", "full_name", "gender"), "patient_key").select(
        "encounter_id", "patient_id", "full_name", "gender")


def refreshed_mart(src) -> dict[str, DataFrame]:
    """The load as of the cutoff (with the claims that had arrived by then), then one refresh to the end."""
    mk = marks(src)
    state, _ = split_encounters(src, mk.cutoff)
    recent = (state["encounters"].where(F.to_date("encounter_date") >= F.lit(mk.window_start))
              .select("encounter_id", F.lit(True).alias("_recent")))
    state["billing"] = (state["billing"].join(recent, "encounter_id", "left")
                        .where(F.col("_recent").isNull() | (F.col("claim_date") < F.lit(mk.cutoff))).drop("_recent"))
    state["patients"] = known_patients(src, state)
    return daily_refresh(FB.build_all(state, mk.cutoff), src, mk.run_date, mk.cutoff)


def daily_refresh_fact(src, mart) -> DataFrame:
    """The fact after load and refresh, by natural keys."""
    return fact_by_natural_keys(refreshed_mart(src))


def fact_by_natural_keys(m: dict[str, DataFrame]) -> DataFrame:
    f = m["fact_encounters"].drop("encounter_key")
    for dim, key, name in (("dim_patient", "patient_key", "patient_id"), ("dim_provider", "provider_key", "provider_id"),
                           ("dim_department", "department_key", "department_id"),
                           ("dim_encounter_type", "encounter_type_key", "encounter_type_name")):
        f = f.join(m[dim].select(key, name), key, "left").drop(key)
    return f


def daily_refresh_bridges(src, mart) -> DataFrame:
    """The links of both bridges after load and refresh, by natural keys."""
    return bridges_by_natural_keys(refreshed_mart(src))


def bridges_by_natural_keys(m: dict[str, DataFrame]) -> DataFrame:
    f = m["fact_encounters"].select("encounter_key", "encounter_id")
    d = (m["bridge_encounter_diagnoses"].join(f, "encounter_key").join(m["dim_diagnosis"], "diagnosis_key")
         .select(F.lit("diagnosis").alias("kind"), "encounter_id", F.col("diagnosis_id").alias("code_id"),
                 F.col("diagnosis_sequence").alias("place")))
    p = (m["bridge_encounter_procedures"].join(f, "encounter_key").join(m["dim_procedure"], "procedure_key")
         .select(F.lit("procedure").alias("kind"), "encounter_id", F.col("procedure_id").alias("code_id"),
                 F.lit(None).cast("int").alias("place")))
    return d.unionByName(p)


# ---- T7 / J15 -------------------------------------------------------------------
def unknown_member_fact(src, mart) -> DataFrame:
    """Failed lookups keep the encounter with key -1 instead of dropping it."""
    return FB.build_fact_encounters(src, mart, on_missing="unknown")
