"""Load and refresh rules that the driver tables do not reach."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seed import seed_sources
from starmart.functions import codes
from starmart.operators import upsert as U
from starmart.plans import quality as K
from starmart.plans import refresh as R
from starmart.plans import reports_star as RM
from starmart.plans.fact import build_all, build_fact_encounters
from starmart.streaming import feed

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@pytest.fixture(scope="module")
def base(spark):
    src = seed_sources(spark)
    return src, build_all(src, dt.date(2025, 1, 1), calendar="default")


def with_dates(src, spark, moved: dict):
    """Sources with other admission dates for some encounters."""
    e = src["encounters"]
    for i, day in moved.items():
        new = F.lit(day).cast("timestamp_ntz")
        e = e.withColumn("encounter_date", F.when(F.col("encounter_id") == i, new).otherwise(F.col("encounter_date")))
    return dict(src, encounters=e)


def test_late_window_splits_by_encounter(spark, base):
    src, m = base
    old = with_dates(src, spark, {7003: None})             # a stored row without an admission date
    fact0 = build_fact_encounters(old, m).cache()
    # 7002 leaves the window (June on), 7001 enters it
    now = with_dates(old, spark, {7002: "2024-01-05 10:00:00", 7001: "2024-06-20 10:00:00"})
    out = {r.encounter_id: r for r in R.refresh_late_window(fact0, now, m, dt.date(2024, 6, 1)).collect()}
    assert sorted(out) == [7001, 7002, 7003, 7004]
    assert R.refresh_late_window(fact0, now, m, dt.date(2024, 6, 1)).count() == 4
    assert out[7003].admission_date_key is None
    assert (out[7001].admission_date_key, out[7002].admission_date_key) == (20240620, 20240105)
    keys = {r.encounter_id: r.encounter_key for r in fact0.collect()}
    assert all(out[i].encounter_key == k for i, k in keys.items())


def test_incremental_load_takes_changed_rows(spark, base):
    src, m = base
    e = src["encounters"].withColumn("discharge_date", F.when(
        F.col("encounter_id") == 7002, F.lit("2024-06-12 09:00:00").cast("timestamp_ntz")).otherwise(F.col("discharge_date")))
    changed = spark.createDataFrame([(7002,)], "encounter_id bigint")
    out = R.incremental_fact_load(m["fact_encounters"], dict(src, encounters=e), m, changed)
    assert {r.encounter_id: r.length_of_stay for r in out.collect()}[7002] == 10 and out.count() == 4


def test_daily_refresh_keeps_bridges_with_the_fact(spark, base):
    src, _ = base
    first = src["encounters"].where("encounter_id < 7004")
    state = R.with_encounters(src, first)
    m0 = build_all(dict(state, patients=src["patients"].where("patient_id < 1003")), dt.date(2024, 6, 10))
    m = R.daily_refresh(m0, src, dt.date(2024, 6, 14), dt.date(2024, 6, 10))
    full = build_all(src, dt.date(2024, 6, 14))
    assert m["fact_encounters"].count() == full["fact_encounters"].count() == 4
    assert m["bridge_encounter_diagnoses"].count() == full["bridge_encounter_diagnoses"].count() == 6
    assert m["bridge_encounter_procedures"].count() == full["bridge_encounter_procedures"].count()
    for row in K.orphan_keys(K.all_tables(src, m)).collect():
        assert row.orphan_rows == 0, row
    for row in K.key_uniqueness(K.all_tables(src, m)).collect():
        assert row.duplicated_keys == 0, row


DIM = "patient_key bigint, patient_id bigint, name string"


def test_upserts_reduce_the_batch(spark):
    dim = spark.createDataFrame([(1, 10, "old"), (2, 20, "kept")], DIM)
    batch = spark.createDataFrame([(10, "first", 1), (10, "second", 2), (30, "b", None), (30, "a", 5), (None, "lost", 1)],
                                  "patient_id bigint, name string, version int")
    one = sorted(map(tuple, U.upsert_type1(dim, batch, "patient_id", "patient_key", "version").collect()))
    assert one == [(1, 10, "second"), (2, 20, "kept"), (3, 30, "a")]
    ignored = sorted(map(tuple, U.insert_ignore(dim, batch, "patient_id", "patient_key", "version").collect()))
    assert ignored == [(1, 10, "old"), (2, 20, "kept"), (3, 30, "a")]
    assert U.rejected(batch, "patient_id").count() == 1
    nulls = spark.createDataFrame([(5, "x", None)], "patient_id bigint, name string, version int")
    assert U.latest_per_key(nulls, "patient_id", "version").first().name == "x"


def test_versioned_dimension_does_not_fan_out(spark, base):
    src, m = base
    day = dt.date(2024, 6, 1)
    old = m["dim_patient"].withColumn("valid_from", F.lit(dt.date(2024, 5, 1))).withColumn("valid_to", F.lit(None).cast("date"))
    changed = m["dim_patient"].drop("patient_key").withColumn("gender", F.lit("X"))
    dim = U.scd_type2(old, changed, "patient_id", "patient_key", ["gender"], day)
    assert dim.count() == 6
    fact = build_fact_encounters(src, dict(m, dim_patient=dim))
    assert fact.count() == 4
    version = {r.patient_key: r.gender for r in dim.collect()}
    got = {r.encounter_id: version[r.patient_key] for r in fact.collect()}
    assert got[7001] != "X" and got[7003] != "X" and got[7002] == got[7004] == "X"


def test_unknown_member_end_to_end(spark):
    src = seed_sources(spark, edges=True)
    m = build_all(src, dt.date(2025, 1, 1), calendar="default", on_missing="unknown")
    assert sum(r.total_encounters for r in RM.q1_star(m).collect()) == src["encounters"].count()
    row = m["fact_encounters"].where("encounter_id = 7106").first()
    assert (row.provider_key, row.department_key) == (-1, -1)
    assert all(r.orphan_rows == 0 for r in K.orphan_keys(K.all_tables(src, m)).collect())


def test_calendar_gap_counts_as_a_later_visit(spark, base):
    src, _ = base
    e = src["encounters"].where("encounter_id in (7002, 7004)").withColumn(
        "patient_id", F.lit(1001).cast("bigint")).withColumn(
        "encounter_date", F.when(F.col("encounter_id") == 7004, F.lit("2041-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("encounter_date"))).withColumn(
        "discharge_date", F.when(F.col("encounter_id") == 7004, F.lit(None)).otherwise(F.col("discharge_date")))
    m = build_all(dict(src, encounters=e), dt.date(2025, 1, 1), calendar="default", store=False)
    assert RM.q3_star(m).collect() == []                    # the visit is later, but on no calendar day
    assert [tuple(r) for r in RM.q3_corrected(m).collect()] == [("Cardiology", 1, 0, Decimal("0.0000"))]


def test_rate_has_four_decimals(spark):
    from starmart.functions.numeric import rate_percent_text
    rows = spark.sql(f"SELECT {rate_percent_text('a', 'b')} AS r FROM VALUES (143, 848), (1, 3), (2, 3), (0, 5), (1, 0) AS t(a, b)")
    assert [r.r for r in rows.collect()] == [Decimal("16.8632"), Decimal("33.3333"), Decimal("66.6667"), Decimal("0.0000"), None]


def test_icd_10_cm_ranges(spark):
    want = {"C4A.0": "Neoplasms", "D49.0": "Neoplasms", "M1A.0": "Musculoskeletal", "O9A.1": "Pregnancy and childbirth",
            "V00.1": "External causes", "Y99.8": "External causes", "D50": "Blood and immune", "T89": "Unclassified",
            "1A0": "Unclassified"}
    df = spark.createDataFrame([(c,) for c in want], "c string").select("c", codes.icd_category(F.col("c")).alias("k"))
    assert {r.c: r.k for r in df.collect()} == want


def test_types_with_blanks_are_reported(spark):
    from starmart.sources.normalize import normalize_sources
    src = seed_sources(spark)
    odd = src["encounters"].withColumn("encounter_type", F.when(F.col("encounter_id") == 7002, F.lit(" Inpatient"))
                                       .when(F.col("encounter_id") == 7001, F.lit("OUTPATIENT"))
                                       .otherwise(F.col("encounter_type")))
    bad = K.encounter_type_domain(normalize_sources(dict(src, encounters=odd))).collect()
    assert [(r.encounter_type, r.bad_rows) for r in bad] == [(" Inpatient", 1)]


def test_stream_is_lossless(spark, tmp_path):
    def event(i, day, kind="ER", value=1.0):
        return (i, dt.datetime.fromisoformat(day), 5, kind, value, None)
    files = [[event(1, "2024-06-01"), event(2, "2024-06-01")], [event(3, "2024-06-02")], [event(4, "2024-01-05")],
             [event(1, "2024-06-01", "Inpatient", 99.0)], [event(2, "2024-02-01", "ER", 7.0)]]
    where = f"{tmp_path}/events.parquet"
    tables = feed.StreamTables(spark)
    for rows in files:  # one file a run: each start resumes from the checkpoint
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(where)
        feed.run_feed(spark, str(tmp_path), tables)
    want = {1: ("Inpatient", Decimal("99.00"), 202406), 2: ("ER", Decimal("7.00"), 202402),
            3: ("ER", Decimal("1.00"), 202406), 4: ("ER", Decimal("1.00"), 202401)}
    for t in (tables, tables.compact()):
        got = t.fact().collect()
        assert {r.encounter_id: (r.encounter_type, r.amount, r.encounter_month) for r in got} == want
        assert len(got) == 4
    assert sum(r.total_encounters for r in tables.monthly().collect()) == 4


def test_versions_are_switched_by_a_stored_pointer(spark, tmp_path):
    from starmart.sources.store import current, publish
    root = str(tmp_path / "fact")
    assert current(spark, root) is None
    assert publish(spark, root, "/a", "2024-06-01") == 1 and publish(spark, root, "/b") == 2
    assert current(spark, root) == (2, "/b", None)
