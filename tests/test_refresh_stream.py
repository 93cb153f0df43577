"""Refresh and streaming properties on the smallest driver tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starmart.plans import catalog, refresh as R
from starmart.sources.generate import generate_sources
from starmart.plans.fact import build_all
from starmart.sources.store import materialize
from starmart.streaming import feed


def _no_key(df, key):
    return sorted(tuple(r) for r in df.drop(key).collect())


def test_part_plus_increment_equals_full(spark):
    src, m = catalog.sources(spark, SF_SMALL), catalog.mart(spark, SF_SMALL)
    inc = R.incremental_facts(src, m)
    assert _no_key(inc, "encounter_key") == _no_key(m["fact_encounters"], "encounter_key")
    keys = [r[0] for r in inc.select("encounter_key").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_incremental_load_is_idempotent(spark):
    src, m = catalog.sources(spark, SF_SMALL), catalog.mart(spark, SF_SMALL)
    once = R.incremental_fact_load(m["fact_encounters"], src, m)
    assert once.count() == m["fact_encounters"].count()      # nothing new: nothing added


def test_late_window_brings_late_claims_in(spark):
    src, m = catalog.sources(spark, SF_SMALL), catalog.mart(spark, SF_SMALL)
    mk = R.marks(src)
    out = R.late_window_refresh(src, m)
    full = {r.encounter_id: r.total_claim_amount for r in m["fact_encounters"].collect()}
    day = {r.encounter_id: r.admission_date_key for r in m["fact_encounters"].collect()}
    start = int(mk.window_start.strftime("%Y%m%d"))
    for r in out.collect():
        if day[r.encounter_id] >= start:
            assert r.total_claim_amount == full[r.encounter_id]
    assert out.count() == m["fact_encounters"].count()


def test_stream_equals_batch(spark):
    t = feed.run_feed(spark, SF_SMALL, files_per_trigger=1)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert t.fact().count() == ev.select("event_id").distinct().count()
    monthly = {(r.month_label, r.encounter_type): (r.total_encounters, r.unique_patients)
               for r in t.monthly().collect()}
    want = {(r.m, r.event_type): (r.n, r.u) for r in ev.groupBy(F.date_format("ts", "yyyy-MM").alias("m"),
                                                                 "event_type")
            .agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("u")).collect()}
    assert monthly == want
    # replaying the same files into the same tables changes nothing
    again = feed.run_feed(spark, SF_SMALL, tables=t)
    assert again.fact().count() == t.fact().count()


def test_generator_volume(spark):
    g = generate_sources(spark, 15000, 15500)
    assert all(df.count() == 500 for df in g.values())
    import datetime as dt
    m = build_all(g, dt.date(2026, 1, 1), calendar="default", store=False)
    assert m["fact_encounters"].count() == 500


def test_late_window_on_month_partitions(spark):
    """Same refresh when the fact is partitioned by month (large-volume layout)."""
    from starmart.plans import fact as FB
    src, m = catalog.sources(spark, SF_SMALL), catalog.mart(spark, SF_SMALL)
    spark.conf.set(FB.FACT_LAYOUT, "month")
    try:
        out = R.late_window_refresh(src, m)
    finally:
        spark.conf.unset(FB.FACT_LAYOUT)
    mk = R.marks(src)
    start = int(mk.window_start.strftime("%Y%m%d"))
    full = {r.encounter_id: r for r in m["fact_encounters"].collect()}
    got = out.collect()
    assert len(got) == len(full)
    for r in got:
        if r.admission_date_key >= start:
            assert r.total_claim_amount == full[r.encounter_id].total_claim_amount
        assert r.encounter_key == full[r.encounter_id].encounter_key


def test_recompute_finds_its_encounters_once(spark, monkeypatch):
    src, m = catalog.sources(spark, SF_SMALL), catalog.mart(spark, SF_SMALL)
    made = {}
    monkeypatch.setattr(R, "materialize", lambda df, label, *a: made.setdefault(label, df) and materialize(df, label, *a))
    R.incremental_fact_load(m["fact_encounters"].where("encounter_id % 5 <> 0"), src, m)
    leaves = made["r_rows"]._jdf.queryExecution().optimizedPlan().collectLeaves()
    reads = [leaves.apply(i).output().toString() for i in range(leaves.size())]
    # the stored fact is read for its keys, not once more for each table that is cut to the encounters
    assert sum("encounter_key" in r for r in reads) == 1
