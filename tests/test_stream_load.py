"""The load and the monthly table as streams: repeated, late, corrected and empty deliveries."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seed import seed_sources
from starmart import schemas
from starmart.plans import refresh as R
from starmart.plans.fact import build_all
from starmart.plans.mart_load import FACT, MartLoad
from starmart.session import fresh_path
from starmart.sources.snapshots import Snapshot
from starmart.sources.store import materialize, write_table
from starmart.streaming.mart_feed import EVENT, MartFeed
from starmart.streaming.monthly import MonthlyFeed, moves

DAY = dt.date(2024, 5, 12)
TS = dt.datetime


@pytest.fixture(scope="module")
def src(spark):
    return {t: materialize(df, f"t_{t}") for t, df in seed_sources(spark, edges=True).items()}


@pytest.fixture(scope="module")
def first(spark, src):
    load = MartLoad(spark)
    return load.full_load(R.with_encounters(src, src["encounters"].where("encounter_id = 7001")), DAY)


@pytest.fixture()
def feed(spark, src, first):
    load = MartLoad(spark)
    load.log.commit(Snapshot(), first.files, first.notes)
    return MartFeed(load, src, fresh_path(spark, "feed"))


def deliver(feed, src, number, rows):
    """rows: (event id, changed at, encounter id, {column: value})."""
    held = {r.encounter_id: r.asDict() for r in src["encounters"].collect()}
    events = [(e, at, *({**held.get(i, held[7001]), "encounter_id": i, **other}[c] for c in schemas.SOURCE["encounters"].fieldNames()))
              for e, at, i, other in rows]
    spark = feed.load.spark
    write_table(spark.createDataFrame(events, EVENT).coalesce(1), f"{feed.folder}/{number}")
    feed.run()
    return {r.encounter_id: r for r in feed.load.tables()[FACT].collect()}


def test_stream_equals_the_batch_load(spark, src, feed):
    at = TS(2024, 6, 15)
    fact = deliver(feed, src, 0, [(1, at, 7002, {"encounter_date": TS(2024, 4, 2)}), (2, at, 7003, {}),
                                  (3, TS(2024, 6, 14), 7003, {"encounter_type": "ER"})])   # an older version in the same batch
    assert sorted(fact) == [7001, 7002, 7003] and fact[7002].admission_date_key == 20240402
    keys = {i: r.encounter_key for i, r in fact.items()}
    version = feed.load.log.current().version
    # repeated events change nothing; a correction moves 7002 to another month; an unknown patient gets a placeholder
    fact = deliver(feed, src, 1, [(1, at, 7002, {"encounter_date": TS(2024, 4, 2)}), (2, at, 7003, {}),
                                  (4, TS(2024, 6, 16), 7002, {}), (5, at, 7004, {"patient_id": 555})])
    assert fact[7002].admission_date_key == 20240602 and fact[7002].encounter_key == keys[7002]
    assert feed.load.tables()["dim_patient"].where("patient_id = 555").first().full_name is None
    assert 202404 not in feed.load.log.current().files[FACT]
    # an older version that comes later doesn't win, unless it is new; an empty delivery commits nothing but its number
    fact = deliver(feed, src, 2, [(6, TS(2024, 6, 13), 7003, {"encounter_type": "ER"}), (7, TS(2024, 6, 17), 7004, {})])
    now = dict(src, encounters=src["encounters"].where("encounter_id <= 7004"))
    full = R.fact_by_natural_keys(build_all(now, DAY)).select("*")
    cols = sorted(full.columns)
    got = R.fact_by_natural_keys(feed.load.tables())
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, full.select(cols).collect()))
    files = feed.load.log.current().files
    deliver(feed, src, 3, [])
    assert feed.load.log.current().files[FACT] == files[FACT] and feed.load.log.current().version > version
    # a batch run again after its commit does nothing
    before = feed.load.log.current()
    feed.on_batch(spark.createDataFrame([(9, at, *[None] * 7)], EVENT), 0)
    assert feed.load.log.current() == before


def test_late_events_are_counted_and_loaded_later(spark, src, feed):
    deliver(feed, src, 0, [(1, TS(2024, 11, 2), 7108, {})])
    fact = deliver(feed, src, 1, [(2, TS(2024, 7, 1), 7101, {}), (3, TS(2024, 10, 1), 7107, {}), (4, None, 7102, {}), (5, TS(2024, 7, 3), None, {})])
    assert sorted(fact) == [7001, 7102, 7107, 7108]
    assert sorted((r.encounter_id or 0) for r in feed.late_events().collect()) == [0, 7101]
    feed.load_late()
    assert sorted(r.encounter_id for r in feed.load.tables()[FACT].collect()) == [7001, 7101, 7102, 7107, 7108]
    assert feed.late_events().count() == 0


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_monthly_deltas_equal_recomputation(spark):
    feed = MonthlyFeed(spark, fresh_path(spark, "month_feed"))

    def arrive(number, rows):
        write_table(spark.createDataFrame([(i, ts, u, t, 1.0, None) for i, ts, u, t in rows], EVENTS), f"{feed.folder}/{number}")
        feed.run()
        return sorted((r.month_label, r.encounter_type, r.total_encounters, r.unique_patients) for r in feed.table().collect())

    jan, feb = TS(2024, 1, 5), TS(2024, 2, 5)
    assert arrive(0, [(1, jan, 10, "a"), (2, jan, 10, "a"), (3, jan, 11, "a"), (4, feb, 10, "b"), (None, feb, 1, "b")]) == [
        ("2024-01", "a", 3, 2), ("2024-02", "b", 1, 1)]
    held = feed.log.current().files["visits"]
    # 3 moves to February; the patient of 1 changes; 4 is delivered again
    assert arrive(1, [(3, feb, 11, "a"), (1, jan, 12, "a"), (4, feb, 10, "b")]) == [
        ("2024-01", "a", 2, 2), ("2024-02", "a", 1, 1), ("2024-02", "b", 1, 1)]
    # only February: the newest of two events in a batch counts, a null patient is an encounter without a patient
    january = feed.log.current().files["visits"][202401]
    assert january != held[202401]
    assert arrive(2, [(5, feb, None, "b"), (4, TS(2024, 2, 6), 10, "a"), (4, TS(2024, 2, 4), 10, "b")]) == [
        ("2024-01", "a", 2, 2), ("2024-02", "a", 2, 2), ("2024-02", "b", 1, 0)]
    assert feed.log.current().files["visits"][202401] == january
    # a month that empties goes; an empty delivery and a repeated batch change nothing
    table = arrive(3, [(1, feb, 12, "a"), (2, feb, 10, "a")])
    assert {r[0] for r in table} == {"2024-02"} and 202401 not in feed.log.current().files["visits"]
    assert arrive(4, []) == table
    before = feed.log.current()
    feed.on_batch(spark.createDataFrame([(202401, "a", 1, 1)], "encounter_month int, encounter_type string, patient_id bigint, n bigint"), 1)
    assert feed.log.current() == before


class Held:
    """A state as ``moves`` uses it."""
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_a_state_holds_many_encounters():
    columns = ["encounter_id", "encounter_month", "encounter_type", "patient_id", "has_patient", "known", "at", "tie"]
    part = lambda *rows: pd.DataFrame(rows, columns=columns)
    deltas = lambda state, *parts: sorted(
        tuple(None if pd.isna(x) else x for x in r) for f in moves((0,), iter(parts), state) for r in f.itertuples(index=False))
    state = Held()
    assert deltas(state, part((1, 202401, "a", 10, True, True, 5, 1), (2, 202401, "a", 10, True, True, 5, 1)),
                  part((2, 202402, "b", 0, False, True, 6, 1), (1, 202403, "a", 10, True, True, 4, 9))) == [
        (202401, "a", 10, 1), (202402, "b", None, 1)]
    assert deltas(state, part((1, 202401, "a", 10, True, True, 5, 1))) == []
    assert deltas(state, part((2, 202401, "a", 10, True, True, 7, 1), (3, 202401, "a", 10, True, True, 7, 1))) == [
        (202401, "a", 10, 2), (202402, "b", None, -1)]


def test_patients_beyond_doubles_stay_apart(spark):
    feed, jan = MonthlyFeed(spark, fresh_path(spark, "month_feed")), TS(2024, 1, 5)
    users = [2 ** 53, 2 ** 53 + 1, None]
    write_table(spark.createDataFrame([(i, jan, u, "a", 1.0, None) for i, u in enumerate(users)], EVENTS).coalesce(1), f"{feed.folder}/0")
    feed.run()
    assert [(r.total_encounters, r.unique_patients) for r in feed.table().collect()] == [(3, 2)]
