"""The load through snapshots: changed encounters by digest, months rewritten alone, one commit for all tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seed import seed_sources
from starmart import schemas
from starmart.operators import digest as G
from starmart.plans import quality as K
from starmart.plans import refresh as R
from starmart.plans.fact import build_all
from starmart.plans.mart_load import DIAGNOSES, FACT, MartLoad, encounter_digests
from starmart.session import fresh_path
from starmart.sources.snapshots import Conflict, Snapshot, Snapshots
from starmart.sources.store import materialize

DAY = dt.date(2024, 12, 1)


@pytest.fixture(scope="module")
def src(spark):
    return {t: materialize(df, f"t_{t}") for t, df in seed_sources(spark, edges=True).items()}


@pytest.fixture(scope="module")
def first(spark, src):
    load = MartLoad(spark)
    return load, load.full_load(src, DAY)


@pytest.fixture()
def loaded(spark, first):
    """A store of its own that starts from the files of the first load."""
    load = MartLoad(spark)
    load.log.commit(Snapshot(), first[1].files, first[1].notes)
    return load


def natural(m):
    fact = R.fact_by_natural_keys(m)
    return (sorted(map(str, fact.select(sorted(fact.columns)).collect())),
            sorted(map(str, R.bridges_by_natural_keys(m).collect())))


def with_rows(src, table, rows):
    extra = src[table].sparkSession.createDataFrame(rows, schemas.SOURCE[table])
    return dict(src, **{table: src[table].unionByName(extra)})


def keys_of(m):
    return {r.encounter_id: r.encounter_key for r in m[FACT].collect()}


def test_full_load_equals_the_plain_build(spark, src, loaded):
    assert natural(loaded.tables()) == natural(build_all(src, DAY))
    assert loaded.log.current().notes["mark"] == "2024-12-01"


def test_digest_sees_every_kind_of_change(spark, src):
    base = {r.encounter_id: r.digest for r in encounter_digests(src).collect()}
    bill, links = src["billing"], src["encounter_diagnoses"]
    cases = {
        "claim changed": dict(src, billing=bill.withColumn("claim_status", F.when(F.col("encounter_id") == 7001, "Denied")
                                                           .otherwise(F.col("claim_status")))),
        "claim twice": dict(src, billing=bill.unionByName(bill.where("encounter_id = 7001"))),
        "claim three times": dict(src, billing=bill.unionByName(bill.where("encounter_id = 7001"))
                                  .unionByName(bill.where("encounter_id = 7001"))),
        "claim gone": dict(src, billing=bill.where("encounter_id <> 7001")),
        "link gone": dict(src, encounter_diagnoses=links.where("NOT (encounter_id = 7001 AND diagnosis_sequence = 2)")),
        "row changed": dict(src, encounters=src["encounters"].withColumn("discharge_date", F.when(
            F.col("encounter_id") != 7001, F.col("discharge_date"))))}
    seen = set()
    for name, other in cases.items():
        now = {r.encounter_id: r.digest for r in encounter_digests(other).collect()}
        changed = {i for i in base if now[i] != base[i]}
        assert changed >= {7001} and (changed == {7001} or name == "row changed"), name
        seen.add(now[7001])
    assert len(seen) == len(cases)
    # order of rows and place of columns don't matter; a null isn't an empty value
    turned = dict(src, billing=bill.orderBy(F.desc("claim_date")).select(*reversed(bill.columns)))
    assert {r.encounter_id: r.digest for r in encounter_digests(turned).collect()} == base
    two = spark.createDataFrame([(1, None, "a"), (2, "a", None)], "k int, x string, y string")
    assert len({r.h for r in two.drop("k").select(G.row_hash(two.drop("k")).alias("h")).collect()}) == 2


def test_refresh_without_changes_keeps_all_files(spark, src, loaded):
    before = loaded.log.current()
    after = loaded.refresh(src, DAY)
    assert after.version == before.version + 1 and after.files == before.files


def test_refresh_finds_new_modified_and_removed(spark, src, loaded):
    before, keys = loaded.log.current(), keys_of(loaded.tables())
    e = src["encounters"]
    now = dict(src, encounters=e.where("encounter_id <> 7103").withColumn("encounter_date", F.when(
        F.col("encounter_id") == 7003, F.lit("2024-06-20 09:00:00").cast("timestamp_ntz")).otherwise(F.col("encounter_date"))))
    now = with_rows(now, "encounters", [(7999, 4242, 101, "ER", dt.datetime(2024, 11, 30, 1), None, 1)])
    now = with_rows(now, "encounter_diagnoses", [(7999, 3002, 1)])
    found = {r.encounter_id: r.change for r in loaded.changes(now).collect()}
    assert found == {7103: "removed", 7003: "modified", 7999: "new", 7106: "new"}   # 7106 has no provider: tried again
    after = loaded.refresh(now, dt.date(2024, 12, 2))
    m = loaded.tables()
    full = build_all(dict(now, patients=now["patients"].unionByName(spark.createDataFrame(
        [(4242, None, None, None, None, None)], schemas.SOURCE["patients"]))), dt.date(2024, 12, 2))
    assert natural(m) == natural(full)
    new_keys = keys_of(m)
    assert all(new_keys[i] == k for i, k in keys.items() if i != 7103) and new_keys[7999] > max(keys.values())
    # May loses 7003, June gains it, July loses 7103, November gains 7999; August and October stay
    rewritten = {p for p, path in after.files[FACT].items() if before.files[FACT].get(p) != path}
    assert rewritten == {202405, 202406, 202407, 202411}
    assert all(before.files[DIAGNOSES][p] == path for p, path in after.files[DIAGNOSES].items() if p not in rewritten)
    assert after.files["dim_specialty"] == before.files["dim_specialty"]
    assert after.files["dim_patient"] != before.files["dim_patient"]
    assert all(r.orphan_rows == 0 for r in K.orphan_keys({t: m[t] for t in m} | src).collect() if r.relation.startswith(("fact", "bridge")))
    # the old snapshot still reads as it was
    assert keys_of(loaded.tables(before)) == keys
    # a key that went is not given again
    again = loaded.refresh(src, dt.date(2024, 12, 3))
    assert keys_of(loaded.tables(again))[7103] > new_keys[7999]
    assert natural(loaded.tables(again))[0] == natural(build_all(src, DAY))[0]


def test_month_that_empties_goes(spark, src, loaded):
    now = dict(src, encounters=src["encounters"].where("encounter_id <> 7108"))
    after = loaded.refresh(now, DAY)
    assert 202411 not in after.files[FACT] and natural(loaded.tables())[0] == natural(build_all(now, DAY))[0]


def test_missing_dates_have_a_period_of_their_own(spark, src, loaded):
    no_date = with_rows(src, "encounters", [(7990, 1001, 101, "ER", None, None, 1)])
    after = loaded.refresh(no_date, DAY)
    assert 0 in after.files[FACT] and 7990 in keys_of(loaded.tables())
    dated = with_rows(src, "encounters", [(7990, 1001, 101, "ER", dt.datetime(2024, 5, 2), None, 1)])
    after = loaded.refresh(dated, DAY)
    assert 0 not in after.files[FACT] and natural(loaded.tables())[0] == natural(build_all(dated, DAY))[0]


def test_only_one_of_two_writers_commits(spark, src, loaded):
    other = MartLoad(spark, loaded.log.root)
    base = other.log.current()
    won = loaded.refresh(src, dt.date(2024, 12, 5))
    with pytest.raises(Conflict):
        other.log.commit(base, {}, {"mark": "2024-12-09"})
    assert other.log.current() == won and other.log.current().notes["mark"] == "2024-12-05"
    assert other.refresh(src, dt.date(2024, 12, 6)).version == won.version + 1


def test_a_failed_refresh_leaves_the_mart_as_it_was(spark, src, loaded):
    before = loaded.log.current()
    too_big = with_rows(src, "billing", [(7001, None, None, None, None)])
    too_big = dict(too_big, billing=too_big["billing"].withColumn("claim_amount", F.when(
        F.col("encounter_id") == 7001, F.lit(9999999999.99)).otherwise(F.col("claim_amount")).cast("decimal(12,2)")))
    with pytest.raises(Exception, match="does not fit"):
        loaded.refresh(too_big, DAY)
    assert loaded.log.current() == before
    with pytest.raises(ValueError, match="loaded up to"):
        loaded.refresh(src, dt.date(2024, 11, 30))


def test_expire_keeps_what_snapshots_name(spark):
    log = Snapshots(spark, fresh_path(spark, "snapshots"))
    rows = lambda n: spark.range(n).selectExpr("id", "CAST(202401 + id AS INT) AS m")
    schema = rows(1).schema
    first = log.commit(Snapshot(), {"t": log.write_periods(rows(3), "t", F.col("m"), ["id"]), "u": log.write(rows(2), "u")}, {"mark": "a"})
    log.write(rows(9), "never_committed")
    changed = {**first.files["t"], **log.write_periods(rows(1), "t", F.col("m"), ["id"])}
    second = log.commit(first, {"t": changed, "v": {}}, {"mark": "b"})
    assert log.versions() == [1, 2] and log.at(1) == first and log.current() == second
    assert log.table(second, "v", schema).count() == 0 and log.table(second, "t", schema, {202402, 202409}).count() == 1
    assert log.expire(1)[1] == []                                # all data is young
    third = log.commit(second, {"u": log.write(rows(5), "u")}, {})
    gone, folders = log.expire(1, older_than_hours=0)
    assert gone == [2] and {f.split("-")[0] for f in folders} == {"never_committed", "u"}
    assert log.table(third, "t", schema).count() == 3 and log.table(third, "u", schema).count() == 5
    assert third.notes["mark"] == "b"
