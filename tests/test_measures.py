"""Version chains, two-way reconciliation, range lookup, bitmaps and pruned pairs against plain Python."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seed import seed_sources
from starmart.operators import upsert as U
from starmart.operators.pairs import top_pairs
from starmart.operators.ranges import range_lookup
from starmart.plans import bitmaps as BM
from starmart.plans import reconcile as RC
from starmart.plans import refresh as R
from starmart.plans import reports_star as RM
from starmart.plans.fact import build_all

D = dt.date


@pytest.fixture(scope="module")
def base(spark):
    src = seed_sources(spark, edges=True)
    return src, build_all(src, D(2025, 1, 1), calendar="default")


# ---- T8 ----
CHAIN = "k bigint, id bigint, name string, current_flag boolean, valid_from date, valid_to date"


def chain(spark, dim, changes):
    d = spark.createDataFrame(dim, CHAIN)
    c = spark.createDataFrame(changes, "id bigint, name string, day timestamp_ntz")
    rows = U.version_chain(d, c, "id", "k", ["name"], "day").collect()
    return sorted((r.id, r.valid_from or D.min, r.name, r.k, r.current_flag, r.valid_to) for r in rows)


def at(month, day, hour=0):
    return dt.datetime(2024, month, day, hour)


def test_three_changes_give_three_spans(spark):
    dim = [(1, 10, "a", True, D(2024, 1, 1), None), (2, 20, "z", True, None, None)]
    got = chain(spark, dim, [(10, "d", at(4, 1)), (10, "b", at(2, 1)), (10, "c", at(3, 1)), (10, "b", at(2, 9)), (30, "n", at(1, 5)),
                             (None, "x", at(1, 1)), (10, "x", None)])
    assert got == [(10, D(2024, 1, 1), "a", 1, False, D(2024, 2, 1)), (10, D(2024, 2, 1), "b", 3, False, D(2024, 3, 1)),
                   (10, D(2024, 3, 1), "c", 4, False, D(2024, 4, 1)), (10, D(2024, 4, 1), "d", 5, True, None),
                   (20, D.min, "z", 2, True, None), (30, D(2024, 1, 5), "n", 6, True, None)]


def test_out_of_order_changes(spark):
    dim = [(1, 10, "a", False, None, D(2024, 3, 1)), (2, 10, "b", True, D(2024, 3, 1), None)]
    # between the stored ones; the newest of one day wins; one equal to its successor takes over its key
    got = chain(spark, dim, [(10, "x", at(2, 1, 8)), (10, "y", at(2, 1, 9)), (10, "b", at(2, 20))])
    assert got == [(10, D.min, "a", 1, False, D(2024, 2, 1)), (10, D(2024, 2, 1), "y", 3, False, D(2024, 2, 20)),
                   (10, D(2024, 2, 20), "b", 2, True, None)]
    # a change of the day of a stored version takes its place and key; one equal to what holds changes nothing
    assert chain(spark, dim, [(10, "c", at(3, 1, 12)), (10, "a", at(1, 1))]) == [
        (10, D.min, "a", 1, False, D(2024, 3, 1)), (10, D(2024, 3, 1), "c", 2, True, None)]
    assert chain(spark, dim, []) == chain(spark, dim, [(None, "q", at(1, 1))])


def test_chain_against_replay(spark):
    """Random batches in random order end in the spans that sorting all changes gives."""
    rng = random.Random(7)
    truth: dict[int, dict[D, str]] = {}
    dim = []
    for batch in range(3):
        changes = []
        for _ in range(40):
            i, day, name = rng.randrange(6), D(2024, 1, 1) + dt.timedelta(rng.randrange(40)), rng.choice("ab")
            if day not in {c[2].date() for c in changes if c[0] == i}:
                changes.append((i, name, dt.datetime(day.year, day.month, day.day)))
                truth.setdefault(i, {})[day] = name
        got = chain(spark, dim, changes)
        dim = [(k, i, n, c, None if f == D.min else f, t) for i, f, n, k, c, t in got]
        if batch == 0:  # later batches also meet what merging has dropped
            want = []
            for i, days in truth.items():
                last = None
                for day in sorted(days):
                    if days[day] != last:
                        want.append((i, day, days[day]))
                    last = days[day]
            assert [g[:3] for g in got] == sorted(want)
        assert len({g[3] for g in got}) == len(got)
        assert all(a[5] == b[1] for a, b in zip(got, got[1:]) if a[0] == b[0]) and all(g[4] == (g[5] is None) for g in got)


def test_daily_refresh_keeps_history(spark, base):
    src, _ = base
    m0 = build_all(src, D(2024, 6, 1))
    changes = spark.createDataFrame(
        [(1001, f"John {n}", "M", D(1955, 3, 15), "65-74", True, day) for n, day in (("I", at(5, 1)), ("II", at(6, 1)), ("III", at(6, 20)))],
        "patient_id bigint, full_name string, gender string, date_of_birth date, age_group string, current_flag boolean, changed_on timestamp_ntz")
    m = R.daily_refresh(m0, src, D(2024, 12, 1), D(2024, 12, 1), patient_changes=changes)
    names = {r.patient_key: (r.patient_id, r.full_name) for r in m["dim_patient"].collect()}
    assert sum(p == 1001 for p, _ in names.values()) == 4       # the stored version and three spans
    got = {r.encounter_id: names[r.patient_key] for r in m["fact_encounters"].collect()}
    assert got[7001] == (1001, "John I") and got[7002] == (1001, "John II") and got[7003] == (1002, "Jane Smith")
    assert m["fact_encounters"].count() == m0["fact_encounters"].count()


# ---- K6 ----
def test_reconcile_finds_errors_that_cancel(spark, base):
    src, m = base
    f = m["fact_encounters"]
    clean = {(r.encounter_id, r.difference) for r in RC.reconcile(src, m).collect()}
    assert clean == {(7106, "missing in mart")}                 # no provider: dropped by the load
    shift = F.when(F.col("encounter_id") == 7001, 5).when(F.col("encounter_id") == 7002, -5).otherwise(0)
    wrong = f.withColumn("total_claim_amount", (F.col("total_claim_amount") + shift).cast("decimal(12,2)"))
    swapped = F.when(F.col("encounter_id") == 7003, F.col("diagnosis_count") + 1).when(
        F.col("encounter_id") == 7004, F.col("diagnosis_count") - 1).otherwise(F.col("diagnosis_count"))
    wrong = wrong.withColumn("diagnosis_count", swapped).where("encounter_id <> 7105").unionByName(
        f.where("encounter_id = 7107").withColumn("encounter_id", F.lit(9).cast("bigint")))
    total = lambda df: df.agg(F.sum("total_claim_amount"), F.sum("diagnosis_count")).first()
    assert total(wrong.where("encounter_id < 7100 and encounter_id > 9")) == total(f.where("encounter_id < 7100"))
    got = {r.encounter_id: (r.difference, r.measures) for r in RC.reconcile(src, dict(m, fact_encounters=wrong)).collect()}
    assert got == {7001: ("differs", "claim_amount"), 7002: ("differs", "claim_amount"), 7003: ("differs", "diagnoses"),
                   7004: ("differs", "diagnoses"), 7105: ("missing in mart", ""), 9: ("missing in source", ""),
                   7106: ("missing in mart", "")}
    # nothing outside the buckets of these encounters is read again
    buckets = RC.differing_buckets(RC.source_side(src), RC.mart_side(dict(m, fact_encounters=wrong)), 1, None).count()
    assert buckets == len({r[0] for r in spark.createDataFrame([(i,) for i in got], "encounter_id bigint").select(RC._bucket(1)).collect()})


def test_reconcile_counts_a_row_twice(spark, base):
    src, m = base
    twice = m["fact_encounters"].unionByName(m["fact_encounters"].where("encounter_id = 7105"))
    got = {r.encounter_id: r.difference for r in RC.reconcile(src, dict(m, fact_encounters=twice)).collect()}
    assert got == {7105: "differs", 7106: "missing in mart"}


# ---- B12 ----
def test_narrowest_range_wins(spark):
    rng = random.Random(3)
    ranges = [(a, a + rng.choice([0, 3, 40, 200]), f"r{n}") for n, a in enumerate(rng.randrange(500) for _ in range(60))] + [(9, 5, "empty")]
    points = [*range(-5, 720), None]
    rows = spark.createDataFrame([(p, "old") for p in points], "p bigint, label string")
    table = spark.createDataFrame(ranges, "low bigint, high bigint, label string")
    for width in (1, 7, 1000):
        got = {r.p: r.label for r in range_lookup(rows, F.col("p"), table, width, "label").collect()}
        want = {p: min(((h - lo, lo, x) for lo, h, x in ranges if lo <= p <= h), default=(None, None, None))[2] if p is not None else None
                for p in points}
        assert got == want


def test_own_range_table(spark, base):
    _, m = base
    own = spark.createDataFrame([(0, 99999, "any"), (93000, 93999, "heart")], "low bigint, high bigint, category string")
    got = {r.cpt_code: r.category for r in RM.procedure_category_ranges(m, own).collect()}
    assert got == {"99213": "any", "93000": "heart", "71020": "any"}


# ---- A3, A4 ----
def test_bitmaps_merge(spark):
    rng = random.Random(2)
    rows = [(20240100 + rng.randrange(1, 29) + 100 * rng.randrange(3), rng.randrange(1, 4), rng.randrange(1, 3),
             rng.choice([1, 2, 32768, 32769, 70000, rng.randrange(1, 10 ** 6)])) for _ in range(900)]
    m = {"fact_encounters": spark.createDataFrame(rows, "admission_date_key int, provider_key bigint, encounter_type_key bigint, patient_key bigint"),
         "dim_provider": spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "provider_key bigint, specialty_name string"),
         "dim_encounter_type": spark.createDataFrame([(1, "ER"), (2, "In")], "encounter_type_key bigint, encounter_type_name string")}
    stored = BM.patient_bitmaps(m)
    named = [(d // 100, {1: "x", 2: "x", 3: None}[p], {1: "ER", 2: "In"}[t], k) for d, p, t, k in rows]
    for columns in BM.LEVELS:
        at_ = [BM.GRAIN.index(c) for c in columns]
        want = {}
        for row in named:
            want.setdefault(tuple(row[i] for i in at_), []).append(row[3])
        got = {tuple(r[c] for c in columns): (r.total_encounters, r.unique_patients) for r in BM.rolled_up(stored, columns).collect()}
        assert got == {k: (len(v), len(set(v))) for k, v in want.items()}
    assert BM.rolled_up(stored.limit(0), ()).first() == (0, 0)


# ---- S1 ----
def test_source_ids_are_kept(spark, base):
    from starmart.session import fresh_path
    from starmart.sources.normalize import read_sources
    src, _ = base
    folder = fresh_path(spark, "own")
    for table, df in src.items():
        if table == "billing":
            df = df.withColumn("claim_amount", F.col("claim_amount").cast("double")).withColumn("billing_id", F.col("encounter_id") * 2)
        df.write.parquet(f"{folder}/{table}.parquet")
    read = read_sources(spark, folder)
    assert read["billing"].columns[0] == "billing_id" and dict(read["billing"].dtypes)["claim_amount"] == "decimal(12,2)"
    assert read["encounter_diagnoses"].columns == src["encounter_diagnoses"].columns
    from starmart.plans import quality as K
    checked = {(r.table_name, r.key_columns): r.duplicated_keys for r in K.key_uniqueness(read).collect()}
    assert checked["billing", "billing_id"] == 1                 # two claims of 7101


# ---- J13 ----
def test_bucketed_bridges_join_without_an_exchange(spark):
    from starmart.plans.bucketed import BucketedBridges
    rng = random.Random(4)
    dx = [(1 if rng.random() < 0.4 else rng.randrange(2, 200), rng.randrange(90), 1) for _ in range(3000)]  # a hot encounter
    px = [(1 if rng.random() < 0.4 else rng.randrange(2, 200), rng.randrange(70)) for _ in range(2000)]
    m = {"fact_encounters": spark.range(1),
         "bridge_encounter_diagnoses": spark.createDataFrame(dx, "encounter_key bigint, diagnosis_key bigint, s int"),
         "bridge_encounter_procedures": spark.createDataFrame(px, "encounter_key bigint, procedure_key bigint"),
         "dim_diagnosis": spark.createDataFrame([(i, f"d{i % 40:02}") for i in range(90)], "diagnosis_key bigint, icd_code string"),
         "dim_procedure": spark.createDataFrame([(i, f"p{i % 30:02}") for i in range(70)], "procedure_key bigint, cpt_code string")}
    by, want = {}, Counter()
    for e, p in px:
        by.setdefault(e, []).append(f"p{p % 30:02}")
    for e, d, _ in dx:
        want.update((f"d{d % 40:02}", p) for p in by.get(e, []))
    for hot in (20, 10 ** 6):
        stored = BucketedBridges(m, buckets=4, hot=hot, salts=8)
        top = stored.top_pairs(15)
        assert [tuple(r) for r in top.collect()] == sorted(((a, b, n) for (a, b), n in want.items()), key=lambda r: (-r[2], r[0], r[1]))[:15]
        plan = stored.top_pairs(15)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        joined = plan[plan.index("SortMergeJoin"):]
        assert "Exchange" not in joined and "Bucketed: true" in joined
        spread = spark.table(stored.diagnoses).where("encounter_key = 1").select("salt").distinct().count()
        assert spread > 4 if hot == 20 else spread == 1


# ---- O4 ----
def test_pruned_pairs_equal_all_pairs(spark):
    rng = random.Random(5)
    left = [(rng.randrange(300), f"a{int(rng.paretovariate(0.8)) % 80}") for _ in range(3000)]
    right = [(rng.randrange(300), f"b{int(rng.paretovariate(0.8)) % 60}") for _ in range(2500)]
    counts = Counter()
    by_key = {}
    for k, b in right:
        by_key.setdefault(k, []).append(b)
    for k, a in left:
        counts.update((a, b) for b in by_key.get(k, []))
    want = sorted(((a, b, n) for (a, b), n in counts.items()), key=lambda r: (-r[2], r[0], r[1]))
    frames = [spark.createDataFrame(rows, "k int, c string") for rows in (left, right)]
    frames[1] = frames[1].withColumnRenamed("c", "d")
    top, counted = top_pairs(*frames, "k", "c", "d", 10, seeds=6)
    assert [tuple(r) for r in top.collect()] == want[:10]
    held = {(r.c, r.d): r.combination_count for r in counted.collect()}
    assert all(counts[p] == n for p, n in held.items()) and len(held) < len(counts) / 2   # what is counted is counted whole
    few = top_pairs(frames[0].limit(0), frames[1], "k", "c", "d")[0]
    assert few.count() == 0
