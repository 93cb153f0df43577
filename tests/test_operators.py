"""Custom operators against brute force on small frames with a hot key."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.keys import assign_dense_key, sequence_within
from starmart.operators.readmission import return_flags
from starmart.operators import upsert as U


def test_dense_key_equals_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.randrange(10**9), f"n{i}") for i in range(3000)]
    df = spark.createDataFrame(data, "nk long, name string").dropDuplicates(["nk"])
    got = {r.nk: r.k for r in assign_dense_key(df, ["nk"], "k", num_partitions=5).collect()}
    want = {r.nk: r.k for r in df.withColumn("k", F.row_number().over(Window.orderBy("nk"))).collect()}
    assert got == want
    assert sorted(got.values()) == list(range(1, len(want) + 1))


def test_sequence_within_hot_group(spark):
    rnd = random.Random(3)
    # one group holds a third of the rows
    data = [(0 if i % 3 == 0 else rnd.randrange(50), i) for i in range(1500)]
    df = spark.createDataFrame(data, "g long, o long")
    got = {(r.g, r.o): r.s for r in sequence_within(df, ["g"], ["o"], "s", num_partitions=6).collect()}
    w = Window.partitionBy("g").orderBy("o")
    want = {(r.g, r.o): r.s for r in df.withColumn("s", F.row_number().over(w)).collect()}
    assert got == want


def _brute(discharges, arrivals, days):
    out = []
    for k, t in discharges:
        later = [a for kk, a in arrivals if kk == k and k is not None and t is not None and a > t]
        within = [a for a in later if a <= t + dt.timedelta(days=days)]
        out.append((k, t, bool(later), bool(within)))
    return sorted(out, key=str)


def test_return_flags_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    arrivals = []
    for i in range(2500):
        k = 1 if i % 3 == 0 else rnd.randrange(40)      # patient 1 is hot
        arrivals.append((k, base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 200))))
    discharges = [(k, a + dt.timedelta(hours=rnd.randrange(0, 200))) for k, a in arrivals[::7]]
    # exact boundary cases: return on day 30 at the same time, day 30 one minute later, same-day later
    t0 = dt.datetime(2024, 3, 1, 12, 0)
    arrivals += [(99, t0 + dt.timedelta(days=30)), (98, t0 + dt.timedelta(days=30, minutes=1)),
                 (97, t0 + dt.timedelta(hours=3)), (96, t0)]
    discharges += [(99, t0), (98, t0), (97, t0), (96, t0), (None, t0), (95, None)]
    a = spark.createDataFrame(arrivals, "k long, a timestamp_ntz")
    q = spark.createDataFrame(discharges, "k long, t timestamp_ntz")
    got = sorted([(r.k, r.t, r.later, r.within) for r in return_flags(q, a, "k", "t", "a", 30).collect()], key=str)
    assert got == _brute(discharges, arrivals, 30)


def test_return_flags_dates(spark):
    a = spark.createDataFrame([(1, dt.date(2024, 1, 31)), (1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1))],
                              "k long, a date")
    q = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 1))],
                              "k long, t date")
    got = {r.k: (r.later, r.within) for r in return_flags(q, a, "k", "t", "a", 30).collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (False, False)}


def _dim(spark):
    return spark.createDataFrame([(1, 10, "a", True), (2, 20, "b", True), (3, 30, "c", True)],
                                 "k long, nk long, attr string, current_flag boolean")


def test_upsert_type1(spark):
    batch = spark.createDataFrame([(20, "B", True), (40, "d", True), (5, "e", True)],
                                  "nk long, attr string, current_flag boolean")
    got = sorted(tuple(r) for r in U.upsert_type1(_dim(spark), batch, "nk", "k").collect())
    assert got == [(1, 10, "a", True), (2, 20, "B", True), (3, 30, "c", True), (4, 5, "e", True),
                   (5, 40, "d", True)]


def test_insert_ignore(spark):
    batch = spark.createDataFrame([(20, "B", True), (40, "d", True)], "nk long, attr string, current_flag boolean")
    got = sorted(tuple(r) for r in U.insert_ignore(_dim(spark), batch, "nk", "k").collect())
    assert got == [(1, 10, "a", True), (2, 20, "b", True), (3, 30, "c", True), (4, 40, "d", True)]


def test_scd_type2(spark):
    d0 = dt.date(2024, 1, 1)
    d1 = dt.date(2024, 6, 1)
    dim = _dim(spark).withColumn("valid_from", F.lit(d0)).withColumn("valid_to", F.lit(None).cast("date"))
    batch = spark.createDataFrame([(20, "B"), (30, "c"), (40, "d")], "nk long, attr string")
    got = sorted(tuple(r) for r in U.scd_type2(dim, batch, "nk", "k", ["attr"], d1).collect())
    assert got == [(1, 10, "a", True, d0, None), (2, 20, "b", False, d0, d1), (3, 30, "c", True, d0, None),
                   (4, 20, "B", True, d1, None), (5, 40, "d", True, d1, None)]


def test_latest_per_key(spark):
    b = spark.createDataFrame([(1, "x", 1), (1, "y", 3), (1, "z", 2), (2, "w", 1)], "nk long, v string, ts int")
    got = sorted(tuple(r) for r in U.latest_per_key(b, "nk", "ts").collect())
    assert got == [(1, "y", 3), (2, "w", 1)]


def test_placeholders(spark):
    refs = spark.createDataFrame([(10,), (50,), (None,), (50,)], "nk long")
    got = sorted(tuple(r) for r in U.placeholders(_dim(spark), refs, "nk", "k",
                                                  {"current_flag": F.lit(True)}).collect())
    assert got[-1] == (4, 50, None, True)


def test_return_flags_property(spark):
    """Random small inputs (nulls, equal times, same-day returns) against brute force."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    base = dt.datetime(2024, 1, 1)
    times = st.one_of(st.none(), st.integers(0, 90 * 24).map(lambda h: base + dt.timedelta(hours=h)))
    keys = st.one_of(st.none(), st.integers(0, 4))
    rows = st.lists(st.tuples(keys, times), max_size=25)

    @settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(arr=rows, dis=rows)
    def check(arr, dis):
        a = spark.createDataFrame(arr, "k long, a timestamp_ntz")
        q = spark.createDataFrame(dis, "k long, t timestamp_ntz")
        got = sorted([(r.k, r.t, r.later, r.within) for r in return_flags(q, a, "k", "t", "a", 30).collect()],
                     key=str)
        clean = [(k, t) for k, t in arr if k is not None and t is not None]
        assert got == _brute(dis, clean, 30)

    check()


def test_upserts_are_idempotent(spark):
    batch = spark.createDataFrame([(20, "B", True), (40, "d", True)], "nk long, attr string, current_flag boolean")
    once = U.upsert_type1(_dim(spark), batch, "nk", "k")
    twice = U.upsert_type1(once, batch, "nk", "k")
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect())
    ig = U.insert_ignore(_dim(spark), batch, "nk", "k")
    assert sorted(tuple(r) for r in U.insert_ignore(ig, batch, "nk", "k").collect()) == \
        sorted(tuple(r) for r in ig.collect())
