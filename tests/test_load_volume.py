"""The steps of the snapshot load move rows once: sequences across partitions, no copy of the extract, nor of keyed rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from starmart.operators import keys
from starmart.plans import mart_load as ML


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_sequence_needs_no_join(spark):
    df = spark.range(3000).select((F.col("id") % 70).alias("g"), (F.col("id") * 7919 % 3001).alias("o"))
    numbered = keys.sequence_within(df, ["g"], ["o"], "s", num_partitions=5)
    assert _exchanges(numbered) == 0
    assert numbered.columns == ["g", "o", "s"]


def test_sequence_over_nulls_repeats_and_hot_groups(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", *["hot"] * 9]), rng.choice([None, *range(400)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, o int").repartition(7)
    order = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0)
    for distinct in (False, True):
        for parts in (1, 6, 40):
            want, held = [], {}
            for g, o in sorted(set(rows) if distinct else rows, key=order):
                held[g] = held.get(g, 0) + 1
                want.append((g, o, held[g]))
            got = [tuple(r) for r in keys.sequence_within(df, ["g"], ["o"], "s", parts, distinct).collect()]
            key = lambda r: (*order(r), r[2])
            assert sorted(got, key=key) == sorted(want, key=key)
    assert keys.sequence_within(df.limit(0), ["g"], ["o"], "s", distinct=True).count() == 0


def test_load_copies_no_extract_and_no_keyed_rows(spark, seed, monkeypatch):
    written = []
    for module in (ML, keys):
        real = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label, *a, real=real: written.append(label) or real(df, label, *a))
    load = ML.MartLoad(spark)
    before = load.full_load(ML.earlier_extract(seed), dt.date(2025, 1, 1))
    after = load.refresh(seed, dt.date(2025, 2, 1))
    assert not {w for w in written if w.startswith("old_")} | ({"after", "links"} & set(written))
    for snapshot in (before, after):
        fact = load.stored(snapshot, ML.FACT).select("encounter_key", F.coalesce(ML.month_of("admission_date_key"), F.lit(0)).alias("m"))
        for bridge in (ML.DIAGNOSES, ML.PROCEDURES):
            for period in snapshot.files[bridge]:
                links = load.stored(snapshot, bridge, {period})
                assert links.join(fact.where(F.col("m") == period), "encounter_key").count() == links.count() > 0
