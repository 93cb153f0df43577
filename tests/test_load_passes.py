"""The snapshot load passes over its rows once: sums beside the digests, periods without a run for ranges, empty batches."""

from decimal import Decimal

from pyspark.sql import functions as F

from starmart.operators import digest as G
from starmart.plans import fact as FB
from starmart.plans import mart_load as ML
from starmart.session import fresh_path
from starmart.sources.snapshots import Snapshots
from starmart.streaming.mart_feed import EVENT, MartFeed


def test_sums_of_the_digest_pass_equal_the_measures(spark):
    amounts = [Decimal("9999999999.99"), Decimal("-9999999999.99"), Decimal("0.01"), Decimal("-0.01"), Decimal("21474836.48"), None]
    bill = [(i, amounts[(i * j) % 6], amounts[(i + j) % 6]) for i in range(1, 9) for j in range(i % 5)]
    bill += [(20, None, Decimal("1.00")), (None, Decimal("5.00"), None), (99, Decimal("7.00"), None), (21, Decimal("9999999999.99"), None)] * 3
    frame = lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3)
    src = {"encounters": frame([(i, "x") for i in [1, 2, 3, 4, 5, 6, 7, 8, 8, 20, 21, 22, None]], "encounter_id bigint, encounter_type string"),
           "billing": frame(bill, "encounter_id bigint, claim_amount decimal(12,2), allowed_amount decimal(12,2)"),
           "encounter_diagnoses": frame([(i % 4, i) for i in range(9)], "encounter_id bigint, diagnosis_id bigint"),
           "encounter_procedures": frame([(8, 1), (8, 1), (20, 2), (None, 3)], "encounter_id bigint, procedure_id bigint")}
    found = ML.measured_digests(src)
    want = src["encounters"].select("encounter_id").where("encounter_id IS NOT NULL").distinct()
    for measure in FB.encounter_measures(src):
        want = want.join(measure, "encounter_id", "left")
    want = want.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("diag_count", "proc_count")})
    want = want.join(ML.encounter_digests(src), "encounter_id").select(found.columns)
    assert dict(found.dtypes) == dict(want.dtypes)
    rows = lambda df: sorted(df.collect(), key=lambda r: r["encounter_id"])
    assert rows(found) == rows(want) and found.count() == 11
    assert {r.encounter_id: r.total_claim for r in found.collect()}[21] == Decimal("29999999999.97")


def test_periods_are_written_by_one_run_of_the_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 4000, 1, 4).selectExpr("id", "CAST(202401 + id % 7 AS INT) AS m").mapInArrow(run, "id bigint, m int")
    log = Snapshots(spark, fresh_path(spark, "periods"))
    files = log.write_periods(rows, "t", F.col("m"), ["id"])
    assert seen.value == 4000 and sorted(files) == list(range(202401, 202408))
    assert all(spark.read.parquet(path).select("m").distinct().collect() == [(p,)] for p, path in files.items())


def test_a_refresh_sums_claims_in_the_pass_of_the_digests(spark, seed, monkeypatch):
    import datetime as dt
    passes = []
    real = G.content_digests
    monkeypatch.setattr(G, "content_digests", lambda *a, **k: passes.append("digests") or real(*a, **k))
    monkeypatch.setattr(FB, "encounter_measures", lambda src: passes.append("measures"))
    load = ML.MartLoad(spark)
    load.full_load(ML.earlier_extract(seed), dt.date(2025, 1, 1))
    load.refresh(seed, dt.date(2025, 2, 1))
    assert passes == ["digests"] * 2


def test_an_empty_batch_reads_no_table(spark, seed, monkeypatch):
    import datetime as dt
    load = ML.MartLoad(spark)
    before = load.full_load(seed, dt.date(2025, 1, 1))
    feed = MartFeed(load, seed, fresh_path(spark, "feed"))
    monkeypatch.setattr(load, "stored", lambda *a, **k: 1 / 0)
    feed.on_batch(spark.createDataFrame([], EVENT), 4)
    after = load.log.current()
    assert after.notes["feed:batch"] == "4" and after.files[ML.FACT] == before.files[ML.FACT]
