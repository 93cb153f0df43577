"""Edge rows: the semantic traps of the two models."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seed import seed_sources
from starmart.functions import dates
from starmart.plans import quality as K
from starmart.plans import reports_source as RS
from starmart.plans import reports_star as RM
from starmart.plans.fact import build_all


@pytest.fixture(scope="module")
def edge(spark):
    src = seed_sources(spark, edges=True)
    return src, build_all(src, dt.date(2025, 1, 1), calendar="default", store=False)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_readmission_time_precision_and_attribution(edge):
    src, m = edge
    # source model keeps the time of day: a same-day return after discharge counts,
    # a return on day 30 before the discharge hour counts, day 31 does not
    assert rows(RS.q3_source_provider(src)) == [
        ("Cardiology", 1, 0, Decimal("0.0000")), ("Emergency", 1, 1, Decimal("100.0000")),
        ("Internal Medicine", 2, 1, Decimal("50.0000"))]
    # star compares dates: the same-day return is not "later"
    assert rows(RM.q3_corrected(m)) == [
        ("Cardiology", 1, 0, Decimal("0.0000")), ("Emergency", 1, 1, Decimal("100.0000")),
        ("Internal Medicine", 2, 0, Decimal("0.0000"))]
    # the reference's star query drops a discharge whose only later visit is past day 30
    assert rows(RM.q3_star(m)) == [
        ("Cardiology", 1, 0, Decimal("0.0000")), ("Emergency", 1, 1, Decimal("100.0000")),
        ("Internal Medicine", 1, 0, Decimal("0.0000"))]


def test_fact_edges(edge):
    _, m = edge
    f = {r.encounter_id: r for r in m["fact_encounters"].collect()}
    assert 7106 not in f                                   # no provider: inner lookup drops it
    assert f[7101].total_claim_amount == Decimal("150.00")  # two claims summed, grain kept
    assert f[7101].total_allowed_amount == Decimal("130.00")
    assert f[7105].discharge_date_key is None and f[7105].length_of_stay is None
    assert f[7104].length_of_stay == 0


def test_patient_edges(edge):
    _, m = edge
    p = {r.patient_id: r for r in m["dim_patient"].collect()}
    assert p[1004].full_name is None and p[1004].age_group == "75+"   # null birth date falls through
    assert p[1005].age_group == "15-44"


def test_leap_day_age(spark):
    df = spark.createDataFrame([(dt.date(2004, 2, 29),)], "b date")
    got = df.select(dates.age_in_years(F.col("b"), dt.date(2022, 2, 28)).alias("a"),
                    dates.age_in_years(F.col("b"), dt.date(2022, 3, 1)).alias("b2")).first()
    assert (got.a, got.b2) == (17, 18)


def test_quality_on_edges(edge):
    src, m = edge
    dropped = rows(K.dropped_encounters(src, m))
    assert dropped == [(7106, 1002, None, "no provider")]
    grain = K.fact_grain(m).first()
    assert grain.fact_rows == grain.distinct_encounters
    orphans = {r.relation: r.orphan_rows for r in K.orphan_keys(K.all_tables(src, m)).collect()}
    assert all(v == 0 for v in orphans.values())
    recon = {r.measure: r.difference for r in K.reconciliation(src, m).collect()}
    assert recon["encounters"] == Decimal("1.00")            # the provider-less encounter
    assert recon["allowed_amount"] == Decimal("0.00")


def test_mixed_case_type_is_normalised(spark):
    from starmart.sources.normalize import normalize_sources
    src = seed_sources(spark)
    odd = src["encounters"].withColumn(
        "encounter_type", F.when(F.col("encounter_id") == 7002, F.lit("inpatient")).otherwise(F.col("encounter_type")))
    src = normalize_sources(dict(src, encounters=odd))
    assert rows(RS.q3_source(src)) == [("Cardiology", 1, 0, Decimal("0.0000"))]
    assert rows(src["encounters"].select("encounter_type").distinct()) == [("ER",), ("Inpatient",), ("Outpatient",)]


def test_unknown_member(edge):
    from starmart.plans.dims import add_unknown_member
    from starmart.plans.fact import build_fact_encounters
    src, m = edge
    dims = dict(m, dim_provider=add_unknown_member(m["dim_provider"], "provider_key"))
    f = build_fact_encounters(src, dims, on_missing="unknown")
    got = {r.encounter_id: r.provider_key for r in f.collect()}
    assert got[7106] == -1 and len(got) == len(src["encounters"].collect())
    joined = f.join(dims["dim_provider"], "provider_key").where("encounter_id = 7106").first()
    assert joined.provider_name == "Unknown"


def test_encounter_class_by_setting(seed):
    from starmart.plans.dims import build_dim_encounter_type
    got = sorted((r.encounter_type_name, r.encounter_class)
                 for r in build_dim_encounter_type(seed, class_mode="setting").collect())
    assert got == [("ER", "Emergency care"), ("Inpatient", "Inpatient care"), ("Outpatient", "Ambulatory care")]


def test_code_categories(spark):
    from starmart.functions import codes
    df = spark.createDataFrame([("I10", "99213"), ("E11.9", "93000"), ("S72.0", "71020"), ("ICDX", "ABC"),
                                (None, None)], "icd string, cpt string")
    got = [(r.a, r.b) for r in df.select(codes.icd_category(F.col("icd")).alias("a"),
                                         codes.cpt_category(F.col("cpt")).alias("b")).collect()]
    assert got == [("Circulatory system", "Evaluation and Management"), ("Endocrine and metabolic", "Medicine"),
                   ("Injury and poisoning", "Radiology"), ("Unclassified", "Unclassified"),
                   ("Unclassified", "Unclassified")]


def test_cli_list_and_run(capsys):
    from starmart.__main__ import main
    assert main(["list"]) == 0
    assert "q3_corrected" in capsys.readouterr().out
