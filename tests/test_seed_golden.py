"""Golden results on the reference's seed rows."""

from decimal import Decimal

from starmart.plans import reports_source as RS
from starmart.plans import reports_star as RM


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_q1_source(seed):
    got = sorted(rows(RS.q1_source(seed)))
    assert got == [("2024-05", "Cardiology", "Outpatient", 1, 1), ("2024-05", "Internal Medicine", "Outpatient", 1, 1),
                   ("2024-06", "Cardiology", "Inpatient", 1, 1), ("2024-06", "Emergency", "ER", 1, 1)]


def test_q2_both_models(seed, seed_mart):
    want = [("E11.9", "99213", 2), ("I10", "99213", 2), ("E11.9", "93000", 1), ("I10", "93000", 1),
            ("I50.9", "99213", 1)]
    assert rows(RS.q2_source(seed)) == want
    assert rows(RM.q2_star(seed_mart)) == want


def test_q3_all_forms(seed, seed_mart):
    want = [("Cardiology", 1, 0, Decimal("0.0000"))]
    assert rows(RS.q3_source(seed)) == want
    assert rows(RS.q3_source_provider(seed)) == want
    assert rows(RM.q3_star(seed_mart)) == want
    assert rows(RM.q3_corrected(seed_mart)) == want


def test_q4_both_models(seed, seed_mart):
    assert rows(RS.q4_source(seed)) == [("2024-05", "Cardiology", Decimal("280.00")),
                                        ("2024-06", "Cardiology", Decimal("10000.00"))]
    got = sorted(rows(RM.q4_star(seed_mart)))
    assert got == sorted([(2024, "May", "Cardiology", Decimal("280.00")),
                          (2024, "May", "Internal Medicine", Decimal("0.00")),
                          (2024, "June", "Cardiology", Decimal("10000.00")),
                          (2024, "June", "Emergency", Decimal("0.00"))])


def test_q1_star_matches_source_counts(seed, seed_mart):
    got = sorted(rows(RM.q1_star(seed_mart)))
    assert got == [(2024, 5, "Cardiology", "Outpatient", 1, 1), (2024, 5, "Internal Medicine", "Outpatient", 1, 1),
                   (2024, 6, "Cardiology", "Inpatient", 1, 1), (2024, 6, "Emergency", "ER", 1, 1)]


def test_fact_per_encounter(seed_mart):
    f = {r.encounter_id: r for r in seed_mart["fact_encounters"].collect()}
    assert sorted(f) == [7001, 7002, 7003, 7004]
    assert [f[i].length_of_stay for i in sorted(f)] == [0, 4, 0, 1]
    assert [f[i].total_claim_amount for i in sorted(f)] == [Decimal(x) for x in ("350.00", "12500.00", "0", "0")]
    assert [f[i].total_allowed_amount for i in sorted(f)] == [Decimal(x) for x in ("280.00", "10000.00", "0", "0")]
    assert [f[i].diagnosis_count for i in sorted(f)] == [2, 2, 1, 1]
    assert [f[i].procedure_count for i in sorted(f)] == [2, 1, 1, 0]
    assert [f[i].admission_date_key for i in sorted(f)] == [20240510, 20240602, 20240515, 20240612]
    assert [f[i].discharge_date_key for i in sorted(f)] == [20240510, 20240606, 20240515, 20240613]
    assert [f[i].encounter_key for i in sorted(f)] == [1, 2, 3, 4]


def test_dim_date_calendar(seed_mart):
    d = seed_mart["dim_date"]
    assert d.count() == 7671
    r = d.where("date_key = 20240607").first()          # a Friday
    assert (r.day_of_week, r.is_weekend, r.month_name, r.quarter) == ("6", True, "June", 2)
    assert d.where("date_key = 20240609").first().day_of_week == "1"    # Sunday


def test_dims(seed_mart):
    p = {r.patient_id: r for r in seed_mart["dim_patient"].collect()}
    assert p[1001].full_name == "John Doe" and p[1001].age_group == "65-74" and p[1001].current_flag
    assert p[1003].age_group == "75+"
    prov = {r.provider_id: r for r in seed_mart["dim_provider"].collect()}
    assert prov[101].provider_name == "James Chen" and prov[101].credential is None
    assert prov[101].specialty_name == "Cardiology" and prov[101].department_name == "Cardiology Unit"
    t = sorted(rows(seed_mart["dim_encounter_type"]))
    assert t == [(1, "ER", "General"), (2, "Inpatient", "General"), (3, "Outpatient", "General")]
    b = seed_mart["bridge_encounter_diagnoses"].count(), seed_mart["bridge_encounter_procedures"].count()
    assert b == (6, 4)
