"""Hot keys: one patient with a third of all encounters, one encounter with a third
of all junction rows.  The Spark plans (day-table readmission, pre-aggregated
pair counts) must give exactly what the plain self-join SQL gives."""

import datetime as dt
import random

import duckdb
import pytest

from starmart import oracle, schemas
from starmart.plans import reports_source as RS
from tests_helpers import normalise


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    specialties = [(1, "Cardiology", "CAR"), (2, "Oncology", "ONC"), (3, "Surgery", "SUR")]
    departments = [(1, "North", 1, 10), (2, "South", 2, 20)]
    providers = [(i, "P", str(i), "MD", 1 + i % 3, 1 + i % 2) for i in range(1, 8)]
    encounters = []
    for e in range(1, 3001):
        patient = 1 if e % 3 == 0 else rnd.randrange(2, 200)
        start = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 300))
        stay = None if e % 23 == 0 else start + dt.timedelta(hours=rnd.randrange(0, 24 * 6))
        typ = ["Inpatient", "Outpatient", "ER"][rnd.randrange(3)]
        encounters.append((e, patient, 1 + e % 7, typ, start, stay, 1 + (1 + e % 7) % 2))
    diagnoses = [(d, f"D{d % 40:02d}", "x") for d in range(1, 301)]
    procedures = [(p, f"{10000 + p * 7:05d}", "y") for p in range(1, 31)]
    ed, ep = set(), set()
    for i in range(4000):
        enc = 1 if i % 3 == 0 else rnd.randrange(2, 3001)
        ed.add((enc, rnd.randrange(1, 301)))
        ep.add((enc, rnd.randrange(1, 31)))
    ed_rows = [(e, d, 1) for e, d in sorted(ed)]
    ep_rows = [(e, p, dt.date(2024, 1, 1)) for e, p in sorted(ep)]
    rows = dict(specialties=specialties, departments=departments, providers=providers, encounters=encounters,
                diagnoses=diagnoses, procedures=procedures, encounter_diagnoses=ed_rows,
                encounter_procedures=ep_rows,
                patients=[(p, "F", str(p), dt.date(1950 + p % 60, 1 + p % 12, 1), "MF"[p % 2], f"M{p}")
                          for p in range(1, 200)],
                billing=[(e, float(e % 97), float(e % 89), dt.date(2024, 1 + e % 12, 1), "Paid")
                         for e in range(1, 3001, 2)])
    out = {}
    for k, v in rows.items():
        sch = schemas.SOURCE[k]
        if k == "billing":
            from pyspark.sql import types as T
            loose = T.StructType([T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType)
                                                else f.dataType) for f in sch.fields])
            out[k] = schemas.conform(spark.createDataFrame(v, loose), sch)
        else:
            out[k] = spark.createDataFrame(v, sch)
    return out


@pytest.fixture(scope="module")
def duck(skewed):
    con = duckdb.connect()
    for name, df in skewed.items():
        con.register(f"{name}_pd", df.toPandas())
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_pd")
    return con


@pytest.mark.parametrize("name", ["q3_source", "q3_source_provider", "q2_source"])
def test_hot_keys_match_plain_sql(skewed, duck, name):
    got = getattr(RS, name)(skewed)
    res = duck.execute(oracle.over_loaded_tables(name))
    want_cols = [d[0] for d in res.description]
    assert sorted(got.columns) == sorted(want_cols)
    assert normalise(got.columns, [tuple(r) for r in got.collect()]) == normalise(want_cols, res.fetchall())


@pytest.fixture(scope="module")
def skewed_mart(skewed):
    from starmart.plans.fact import build_all
    return build_all(skewed, dt.date(2025, 1, 1), calendar="default", store=False)


@pytest.mark.parametrize("name", ["q3_star", "q3_corrected", "q2_star", "q1_star"])
def test_hot_keys_star(skewed_mart, name):
    from starmart.plans import reports_star as RM
    con = duckdb.connect()
    for t, df in skewed_mart.items():
        con.register(f"{t}_pd", df.toPandas())
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM {t}_pd")
    got = getattr(RM, name)(skewed_mart)
    res = con.execute(oracle.over_loaded_tables(name))
    want_cols = [d[0] for d in res.description]
    assert normalise(got.columns, [tuple(r) for r in got.collect()]) == normalise(want_cols, res.fetchall())
