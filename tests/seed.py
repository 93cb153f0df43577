"""Seed fixture: the reference's four-encounter sample, re-typed as Spark rows,
plus edge rows for the semantics the sample does not reach."""

from __future__ import annotations

import datetime as dt

from starmart import schemas

D = dt.date
TS = dt.datetime

# The reference's seed rows (specialties .. encounter_procedures).
SPECIALTIES = [(1, "Cardiology", "CARD"), (2, "Internal Medicine", "IM"), (3, "Emergency", "ER")]
DEPARTMENTS = [(1, "Cardiology Unit", 3, 20), (2, "Internal Medicine", 2, 30), (3, "Emergency", 1, 45)]
PROVIDERS = [(101, "James", "Chen", "MD", 1, 1), (102, "Sarah", "Williams", "MD", 2, 2),
             (103, "Michael", "Rodriguez", "MD", 3, 3)]
PATIENTS = [(1001, "John", "Doe", D(1955, 3, 15), "M", "MRN001"),
            (1002, "Jane", "Smith", D(1962, 7, 22), "F", "MRN002"),
            (1003, "Robert", "Johnson", D(1948, 11, 8), "M", "MRN003")]
DIAGNOSES = [(3001, "I10", "Hypertension"), (3002, "E11.9", "Type 2 Diabetes"), (3003, "I50.9", "Heart Failure")]
PROCEDURES = [(4001, "99213", "Office Visit"), (4002, "93000", "EKG"), (4003, "71020", "Chest X-ray")]
BILLING = [(7001, 350, 280, D(2024, 5, 11), "Paid"), (7002, 12500, 10000, D(2024, 6, 8), "Paid")]
ENCOUNTERS = [
    (7001, 1001, 101, "Outpatient", TS(2024, 5, 10, 10, 0), TS(2024, 5, 10, 11, 30), 1),
    (7002, 1001, 101, "Inpatient", TS(2024, 6, 2, 14, 0), TS(2024, 6, 6, 9, 0), 1),
    (7003, 1002, 102, "Outpatient", TS(2024, 5, 15, 9, 0), TS(2024, 5, 15, 10, 15), 2),
    (7004, 1003, 103, "ER", TS(2024, 6, 12, 23, 45), TS(2024, 6, 13, 6, 30), 3),
]
ENCOUNTER_DIAGNOSES = [(7001, 3001, 1), (7001, 3002, 2), (7002, 3001, 1), (7002, 3003, 2), (7003, 3002, 1),
                       (7004, 3001, 1)]
ENCOUNTER_PROCEDURES = [(7001, 4001, D(2024, 5, 10)), (7001, 4002, D(2024, 5, 10)), (7002, 4001, D(2024, 6, 2)),
                        (7003, 4001, D(2024, 5, 15))]

# Edge rows: null birth date, 29 February birth, null discharge, provider-less
# encounter, two claims on one encounter, returns on the discharge day, on day 30
# and on day 31 after a discharge.
EDGE_PATIENTS = [(1004, "Nora", None, None, "F", "MRN004"), (1005, "Leap", "Day", D(2004, 2, 29), "F", "MRN005")]
EDGE_ENCOUNTERS = [
    (7101, 1004, 102, "Inpatient", TS(2024, 7, 1, 8, 0), TS(2024, 7, 3, 12, 0), 2),
    (7102, 1004, 102, "Outpatient", TS(2024, 7, 3, 18, 0), TS(2024, 7, 3, 19, 0), 2),   # same day, later
    (7103, 1005, 103, "Inpatient", TS(2024, 7, 1, 8, 0), TS(2024, 7, 5, 10, 0), 3),
    (7104, 1005, 103, "ER", TS(2024, 8, 4, 9, 0), TS(2024, 8, 4, 9, 30), 3),           # day 30, earlier hour
    (7105, 1003, 101, "Inpatient", TS(2024, 9, 1, 8, 0), None, 1),                    # still admitted
    (7106, 1002, None, "Outpatient", TS(2024, 9, 2, 8, 0), TS(2024, 9, 2, 9, 0), None),  # no provider
    (7107, 1002, 102, "Inpatient", TS(2024, 10, 1, 8, 0), TS(2024, 10, 2, 8, 0), 2),
    (7108, 1002, 102, "Outpatient", TS(2024, 11, 2, 9, 0), TS(2024, 11, 2, 10, 0), 2),  # day 31
]
EDGE_BILLING = [(7101, 100, 90, D(2024, 7, 4), "Paid"), (7101, 50, 40, D(2024, 7, 20), "Submitted")]


def seed_sources(spark, edges: bool = False) -> dict:
    rows = {
        "specialties": SPECIALTIES, "departments": DEPARTMENTS, "providers": PROVIDERS,
        "patients": PATIENTS + (EDGE_PATIENTS if edges else []),
        "diagnoses": DIAGNOSES, "procedures": PROCEDURES,
        "billing": [(e, float(c), float(a), d, s) for e, c, a, d, s in BILLING + (EDGE_BILLING if edges else [])],
        "encounters": ENCOUNTERS + (EDGE_ENCOUNTERS if edges else []),
        "encounter_diagnoses": ENCOUNTER_DIAGNOSES, "encounter_procedures": ENCOUNTER_PROCEDURES,
    }
    out = {}
    for name, data in rows.items():
        sch = schemas.SOURCE[name]
        if name == "billing":
            from pyspark.sql import types as T
            loose = T.StructType([T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType)
                                                else f.dataType) for f in sch.fields])
            out[name] = schemas.conform(spark.createDataFrame(data, loose), sch)
        else:
            out[name] = spark.createDataFrame(data, sch)
    return out
