"""Schemas of the ten source tables and of the star mart.

Ids and surrogate keys are BIGINT, date keys INT (YYYYMMDD), money
DECIMAL(12,2), counts and length of stay INT.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S = T.LongType(), T.IntegerType(), T.StringType()
D, TS, B = T.DateType(), T.TimestampNTZType(), T.BooleanType()
MONEY = T.DecimalType(12, 2)


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SOURCE = {
    "patients": _st(("patient_id", L), ("first_name", S), ("last_name", S),
                    ("date_of_birth", D), ("gender", S), ("mrn", S)),
    "specialties": _st(("specialty_id", L), ("specialty_name", S), ("specialty_code", S)),
    "departments": _st(("department_id", L), ("department_name", S), ("floor", I), ("capacity", I)),
    "providers": _st(("provider_id", L), ("first_name", S), ("last_name", S), ("credential", S),
                     ("specialty_id", L), ("department_id", L)),
    "encounters": _st(("encounter_id", L), ("patient_id", L), ("provider_id", L),
                      ("encounter_type", S), ("encounter_date", TS), ("discharge_date", TS),
                      ("department_id", L)),
    "diagnoses": _st(("diagnosis_id", L), ("icd10_code", S), ("icd10_description", S)),
    "encounter_diagnoses": _st(("encounter_id", L), ("diagnosis_id", L), ("diagnosis_sequence", I)),
    "procedures": _st(("procedure_id", L), ("cpt_code", S), ("cpt_description", S)),
    "encounter_procedures": _st(("encounter_id", L), ("procedure_id", L), ("procedure_date", D)),
    "billing": _st(("encounter_id", L), ("claim_amount", MONEY), ("allowed_amount", MONEY),
                   ("claim_date", D), ("claim_status", S)),
}

#: ids that some sources give their rows; kept where a source has them, checked by K1
OPTIONAL_IDS = {"billing": "billing_id", "encounter_diagnoses": "encounter_diagnosis_id",
                "encounter_procedures": "encounter_procedure_id"}

#: domain of the encounter type (K7), canonical spelling
ENCOUNTER_TYPES = ["Outpatient", "Inpatient", "ER"]

MART = {
    "dim_date": _st(("date_key", I), ("full_date", D), ("year", I), ("month", I), ("month_name", S),
                    ("quarter", I), ("day_of_week", S), ("is_weekend", B)),
    "dim_specialty": _st(("specialty_key", L), ("specialty_id", L), ("specialty_name", S)),
    "dim_department": _st(("department_key", L), ("department_id", L), ("department_name", S),
                          ("floor", I)),
    "dim_encounter_type": _st(("encounter_type_key", L), ("encounter_type_name", S),
                              ("encounter_class", S)),
    "dim_patient": _st(("patient_key", L), ("patient_id", L), ("full_name", S), ("gender", S),
                       ("date_of_birth", D), ("age_group", S), ("current_flag", B)),
    "dim_provider": _st(("provider_key", L), ("provider_id", L), ("provider_name", S),
                        ("credential", S), ("specialty_name", S), ("department_name", S)),
    "dim_diagnosis": _st(("diagnosis_key", L), ("diagnosis_id", L), ("icd_code", S),
                         ("diagnosis_description", S), ("category", S)),
    "dim_procedure": _st(("procedure_key", L), ("procedure_id", L), ("cpt_code", S),
                         ("procedure_description", S), ("category", S)),
    "fact_encounters": _st(("encounter_key", L), ("encounter_id", L), ("admission_date_key", I),
                           ("discharge_date_key", I), ("patient_key", L), ("provider_key", L),
                           ("department_key", L), ("encounter_type_key", L), ("length_of_stay", I),
                           ("total_claim_amount", MONEY), ("total_allowed_amount", MONEY),
                           ("diagnosis_count", I), ("procedure_count", I)),
    "bridge_encounter_diagnoses": _st(("bridge_id", L), ("encounter_key", L), ("diagnosis_key", L),
                                      ("diagnosis_sequence", I)),
    "bridge_encounter_procedures": _st(("bridge_id", L), ("encounter_key", L), ("procedure_key", L)),
}

# Raw driver tables: only the columns the staging reads (column pruning at the scan).
RAW = {
    "region": _st(("r_regionkey", I), ("r_name", S)),
    "nation": _st(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _st(("c_custkey", L), ("c_name", S)),
    "supplier": _st(("s_suppkey", L), ("s_name", S), ("s_nationkey", I)),
    "part": _st(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_orderdate", TS)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                    ("l_extendedprice", T.DoubleType()), ("l_discount", T.DoubleType()),
                    ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _st(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                  ("value", T.DoubleType()), ("props", S)),
}


def conform(df, schema: T.StructType):
    """Select the schema's columns in order, cast to the declared types."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform_source(df, table: str):
    """A source table in its declared columns, with its own row id where it has one."""
    own = OPTIONAL_IDS.get(table)
    fields = [T.StructField(own, L)] if own in df.columns else []
    return conform(df, T.StructType([*fields, *SOURCE[table].fields]))
