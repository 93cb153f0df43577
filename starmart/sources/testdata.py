"""Staging: reshape the driver's TPC-H-like tables into the ten source tables.

Every expression here has a twin in ``starmart.oracle.STAGING``; keep
them in step.  Reads use explicit schemas holding only the needed columns,
so Parquet scans are pruned.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.keys import sequence_within
from .tables import Tables

# Fixed values of the mapping (also used by the oracle text).
BIRTH_BASE = _dt.date(1920, 1, 1)
BIRTH_MULT, BIRTH_SPAN = 7919, 29900      # birth = base + (custkey * mult) % span days
DISCHARGE_NULL_MOD = 17                   # orderkey % 17 = 0 -> still admitted (null discharge)
STAY_MOD = 10                             # stay = orderkey % 10 days
CPT_MULT = 3989                           # cpt code = lpad((brand_no * mult) % 100000, 5)
STATUS_TYPE = [("F", "Inpatient"), ("O", "Outpatient"), ("P", "ER")]
AS_OF = _dt.date(2002, 1, 1)              # age reference for the testdata mart


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.RAW[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _encounter_type(status):
    e = None
    for code, name in STATUS_TYPE:
        e = F.when(status == code, name) if e is None else e.when(status == code, name)
    return e


def stage_sources(spark: SparkSession, sf_dir: str) -> Tables:
    """Lazy frames of the ten source tables (the diagnosis sequence has one checkpoint, made when it is asked for)."""
    r = lambda n: read_raw(spark, sf_dir, n)
    nation, region, supplier = r("nation"), r("region"), r("supplier")
    customer, part, orders, lineitem = r("customer"), r("part"), r("orders"), r("lineitem")

    specialties = nation.select(
        F.col("n_nationkey").cast("bigint").alias("specialty_id"),
        F.col("n_name").alias("specialty_name"),
        F.substring("n_name", 1, 3).alias("specialty_code"))

    departments = region.select(
        F.col("r_regionkey").cast("bigint").alias("department_id"),
        F.col("r_name").alias("department_name"),
        (F.col("r_regionkey") + 1).cast("int").alias("floor"),
        (F.col("r_regionkey") * 10 + 20).cast("int").alias("capacity"))

    providers = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
                 .select(F.col("s_suppkey").alias("provider_id"),
                         F.lit("Supplier").alias("first_name"),
                         F.expr("substring(s_name, 10)").alias("last_name"),
                         F.lit("MD").alias("credential"),
                         F.col("s_nationkey").cast("bigint").alias("specialty_id"),
                         F.col("n_regionkey").cast("bigint").alias("department_id")))

    patients = customer.select(
        F.col("c_custkey").alias("patient_id"),
        F.lit("Customer").alias("first_name"),
        F.expr("substring(c_name, 10)").alias("last_name"),
        F.date_add(F.lit(BIRTH_BASE), ((F.col("c_custkey") * BIRTH_MULT) % BIRTH_SPAN).cast("int"))
         .alias("date_of_birth"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("MRN"), F.col("c_custkey").cast("string")).alias("mrn"))

    # provider of an encounter: lowest supplier on the order (partial aggregate before the join)
    first_supplier = lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("provider_id"))
    prov_dept = providers.select(F.col("provider_id").alias("p_id"), F.col("department_id"))
    encounters = (orders.join(first_supplier, orders.o_orderkey == first_supplier.l_orderkey, "left")
                  .join(prov_dept, F.col("provider_id") == F.col("p_id"), "left")
                  .select(F.col("o_orderkey").alias("encounter_id"),
                          F.col("o_custkey").alias("patient_id"),
                          F.col("provider_id"),
                          _encounter_type(F.col("o_orderstatus")).alias("encounter_type"),
                          F.col("o_orderdate").alias("encounter_date"),
                          F.when(F.col("o_orderkey") % DISCHARGE_NULL_MOD != 0,
                                 F.timestamp_add("DAY", (F.col("o_orderkey") % STAY_MOD).cast("int"),
                                                 F.col("o_orderdate"))).alias("discharge_date"),
                          F.col("department_id")))

    diagnoses = part.select(
        F.col("p_partkey").alias("diagnosis_id"),
        F.concat(F.upper(F.substring("p_type", 1, 1)), F.lpad(F.col("p_size").cast("string"), 2, "0"),
                 F.lit("."), (F.col("p_size") % 5).cast("string")).alias("icd10_code"),
        F.col("p_name").alias("icd10_description"))

    brand_no = F.expr("substring(p_brand, 7)").cast("bigint")
    procedures = (part.select("p_brand").distinct()
                  .select(brand_no.alias("procedure_id"),
                          F.lpad(((brand_no * CPT_MULT) % 100000).cast("string"), 5, "0").alias("cpt_code"),
                          F.concat(F.lit("Procedure "), F.col("p_brand")).alias("cpt_description")))

    pairs = lineitem.select(F.col("l_orderkey").alias("encounter_id"), F.col("l_partkey").alias("diagnosis_id"))
    encounter_diagnoses = lambda: sequence_within(pairs, ["encounter_id"], ["diagnosis_id"], "diagnosis_sequence", distinct=True)

    part_brand = part.select(F.col("p_partkey"), brand_no.alias("procedure_id"))
    order_day = orders.select(F.col("o_orderkey"), F.to_date("o_orderdate").alias("procedure_date"))
    encounter_procedures = (lineitem.select("l_orderkey", "l_partkey")
                            .join(part_brand, F.col("l_partkey") == F.col("p_partkey"))
                            .select(F.col("l_orderkey").alias("encounter_id"), "procedure_id")
                            .distinct()
                            .join(order_day, F.col("encounter_id") == F.col("o_orderkey"), "left")
                            .select("encounter_id", "procedure_id", "procedure_date"))

    claim = F.col("l_extendedprice").cast("decimal(12,2)")
    billing = lineitem.select(
        F.col("l_orderkey").alias("encounter_id"),
        claim.alias("claim_amount"),
        (claim * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(12,2)")
         .alias("allowed_amount"),
        F.to_date("l_shipdate").alias("claim_date"),
        F.when(F.col("l_linestatus") == "F", "Paid").otherwise("Submitted").alias("claim_status"))

    out = dict(specialties=specialties, departments=departments, providers=providers,
               patients=patients, encounters=encounters, diagnoses=diagnoses, procedures=procedures,
               encounter_procedures=encounter_procedures, billing=billing)
    makers = {k: (lambda v=v: v) for k, v in out.items()} | {"encounter_diagnoses": encounter_diagnoses}
    from .normalize import normalize_sources
    return normalize_sources(Tables({k: (lambda k=k: schemas.conform(makers[k](), schemas.SOURCE[k])) for k in makers}))
