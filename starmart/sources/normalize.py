"""Staging clean-up that makes Spark compare strings the way the source model does.

MySQL's default collation ignores case, so 'inpatient' joins and filters like
'Inpatient' there; Spark compares bytes.  Encounter types are therefore mapped
to their canonical spelling (case ignored, blanks kept: they count in that collation) before any
dimension, fact or report reads them.  Values outside the domain are kept as
they are, so the K7 check still reports them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..schemas import ENCOUNTER_TYPES
from .tables import Tables, replaced


def canonical_type(c: Column) -> Column:
    key = F.lower(c)
    out = None
    for name in ENCOUNTER_TYPES:
        out = F.when(key == name.lower(), F.lit(name)) if out is None else out.when(key == name.lower(), F.lit(name))
    return out.otherwise(c)


def normalize_sources(src: Mapping[str, DataFrame]) -> Tables:
    return replaced(src, {"encounters": lambda: src["encounters"].withColumn(
        "encounter_type", canonical_type(F.col("encounter_type")))})


def read_sources(spark, folder: str, fmt: str = "parquet", **options) -> dict[str, DataFrame]:
    """The ten source tables of a folder (a file or directory each), in declared types, cleaned up."""
    src = {}
    for table in schemas.SOURCE:
        raw = spark.read.format(fmt).options(**options).load(f"{folder.rstrip('/')}/{table}.{fmt}")
        src[table] = schemas.conform_source(raw, table)
    return normalize_sources(src)
