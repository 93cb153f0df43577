"""Per-session catalog of the staged source model and the star mart.

A registered query takes ``(spark, sf_dir)``.  Staging and the mart load are
done once per session and ``sf_dir`` and written below the shared folder, each table when
a query first reads it; later queries read those files (as the reference queries a loaded database).
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession

from ..sources.store import materialize
from ..sources.tables import Tables
from ..sources.testdata import AS_OF, stage_sources
from .fact import mart_tables

_LOCK = threading.RLock()
_SOURCES: dict[tuple, Tables] = {}
_MARTS: dict[tuple, Tables] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"))


def sources(spark: SparkSession, sf_dir: str) -> Tables:
    """The ten source tables, staged from the driver tables and written once."""
    k = _key(spark, sf_dir)
    with _LOCK:
        if k not in _SOURCES:
            staged = stage_sources(spark, sf_dir)
            _SOURCES[k] = Tables({name: (lambda name=name: materialize(staged[name], f"src_{name}")) for name in staged})
        return _SOURCES[k]


def mart(spark: SparkSession, sf_dir: str) -> Tables:
    """Star mart of the staged sources (calendar over the data's span, ages as of AS_OF)."""
    k = _key(spark, sf_dir)
    with _LOCK:
        if k not in _MARTS:
            _MARTS[k] = mart_tables(sources(spark, sf_dir), AS_OF, calendar="data")
        return _MARTS[k]


def forget(spark: SparkSession | None = None) -> None:
    with _LOCK:
        _SOURCES.clear()
        _MARTS.clear()
