"""Load sink (S6/S7): write a frame as Parquet below the shared folder and read it back.

Reading back gives Catalyst exact file sizes (so small dimensions are
broadcast by the size check, large ones are not) and cuts the lineage, so a
lost executor re-reads files instead of recomputing the whole build.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path


MAX_RECORDS_PER_FILE = "spark.starmart.maxRecordsPerFile"
DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Parquet write with a cap on rows per file, so a table written by few tasks
    is still read by many (Spark splits reads by file and row group)."""
    cap = df.sparkSession.conf.get(MAX_RECORDS_PER_FILE, str(DEFAULT_MAX_RECORDS_PER_FILE))
    w = df.write.mode(mode).option("maxRecordsPerFile", cap)
    if partition_by:
        # an overwrite replaces only the partitions present in ``df``, whatever the session says
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def read_table(spark, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None,
                path: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh path (full refresh = new version directory) and read it back."""
    path = path or fresh_path(df.sparkSession, label)
    write_table(df, path, partition_by)
    return read_table(df.sparkSession, path, df.schema).select(*df.columns)


_VERSIONS = "version BIGINT, path STRING, mark STRING"


def publish(spark, root: str, path: str, mark: str | None = None) -> int:
    """Switch the table ``root`` to the version written at ``path``; returns the version number.

    The switch is one appended row, so readers see the old version or the new one.  ``mark`` is kept
    with it (the day up to which an incremental load has come).
    """
    version = (current(spark, root) or (0,))[0] + 1
    spark.createDataFrame([(version, path, mark)], _VERSIONS).coalesce(1).write.mode("append").parquet(f"{root}/_versions")
    return version


def current(spark, root: str) -> tuple[int, str, str | None] | None:
    """(version, path, mark) that ``root`` points at; None before the first one."""
    try:
        log = spark.read.schema(_VERSIONS).parquet(f"{root}/_versions")
    except AnalysisException:  # nothing published yet
        return None
    newest = log.orderBy(F.desc("version")).first()
    return tuple(newest) if newest else None
