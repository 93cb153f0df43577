"""Structured Streaming feed of the encounter load.

Source: the ``events`` Parquet files read as a file stream (event_id is the
encounter id, user_id the patient, ts the encounter time, event_type the
encounter type, value the amount).  Every micro-batch is written once, as one
directory of an append-only log (``foreachBatch``; a replayed batch overwrites its own
directory, so it counts once).  Nothing is dropped for being late, and the work of a batch
follows the batch.

* ``fact``: the newest version of every encounter over the whole log, whatever its
  month: the last batch wins, within a batch the latest event time (W2).  A correction replaces the
  earlier row even if it changes the month.  ``compact`` folds the log into one directory.
* ``monthly``: encounters and distinct patients per month and type of ``fact``.

``trigger(availableNow=True)`` processes what is there and stops; the same
code runs continuously with a processing-time trigger.  Empty batches are
accepted.  The checkpoint has a fixed place beside the log, so a restarted feed resumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import dates
from ..operators.upsert import latest_per_key
from ..session import fresh_path
from ..sources.store import read_table, write_table

FACT_SCHEMA = "encounter_id BIGINT, patient_id BIGINT, encounter_type STRING, encounter_time TIMESTAMP_NTZ, " \
              "amount DECIMAL(12,2), admission_date_key INT, encounter_month INT"
MONTHLY_SCHEMA = "encounter_month INT, month_label STRING, encounter_type STRING, total_encounters BIGINT, " \
                 "unique_patients BIGINT"


def encounter_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of encounter rows."""
    r = spark.readStream.schema(schemas.RAW["events"])
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    # a glob names the table whether it is one file or a directory of files
    return encounter_rows(r.parquet(f"{sf_dir.rstrip('/')}/events.parque[t]"))


def encounter_rows(raw: DataFrame) -> DataFrame:
    """Events as encounter rows."""
    t = F.col("ts")
    return (raw.select(F.col("event_id").alias("encounter_id"), F.col("user_id").alias("patient_id"),
                       F.col("event_type").alias("encounter_type"),
                       t.cast("timestamp").alias("event_ts"),
                       F.col("value").cast("decimal(12,2)").alias("amount")))


def fact_rows(batch: DataFrame) -> DataFrame:
    t = F.col("event_ts").cast("timestamp_ntz")
    return batch.select("encounter_id", "patient_id", "encounter_type", t.alias("encounter_time"), "amount",
                        dates.date_key(t).alias("admission_date_key"),
                        (F.year(t) * 100 + F.month(t)).alias("encounter_month"))


class StreamTables:
    """The log of batches below ``root``, and the tables it stands for."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or fresh_path(spark, "stream")
        self.log_schema = f"{FACT_SCHEMA}, batch BIGINT"
        self._log_of(spark.createDataFrame([], self.log_schema), -1)  # readers need a first directory

    def _log_of(self, rows: DataFrame, batch: int) -> None:
        write_table(rows.drop("batch"), f"{self.root}/log/batch={batch}")

    def merge_batch(self, batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(fact_rows(batch), "encounter_id", "encounter_time")
        self._log_of(rows, batch_id)

    def log(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/log", self.log_schema)

    def fact(self) -> DataFrame:
        return latest_per_key(self.log(), "encounter_id", "batch").drop("batch")

    def compact(self) -> "StreamTables":
        """New tables below a new root that hold the newest versions only; the caller switches to them."""
        new = StreamTables(self.spark)
        write_table(latest_per_key(self.log(), "encounter_id", "batch"), f"{new.root}/log", ["batch"])
        return new

    def monthly(self) -> DataFrame:
        month = F.col("encounter_month")
        return (self.fact().groupBy("encounter_month", "encounter_type")
                .agg(F.count("encounter_id").alias("total_encounters"),
                     F.count_distinct("patient_id").alias("unique_patients"))
                .withColumn("month_label", F.format_string("%04d-%02d", (month / 100).cast("int"), month % 100))
                .select(*[c.split()[0] for c in MONTHLY_SCHEMA.split(", ")]))


def run_feed(spark: SparkSession, sf_dir: str, tables: StreamTables | None = None,
             files_per_trigger: int | None = None) -> StreamTables:
    """Run the feed over everything available now and wait for it to finish."""
    tables = tables or StreamTables(spark)
    q = (encounter_stream(spark, sf_dir, files_per_trigger).writeStream
         .foreachBatch(tables.merge_batch)
         .option("checkpointLocation", f"{tables.root}/checkpoint")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return tables


def stream_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered T9: the encounter table after the stream has caught up."""
    return run_feed(spark, sf_dir).fact()


def stream_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered T10: monthly encounters and distinct patients by type from the stream."""
    return run_feed(spark, sf_dir).monthly()
