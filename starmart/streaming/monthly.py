"""Monthly encounters and distinct patients of a feed, maintained by deltas.

* A stateful step (``applyInPandasWithState``) keeps the present version of every encounter: its month, type and
  patient.  An event that changes them takes the old place back (-1) and adds the new one (+1), so a correction
  that moves an encounter between months touches both; an event delivered again changes nothing.  Encounters share
  ``BUCKETS`` states by the hash of their id, so a batch costs as many Python calls at most, not one an encounter.
* ``foreachBatch`` sums the deltas by (month, type, patient) and adds them to the counts ``visits``, of the touched
  months only; the monthly table of these months is made anew from them.  Counts by patient merge by
  addition, also downwards, which a distinct count alone can't.  Both tables switch with the batch number in one
  snapshot, so a batch that is run again counts once.

So the work of a batch follows the batch, the states and the months it touches, not the history.  As in ``feed``, the
last batch wins; within a batch the latest event time, then the larger hash.  Rows without an id are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import schemas
from ..session import fresh_path
from ..sources.snapshots import Snapshots
from ..sources.store import materialize, write_table
from . import feed as ST

VISITS = T.StructType([T.StructField("encounter_month", T.IntegerType()), T.StructField("encounter_type", T.StringType()),
                       T.StructField("patient_id", T.LongType()), T.StructField("n", T.LongType())])
MONTHLY = T.StructType([T.StructField("encounter_month", T.IntegerType()), T.StructField("month_label", T.StringType()),
                        T.StructField("encounter_type", T.StringType()), T.StructField("total_encounters", T.LongType()),
                        T.StructField("unique_patients", T.LongType())])
PLACE = VISITS.fieldNames()[:3]


#: states that the encounters are dealt to; a checkpoint is bound to it
BUCKETS = 4096
#: the places of the encounters of a state
HELD = T.StructType([T.StructField("encounter_id", T.ArrayType(T.LongType())),
                     *[T.StructField(f.name, T.ArrayType(f.dataType)) for f in VISITS.fields[:3]]])


def moves(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The deltas of the encounters of one state: -1 at an old place, +1 at a new one."""
    best: dict[int, tuple] = {}
    for part in rows:
        columns = ("encounter_id", *PLACE, "has_patient", "known", "at", "tie")
        for i, month, kind, patient, has_patient, *rank in zip(*(part[c].tolist() for c in columns)):
            if i not in best or rank > best[i][0]:
                best[i] = rank, (month if rank[0] else None, kind, patient if has_patient else None)
    held = {}
    if state.exists:
        ids, *places = state.get
        held = dict(zip(ids, zip(*places)))
    deltas: Counter = Counter()
    moved = False
    for i, (_, place) in best.items():
        old = held.get(i)
        if old != place:
            moved, held[i] = True, place
            deltas[place] += 1
            if old is not None:
                deltas[old] -= 1
    if moved:
        state.update((list(held), *map(list, zip(*held.values()))))
        out = [(*p, n) for p, n in deltas.items() if n]
        yield pd.DataFrame({f.name: pd.array(list(c), dtype=kind) for f, c, kind in zip(
            VISITS.fields, zip(*out) if out else [()] * 4, ("Int32", "object", "Int64", "Int64"))})


class MonthlyFeed:
    def __init__(self, spark: SparkSession, folder: str, root: str | None = None):
        """``folder`` holds folders of event files."""
        self.spark, self.folder = spark, folder.rstrip("/")
        self.log = Snapshots(spark, root or fresh_path(spark, "monthly"))

    def deltas(self) -> DataFrame:
        raw = ST.encounter_rows(self.spark.readStream.schema(schemas.RAW["events"]).parquet(f"{self.folder}/*"))
        rows = ST.fact_rows(raw).where(F.col("encounter_id").isNotNull())
        others = [c for c in rows.columns if c != "encounter_id"]
        ranked = rows.select(F.pmod(F.xxhash64("encounter_id"), F.lit(BUCKETS)).alias("bucket"), "encounter_id",
                             # no nulls among the integers, which pandas would make floats
                             F.coalesce("encounter_month", F.lit(0)).alias("encounter_month"), "encounter_type",
                             F.coalesce("patient_id", F.lit(0)).alias("patient_id"),
                             F.col("patient_id").isNotNull().alias("has_patient"),
                             F.col("encounter_time").isNotNull().alias("known"),
                             F.coalesce(F.unix_micros(F.col("encounter_time").cast("timestamp")), F.lit(0)).alias("at"),
                             F.xxhash64(*others).alias("tie"))
        return ranked.groupBy("bucket").applyInPandasWithState(moves, VISITS, HELD, "append", GroupStateTimeout.NoTimeout)

    def run(self) -> None:
        """Count what has arrived and stop; the next run goes on from there."""
        query = (self.deltas().writeStream.foreachBatch(self.on_batch)
                 .option("checkpointLocation", f"{self.log.root}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()

    def on_batch(self, batch: DataFrame, number: int) -> None:
        base = self.log.current()
        if number <= int(base.notes.get("batch", "-1")):
            return
        delta = materialize(batch.groupBy(*PLACE).agg(F.sum("n").alias("n")).where("n <> 0"), "deltas")
        months = {r[0] for r in delta.select(F.coalesce("encounter_month", F.lit(0))).distinct().collect()}  # bounded by the calendar
        held = dict(base.files.get("visits", {})), dict(base.files.get("monthly", {}))
        if months:
            old = self.log.table(base, "visits", VISITS, months) if base.version else delta.limit(0)
            visits = old.unionByName(delta).groupBy(*PLACE).agg(F.sum("n").alias("n")).where("n > 0")
            written = self.log.write_periods(visits, "visits", F.col("encounter_month"), ["encounter_type", "patient_id"])
            stored = self.spark.read.schema(VISITS).parquet(*written.values()) if written else delta.limit(0)
            table = self.log.write_periods(monthly(stored), "monthly", F.col("encounter_month"), ["encounter_type"])
            held = tuple({p: path for p, path in h.items() if p not in months} | new for h, new in zip(held, (written, table)))
        self.log.commit(base, dict(zip(("visits", "monthly"), held)), {"batch": str(number)})

    def table(self) -> DataFrame:
        """Month, type, encounters and distinct patients, as of the last batch."""
        return self.log.table(self.log.current(), "monthly", MONTHLY)


def monthly(visits: DataFrame) -> DataFrame:
    """The monthly table of counts by patient."""
    month = F.col("encounter_month")
    return (visits.groupBy("encounter_month", "encounter_type")
            .agg(F.sum("n").alias("total_encounters"), F.count("patient_id").alias("unique_patients"))
            .withColumn("month_label", F.format_string("%04d-%02d", (month / 100).cast("int"), month % 100))
            .select(*MONTHLY.fieldNames()))


def stream_monthly_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered T10: the events arrive with every third one 40 days off and every seventh missing; a second
    delivery corrects and completes them and brings every fifth again."""
    events = spark.read.schema(schemas.RAW["events"]).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    i = F.col("event_id")
    early = events.where(i % 7 != 0).withColumn("ts", F.when(i % 3 == 0, F.timestamp_add("DAY", F.lit(-40), F.col("ts")))
                                                .otherwise(F.col("ts")).cast("timestamp_ntz"))
    feed = MonthlyFeed(spark, fresh_path(spark, "month_feed"))
    for n, part in enumerate((early, events.where((i % 3 == 0) | (i % 5 == 0) | (i % 7 == 0)))):
        write_table(part, f"{feed.folder}/{n}")
        feed.run()
    return feed.table()
