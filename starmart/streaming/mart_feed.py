"""The daily load as a stream (T9): change events of encounters, loaded through snapshots as they arrive.

A change event is an encounter row with ``event_id`` (unique for each change) and ``changed_at``.

* Stateful step: ``dropDuplicatesWithinWatermark`` on ``event_id`` drops events delivered again; the watermark
  follows the arrival of files, so the state holds the ids of ``REPEATS`` of arrivals and no event is lost for being old.
* ``foreachBatch`` runs the load of ``plans.mart_load`` for the encounters of the batch: Type 1 upsert of their patients (T2),
  placeholders (T5), calendar (T6), and the months they leave or enter (T4), in one commit.  Of several events
  of an encounter the one with the newest ``changed_at`` counts, also against what is stored, so order of arrival doesn't matter.
* Events that changed more than ``lateness_days`` before the newest event seen go to the side table ``late_events``,
  where they are counted; ``load_late`` loads them.

The commit carries the batch number, so a batch that is run again after a failure changes nothing.  Claims and
links are those of the source tables at that time; later ones are found by the daily refresh.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import upsert as U
from ..plans import mart_load as ML
from ..plans import refresh as R
from ..session import fresh_path
from ..sources.snapshots import Snapshot
from ..sources.store import materialize, read_table, write_table

EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("changed_at", T.TimestampNTZType()),
                      *schemas.SOURCE["encounters"].fields])
REPEATS = "7 days"
LATE = "late_events"


class MartFeed:
    def __init__(self, load: ML.MartLoad, src: dict[str, DataFrame], folder: str, lateness_days: int = 60):
        """``folder`` holds folders of event files; ``src``: the other source tables."""
        self.load, self.src, self.folder, self.lateness = load, src, folder.rstrip("/"), lateness_days

    def events(self) -> DataFrame:
        raw = self.load.spark.readStream.schema(EVENT).parquet(f"{self.folder}/*")
        arrived = raw.select("*", F.col("_metadata.file_modification_time").alias("arrived"))
        return arrived.withWatermark("arrived", REPEATS).dropDuplicatesWithinWatermark(["event_id"]).drop("arrived")

    def run(self) -> None:
        """Load what has arrived and stop; the checkpoint stands beside the mart, so the next run goes on from there."""
        query = (self.events().writeStream.foreachBatch(self.on_batch)
                 .option("checkpointLocation", f"{self.load.log.root}/feed_checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()

    def on_batch(self, batch: DataFrame, number: int) -> None:
        base = self.load.log.current()
        if number <= int(base.notes.get("feed:batch", "-1")):
            return
        # read in the load's own session: that of the batch plans without sizes, as a stream's state needs fixed partitions
        path = fresh_path(self.load.spark, "feed_batch")
        write_table(batch.select(*EVENT.fieldNames()), path)
        events = read_table(self.load.spark, path, EVENT)
        newest = events.agg(F.max("changed_at")).first()[0]
        seen = max(filter(None, [newest and newest.isoformat(), base.notes.get("feed:seen")]), default=None)
        notes = {"feed:batch": str(number)} | ({"feed:seen": seen} if seen else {})
        limit = base.notes.get("feed:seen")  # an event is late against what was loaded before its batch
        late = F.lit(False)
        if limit:
            since = _dt.datetime.fromisoformat(limit) - _dt.timedelta(days=self.lateness)
            late = F.coalesce(F.col("changed_at") < F.lit(since.isoformat()).cast("timestamp_ntz"), F.lit(False))
        side = self.load.log.write(events.where(late), LATE)
        kept = dict(base.files.get(LATE, {}))
        if self.load.log.table(Snapshot(0, {LATE: side}), LATE, EVENT).limit(1).count():
            kept[number] = side[None]
        self._load(base, events.where(~late), {LATE: kept}, notes)

    def late_events(self) -> DataFrame:
        """The side table: events that came too late and aren't loaded yet."""
        return self.load.log.table(self.load.log.current(), LATE, EVENT)

    def load_late(self) -> Snapshot:
        """Load the events of the side table and empty it, in one commit."""
        return self._load(self.load.log.current(), self.late_events(), {LATE: {}}, {})

    def _load(self, base: Snapshot, events: DataFrame, files: dict, notes: dict[str, str]) -> Snapshot:
        load = self.load
        if events.isEmpty():
            return load.log.commit(base, files, notes)
        newest = (events.where(F.col("encounter_id").isNotNull()).groupBy("encounter_id")
                  .agg(F.max_by(F.struct(*[c for c in EVENT.fieldNames() if c != "encounter_id"]),
                                F.struct(F.col("changed_at").isNotNull(), "changed_at", "event_id")).alias("e"))
                  .select("encounter_id", "e.*"))
        stored = load.stored(base, ML.FACT).select("encounter_id", F.col("digest").alias("_digest"), "version", F.lit(True).alias("_in"))
        met = newest.join(stored, "encounter_id", "left")
        met = materialize(met.where(F.col("_in").isNull() | F.col("version").isNull() | (F.col("changed_at") >= F.col("version"))), "feed_rows")
        encounters = schemas.conform(met, schemas.SOURCE["encounters"])
        part = R.with_encounters(ML.normalize_sources(dict(self.src, encounters=encounters)), encounters)
        part["encounters"] = ML.normalize_sources({"encounters": encounters})["encounters"]
        for t in ML.CHILDREN:  # digests, sums and bridges read them
            part[t] = materialize(part[t], f"feed_{t}")
        digests = ML.measured_digests(part).join(met.select("encounter_id", F.col("changed_at").alias("version"), "_digest"), "encounter_id")
        digests = materialize(digests, "feed_digests")
        changed = materialize(digests.where(~F.col("digest").eqNullSafe(F.col("_digest"))).select(
            "encounter_id", F.when(F.col("_digest").isNull(), "new").otherwise("modified").alias("change")), "feed_changes")
        if changed.isEmpty():
            return load.log.commit(base, files, notes)
        touched = materialize(part["encounters"].join(changed, "encounter_id", "left_semi"), "changed_encounters")
        day = _dt.date.fromisoformat(notes.get("feed:seen", base.notes.get("feed:seen", base.notes["mark"]))[:10])
        run_date = max(_dt.date.fromisoformat(base.notes["mark"]), day)
        patients = self.src["patients"].join(touched.select("patient_id").distinct(), "patient_id", "left_semi")
        dims, dim_files, dim_notes = load.dimensions(base, dict(part, patients=patients), run_date, touched,
                                                     ("dim_encounter_type", "dim_patient"))
        facts, more = load.rewritten(base, part, dims, digests.drop("_digest"), changed, touched)
        return load.log.commit(base, files | dim_files | facts, notes | dim_notes | more)


# ---- registered queries ------------------------------------------------------
def _events(encounters: DataFrame, changed_at, kind: int) -> DataFrame:
    """Encounters as change events; ``kind`` tells the changes of one encounter apart."""
    numbered = encounters.withColumn("event_id", F.col("encounter_id") * 10 + kind)
    return numbered.withColumn("changed_at", changed_at).select(*EVENT.fieldNames())


def earlier_deliveries(src: dict[str, DataFrame], mk: R.Marks) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """The extract as of the cutoff (with some admissions 40 days off), and what arrives after it: the later
    encounters; corrections and events delivered again; stragglers; nothing."""
    i = F.col("encounter_id")
    state, later = R.split_encounters(src, mk.cutoff)
    old, new = state["encounters"], later["encounters"]
    wrong = old.withColumn("encounter_date", F.when(i % 13 == 0, F.timestamp_add("DAY", F.lit(-40), F.col("encounter_date")))
                           .otherwise(F.col("encounter_date")).cast("timestamp_ntz"))
    now = F.lit(mk.run_date.isoformat()).cast("timestamp_ntz")
    first = _events(new.where(i % 17 != 0), F.col("encounter_date"), 0)
    corrections = _events(old.where(i % 13 == 0), now, 1)
    stragglers = _events(new.where(i % 17 == 0), F.col("encounter_date"), 0)
    return R.with_encounters(state, wrong), [first, corrections.unionAll(first.where(i % 5 == 0)),
                                             stragglers.unionAll(corrections.where(i % 5 == 0)), first.limit(0)]


_DONE: dict[tuple, tuple[MartFeed, DataFrame, Snapshot]] = {}


def fed(spark: SparkSession, sf_dir: str, src: dict[str, DataFrame]) -> tuple[MartFeed, DataFrame, Snapshot]:
    """The mart after all deliveries (once a session): (feed, late events before they were loaded, snapshot)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _DONE:
        mk = R.marks(src)
        state, deliveries = earlier_deliveries(src, mk)
        load = ML.MartLoad(spark)
        load.full_load(dict(state, encounters=materialize(state["encounters"], "feed_state")), mk.cutoff)
        feed = MartFeed(load, src, fresh_path(spark, "feed"))
        for n, events in enumerate(deliveries):
            write_table(events, f"{feed.folder}/{n}")
            feed.run()
        late = materialize(feed.late_events(), LATE)
        _DONE[key] = feed, late, feed.load_late()
    return _DONE[key]


def stream_mart_fact(spark, sf_dir, src) -> DataFrame:
    """The fact after the stream, by natural keys."""
    feed, _, after = fed(spark, sf_dir, src)
    return R.fact_by_natural_keys(feed.load.tables(after))


def stream_mart_bridges(spark, sf_dir, src) -> DataFrame:
    feed, _, after = fed(spark, sf_dir, src)
    return R.bridges_by_natural_keys(feed.load.tables(after))


def stream_late_events(spark, sf_dir, src) -> DataFrame:
    """Late events by encounter type, before they were loaded."""
    _, late, _ = fed(spark, sf_dir, src)
    return late.groupBy("encounter_type").agg(F.count("event_id").alias("late_events"),
                                              F.min("changed_at").cast("date").alias("oldest"))
