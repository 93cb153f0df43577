"""Bridges stored for their join (J13, R2): bucketed by encounter, with a salt for hot encounters.

Each bridge is reduced to (encounter, code, links) and stored in buckets of (encounter, salt), sorted.  Tables with equal
buckets join without an exchange, so the pair counts shuffle their result only, however often they are asked for.

An encounter with more than ``hot`` codes on one side is split: its rows of the first bridge are dealt over ``salts``
by the code, its rows of the second one are stored once for each salt.  Every pair still meets exactly once, and no
bucket holds a hot encounter whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sources.store import materialize

HOT, SALTS = 50_000, 64


def _stored(rows: DataFrame, name: str, buckets: int) -> str:
    """A bucketed table; returns its name.  One file a bucket, as rows are dealt like the buckets."""
    table = f"sm_{name}_{uuid.uuid4().hex[:8]}"
    (rows.repartition(buckets, "encounter_key", "salt").write.bucketBy(buckets, "encounter_key", "salt")
     .sortBy("encounter_key", "salt").option("path", fresh_path(rows.sparkSession, name)).saveAsTable(table))
    return table


class BucketedBridges:
    """The two bridges with their codes, stored for joins on the encounter."""

    def __init__(self, m: dict[str, DataFrame], buckets: int | None = None, hot: int = HOT, salts: int = SALTS):
        self.spark = m["fact_encounters"].sparkSession
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dx = self._codes(m["bridge_encounter_diagnoses"].join(m["dim_diagnosis"], "diagnosis_key"), "icd_code")
        px = self._codes(m["bridge_encounter_procedures"].join(m["dim_procedure"], "procedure_key"), "cpt_code")
        busy = [t.groupBy("encounter_key").count().where(F.col("count") > hot).select("encounter_key") for t in (dx, px)]
        crowded = materialize(busy[0].union(busy[1]).distinct().withColumn("hot", F.lit(True)), "hot_encounters")
        dealt = F.when(F.col("hot"), F.pmod(F.xxhash64("icd_code"), F.lit(salts))).otherwise(0).cast("int")
        everywhere = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
        self.diagnoses = _stored(dx.join(crowded, "encounter_key", "left").withColumn("salt", dealt).drop("hot"), "bucketed_dx", buckets)
        self.procedures = _stored(px.join(crowded, "encounter_key", "left").withColumn("salt", everywhere).drop("hot"), "bucketed_px", buckets)

    @staticmethod
    def _codes(rows: DataFrame, code: str) -> DataFrame:
        return materialize(rows.groupBy("encounter_key", code).agg(F.count(F.lit(1)).alias("links")), "codes")

    def top_pairs(self, k: int = 10) -> DataFrame:
        """The k most frequent pairs of diagnosis and procedure codes."""
        return self.spark.sql(f"""
            SELECT /*+ MERGE(d, p) */ d.icd_code, p.cpt_code, CAST(SUM(d.links * p.links) AS BIGINT) AS combination_count
            FROM {self.diagnoses} d JOIN {self.procedures} p ON d.encounter_key = p.encounter_key AND d.salt = p.salt
            GROUP BY d.icd_code, p.cpt_code ORDER BY combination_count DESC, d.icd_code, p.cpt_code LIMIT {int(k)}""")


def q2_star_bucketed(m) -> DataFrame:
    return BucketedBridges(m).top_pairs()
