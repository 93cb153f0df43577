"""Pair counts of a many-to-many join, pre-aggregated per side.

``COUNT(*)`` of ``left JOIN right USING (key)`` grouped by one code from each
side equals ``SUM(rows_left * rows_right)`` over (key, left code, right code).
Each side is first reduced to one row per (key, code) with a map-side partial
aggregate, so a key with many junction rows is combined before any shuffle
and the join emits one row per pair of *distinct* codes of a key, never one
per pair of junction rows.  Exact; the top-k is the feature of the report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import materialize

#: codes of each side whose pairs are counted first
SEEDS = 16


def code_pairs_sql(left: str, right: str, key: str, left_code: str, right_code: str,
                   k: int | None = 10) -> str:
    """SELECT statement over two relations with columns (key, code)."""
    limit = f"\nLIMIT {int(k)}" if k else ""
    return f"""
SELECT l.{left_code}, r.{right_code}, CAST(SUM(l._n * r._n) AS BIGINT) AS combination_count
FROM (SELECT {key}, {left_code}, COUNT(*) AS _n FROM {left} GROUP BY {key}, {left_code}) l
JOIN (SELECT {key}, {right_code}, COUNT(*) AS _n FROM {right} GROUP BY {key}, {right_code}) r
  ON l.{key} = r.{key}
GROUP BY l.{left_code}, r.{right_code}
ORDER BY combination_count DESC, l.{left_code}, r.{right_code}{limit}"""


def _per_key(rows: DataFrame, key: str, code: str, label: str) -> DataFrame:
    return materialize(rows.groupBy(F.col(key).alias("_k"), F.col(code).alias("_c")).agg(F.count(F.lit(1)).alias("_n")), label)


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    met = left.alias("l").join(right.alias("r"), "_k")
    return met.groupBy(F.col("l._c").alias("_a"), F.col("r._c").alias("_b")).agg(F.sum(F.col("l._n") * F.col("r._n")).alias("_n"))


def top_pairs(left: DataFrame, right: DataFrame, key: str, left_code: str, right_code: str, k: int = 10,
              seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """The k most frequent code pairs, and the pairs that had to be counted for them (a, b, n).

    A pair occurs at most as often as one code's links times the most links a key has to the other code.  The pairs of
    the ``seeds`` most frequent codes of each side are counted first; their k-th count is a safe cutoff, as it is
    the count of k pairs.  Codes whose bound with any partner stays below it leave before the join, pairs
    whose own bound does before the second aggregation.  Exact, ties by the codes; the cutoff is the only value on the driver.
    """
    sides = []
    for rows, code, name in ((left, left_code, "pairs_l"), (right, right_code, "pairs_r")):
        per_key = _per_key(rows, key, code, name)
        sides.append((per_key, materialize(per_key.groupBy("_c").agg(F.sum("_n").alias("_links"), F.max("_n").alias("_most")), name)))
    first = [n.join(t.orderBy(F.desc("_links"), "_c").limit(seeds).select("_c"), n["_c"].eqNullSafe(t["_c"]), "left_semi") for n, t in sides]
    best = _counted(*first).orderBy(F.desc("_n")).limit(k).select("_n").collect()
    cutoff = best[-1]["_n"] if len(best) == k else 0
    most = [t.agg(F.max("_most")).first()[0] or 0 for _, t in sides]
    kept = []
    for i, (n, t) in enumerate(sides):
        able = t.where(F.col("_links") * most[1 - i] >= cutoff).select(F.col("_c").alias("_code"), "_links", "_most")
        kept.append(n.join(able, n["_c"].eqNullSafe(able["_code"])).drop("_code"))
    met = kept[0].alias("l").join(kept[1].alias("r"), "_k")
    bound = F.least(F.col("l._links") * F.col("r._most"), F.col("r._links") * F.col("l._most"))
    counted = (met.where(bound >= cutoff).groupBy(F.col("l._c").alias(left_code), F.col("r._c").alias(right_code))
               .agg(F.sum(F.col("l._n") * F.col("r._n")).cast("bigint").alias("combination_count")))
    return counted.orderBy(F.desc("combination_count"), left_code, right_code).limit(k), counted
