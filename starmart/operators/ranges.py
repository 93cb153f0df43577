"""Range lookup by an interval join (B12): the narrowest range that holds a point.

Ranges are cut into buckets of equal width, so points meet them by an equi-join on the bucket and a check of
the borders; each distinct point is looked up once.  Of overlapping ranges the narrowest wins, then
the one that begins first, then the smaller label.  Ranges are data: a table (low, high, label), borders included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_lookup(rows: DataFrame, point: Column, ranges: DataFrame, width: int, label: str) -> DataFrame:
    """``rows`` plus ``label`` (null where no range holds the point, or the point is null)."""
    cut = ranges.where("low <= high").select("low", "high", F.col(label).alias("_label"), F.explode(F.sequence(
        F.floor(F.col("low") / width), F.floor(F.col("high") / width))).alias("_bucket"))
    keyed = rows.drop(label).withColumn("_point", point.cast("bigint"))
    points = keyed.where("_point IS NOT NULL").select("_point").distinct().withColumn("_bucket", F.floor(F.col("_point") / width))
    met = points.join(cut, "_bucket").where(F.col("_point").between(F.col("low"), F.col("high")))
    best = met.groupBy("_point").agg(F.min_by("_label", F.struct(F.col("high") - F.col("low"), "low", "_label")).alias(label))
    return keyed.join(best, "_point", "left").drop("_point")
