"""Keyed upserts of dimensions without a table format.

Every function takes the current dimension and a change batch and returns the
next version as a new frame (the caller writes it to a new directory and
switches to it).  Existing surrogate keys never change; new rows get keys
after the current maximum, in natural-key order.  Only one scalar (the
current maximum key) goes to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import materialize
from .keys import assign_dense_key


def max_key(dim: DataFrame, key: str) -> int:
    v = dim.agg(F.max(key)).first()[0]
    return int(v or 0)


def with_new_keys(rows: DataFrame, order_cols: list[str], key: str, offset: int) -> DataFrame:
    """Keys offset+1, offset+2, ... in the order of ``order_cols``."""
    keyed = assign_dense_key(rows, order_cols, key)
    return keyed.withColumn(key, (F.col(key) + F.lit(offset)).cast("bigint"))


def latest_per_key(batch: DataFrame, nk: str, order_col: str | None = None) -> DataFrame:
    """The newest version of each natural key in a change batch.

    ``max_by`` is an ordinary aggregate with a map-side partial step, so a key
    with very many versions is reduced before the shuffle instead of being
    sorted in one task the way a row_number window would.  A version without an order
    value is older than any other; ties (and batches without an order column) go to the
    row with the larger hash, so reruns agree.  Rows with a null natural key are
    left out: ``rejected`` has them.
    """
    others = [c for c in batch.columns if c != nk]
    packed = F.struct(*[F.col(c) for c in others])
    rank = [F.xxhash64(*[F.col(c) for c in others])]
    if order_col is not None:
        rank = [F.col(order_col).isNotNull(), F.col(order_col), *rank]
    latest = (batch.where(F.col(nk).isNotNull()).groupBy(nk)
              .agg(F.max_by(packed, F.struct(*rank)).alias("_v")))
    return latest.select(nk, *[F.col(f"_v.{c}").alias(c) for c in others]).select(*batch.columns)


def rejected(batch: DataFrame, nk: str) -> DataFrame:
    """Rows of a change batch that no upsert takes: those without a natural key."""
    return batch.where(F.col(nk).isNull())


def upsert_type1(dim: DataFrame, batch: DataFrame, nk: str, key: str, order_col: str | None = None) -> DataFrame:
    """Insert new natural keys, overwrite attributes of known ones in place.

    Of several versions of a key in the batch the newest counts (W2).
    """
    cols = dim.columns
    batch = latest_per_key(batch, nk, order_col).select(*[c for c in cols if c != key])
    known = dim.select(nk, key)
    untouched = dim.join(batch.select(nk), nk, "left_anti")
    updated = batch.join(known, nk, "inner")
    fresh = batch.join(known.select(nk), nk, "left_anti")
    fresh = with_new_keys(fresh, [nk], key, max_key(dim, key))
    return reduce(DataFrame.unionByName, [untouched.select(*cols), updated.select(*cols), fresh.select(*cols)])


def insert_ignore(dim: DataFrame, batch: DataFrame, nk: str, key: str, order_col: str | None = None) -> DataFrame:
    """ON CONFLICT DO NOTHING: only natural keys not yet present are added, once each."""
    cols = dim.columns
    fresh = latest_per_key(batch, nk, order_col).select(*[c for c in cols if c != key]).join(dim.select(nk), nk, "left_anti")
    fresh = with_new_keys(fresh, [nk], key, max_key(dim, key))
    return dim.unionByName(fresh.select(*cols))


def placeholders(dim: DataFrame, referenced: DataFrame, nk: str, key: str, defaults: dict[str, Column]) -> DataFrame:
    """T5: inferred members for natural keys referenced by facts but absent from the dimension."""
    cols = dim.columns
    missing = (referenced.select(nk).where(F.col(nk).isNotNull()).distinct()
               .join(dim.select(nk), nk, "left_anti"))
    filled = missing.select(nk, *[defaults.get(c, F.lit(None)).cast(dim.schema[c].dataType).alias(c)
                                  for c in cols if c not in (nk, key)])
    fresh = with_new_keys(filled, [nk], key, max_key(dim, key))
    return dim.unionByName(fresh.select(*cols))


def _differs(a: str, b: str) -> Column:
    return ~F.col(a).eqNullSafe(F.col(b))


def as_of_versions(dim: DataFrame, nk: str) -> DataFrame:
    """A versioned dimension with half-open spans [_from, _to) that cover all time: the first
    version of a member also stands for the days before it."""
    first = dim.groupBy(F.col(nk).alias("_nk")).agg(F.min("valid_from").alias("_first"))
    met = dim.join(first, dim[nk].eqNullSafe(F.col("_nk"))).drop("_nk")
    return (met.withColumn("_from", F.when(F.col("valid_from") > F.col("_first"), F.col("valid_from")))
               .withColumn("_to", F.col("valid_to")).drop("_first"))


def scd_type2(dim: DataFrame, batch: DataFrame, nk: str, key: str, tracked: list[str], change_date,
              order_col: str | None = None) -> DataFrame:
    """Close the current row of a changed member and add a new current version.

    ``dim`` carries ``current_flag``, ``valid_from``, ``valid_to``; history rows
    (flag false) pass through untouched.
    """
    cols = dim.columns
    batch = latest_per_key(batch, nk, order_col)
    history = dim.where(~F.col("current_flag"))
    current = dim.where(F.col("current_flag"))
    b = batch.select(nk, F.lit(True).alias("_in_b"),
                     *[F.col(c).alias(f"_b_{c}") for c in batch.columns if c != nk])
    j = current.join(b, nk, "left")
    changed = reduce(lambda x, y: x | y, [_differs(c, f"_b_{c}") for c in tracked])
    flagged = j.withColumn("_chg", F.coalesce(F.col("_in_b"), F.lit(False)) & changed)
    day = F.lit(change_date).cast("date")
    kept = flagged.where(~F.col("_chg")).select(*cols)
    closed = (flagged.where(F.col("_chg")).select(*cols)
              .withColumn("current_flag", F.lit(False)).withColumn("valid_to", day))
    attrs = [c for c in cols if c not in (nk, key, "current_flag", "valid_from", "valid_to")]
    new_versions = flagged.where(F.col("_chg")).select(nk, *[F.col(f"_b_{c}").alias(c) for c in attrs])
    brand_new = batch.join(dim.select(nk).distinct(), nk, "left_anti").select(nk, *attrs)
    fresh = (new_versions.unionByName(brand_new)
             .withColumn("current_flag", F.lit(True)).withColumn("valid_from", day)
             .withColumn("valid_to", F.lit(None).cast("date")))
    fresh = with_new_keys(fresh, [nk], key, max_key(dim, key))
    return reduce(DataFrame.unionByName, [history.select(*cols), kept, closed.select(*cols), fresh.select(*cols)])


def version_chain(dim: DataFrame, changes: DataFrame, nk: str, key: str, tracked: list[str], at: str) -> DataFrame:
    """T8 for batches with any number of versions of a member, in any order (``at``: since when one holds).

    Stored and incoming versions of the members concerned are merged by day.  Of several of one day the newest
    incoming counts (ties: the larger hash) and keeps the stored key; neighbours equal in ``tracked`` become one span with
    the attributes of the last and the first stored key; a span ends where the next one begins.  Changes without a member or
    a day are left out.  A window holds the days of one member: bounded by the calendar, as days are
    reduced by an aggregate before it.
    """
    cols = dim.columns
    attrs = [c for c in cols if c not in (nk, key, "current_flag", "valid_from", "valid_to")]
    versions = changes.where(F.col(nk).isNotNull() & F.col(at).isNotNull())
    newest = (versions.groupBy(nk, F.to_date(at).alias("_at"))
              .agg(F.max_by(F.struct(*attrs), F.struct(F.col(at), F.xxhash64(*attrs))).alias("_new")))
    members = newest.select(nk).distinct()
    stored = dim.join(members, nk, "left_semi").select(
        nk, F.coalesce("valid_from", F.to_date(F.lit("0001-01-01"))).alias("_at"), F.struct(*attrs).alias("_old"), F.col(key).alias("_key"))
    merged = stored.join(newest, [nk, "_at"], "full_outer").select(nk, "_at", "_key", F.coalesce("_new", "_old").alias("_v"))
    days = Window.partitionBy(nk).orderBy("_at")
    content = F.struct(*[F.col(f"_v.{c}") for c in tracked])
    starts = merged.withColumn("_content", content)
    starts = starts.withColumn("_new_span", (F.row_number().over(days) == 1) | ~F.col("_content").eqNullSafe(F.lag("_content").over(days)))
    spans = (starts.withColumn("_span", F.sum(F.col("_new_span").cast("int")).over(days))
             .groupBy(nk, "_span").agg(F.min("_at").alias("_at"), F.max_by("_v", "_at").alias("_v"), F.min_by("_key", F.when(F.col("_key").isNotNull(), F.col("_at"))).alias("_key")))
    ended = spans.withColumn("valid_to", F.lead("_at").over(Window.partitionBy(nk).orderBy("_at")))
    rows = materialize(ended.select(
        nk, *[F.col(f"_v.{c}").alias(c) for c in attrs], F.col("valid_to").isNull().alias("current_flag"),
        F.when(F.col("_at") > F.to_date(F.lit("0001-01-01")), F.col("_at")).alias("valid_from"), "valid_to", "_key"), "spans")
    fresh = with_new_keys(rows.where(F.col("_key").isNull()).drop("_key"), [nk, "valid_from"], key, max_key(dim, key))
    known = rows.where(F.col("_key").isNotNull()).withColumnRenamed("_key", key)
    untouched = dim.join(members, nk, "left_anti")
    return reduce(DataFrame.unionByName, [x.select(*cols) for x in (untouched, known, fresh)])
