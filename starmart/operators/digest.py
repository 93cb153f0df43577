"""Content digests: one number that stands for a row and all rows that belong to it, in any order.

Each row is hashed with the name of its table; the hashes of one key are summed in two halves, so equal rows don't
cancel and the sum has a map-side partial step, which keeps a key with very many rows out of a single
task.  Two contents of one key share a digest with a chance of about 2^-64.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_hash(df: DataFrame, label: str = "") -> Column:
    """Hash of a whole row; a null differs from any value, and columns count by name, not by place."""
    names = sorted(df.columns)
    return F.xxhash64(F.lit(label), *[x for c in names for x in (F.col(c).isNull(), F.col(c))])


def halves(hashed: Column) -> tuple[Column, Column]:
    """The sums of the upper and the lower 32 bits (exact for up to 2^31 rows)."""
    return F.sum(F.shiftright(hashed, 32)), F.sum(hashed.bitwiseAND(F.lit(0xFFFFFFFF)))


def summed(hashed: Column) -> Column:
    """The digest of a group of row hashes (null: no rows)."""
    high, low = halves(hashed)
    n = F.count(hashed)
    return F.when(n > 0, F.xxhash64(high, low, n))


def amount_parts(value: Column, kind: T.DecimalType) -> tuple[Column, Column]:
    """An amount of 18 digits at most as two whole numbers, as sums of longs take a fraction of the time of decimal ones."""
    if kind.precision > 18:
        raise ValueError(f"{kind.simpleString()} does not fit a long")
    units = (value * F.lit(10 ** kind.scale)).cast("bigint")
    return F.shiftright(units, 32), units.bitwiseAND(F.lit(0xFFFFFFFF))


def amount(high: Column, low: Column, kind: T.DecimalType) -> Column:
    """The sum of amounts from the sums of their parts, exact and typed as Spark's own sum."""
    units = high.cast("decimal(20,0)") * F.lit(Decimal(2 ** 32)) + low.cast("decimal(20,0)")
    return (units * F.lit(Decimal(1).scaleb(-kind.scale))).cast(T.DecimalType(min(38, kind.precision + 10), kind.scale))


def content_digests(parent: DataFrame, key: str, children: dict[str, DataFrame],
                    sums: dict[str, tuple[str, str]] | None = None, counts: dict[str, str] | None = None) -> DataFrame:
    """(key, digest) for the rows of ``parent``, over them and their rows in ``children``.

    The same pass adds up amounts of the children (``sums``: name -> table and decimal column; null where a key has no
    value) and counts their rows (``counts``: name -> table).
    """
    sums, counts = sums or {}, counts or {}
    tables = {"": parent, **children}
    kinds = {name: children[t].schema[c].dataType for name, (t, c) in sums.items()}
    parts = lambda name: (f"_{name}_high", f"_{name}_low")

    def hashed(table: str, df: DataFrame) -> DataFrame:
        values = [(x if t == table else F.lit(None).cast("bigint")).alias(part) for name, (t, c) in sums.items()
                  for x, part in zip(amount_parts(F.col(c), kinds[name]), parts(name))]
        marks = [F.lit(1 if t == table else None).cast("int").alias(f"_{name}") for name, t in counts.items()]
        return df.where(F.col(key).isNotNull()).select(key, row_hash(df, table).alias("_h"), F.lit(not table).alias("_p"), *values, *marks)

    every = reduce(DataFrame.unionAll, [hashed(table, df) for table, df in tables.items()])
    return (every.groupBy(key).agg(summed(F.col("_h")).alias("digest"), F.max("_p").alias("_p"),
                                   *[amount(*[F.sum(part) for part in parts(name)], kinds[name]).alias(name) for name in sums],
                                   *[F.count(f"_{name}").alias(name) for name in counts])
            .where("_p").drop("_p"))


def table_digest(df: DataFrame) -> str:
    """The digest of a whole table, as text."""
    return str(df.agg(summed(row_hash(df)).alias("d")).first()["d"])


def changes(now: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """(key, change: new, modified or removed) from two sets of digests."""
    a = now.select(key, F.col("digest").alias("_now"))
    b = stored.select(key, F.col("digest").alias("_stored"))
    kind = F.when(F.col("_stored").isNull(), "new").when(F.col("_now").isNull(), "removed").otherwise("modified")
    return (a.join(b, key, "full_outer").where(~F.col("_now").eqNullSafe(F.col("_stored")))
            .select(key, kind.alias("change")))
