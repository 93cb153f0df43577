"""Helpers that several of the data-preparation operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path

#: what separates words: space and the control characters 0x09 to 0x0D
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    """The named columns of a table; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder as Parquet and read back.

    Lost executors then cost a re-read, not a recomputation, and values that
    depend on task layout (range bounds, positions) are fixed.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words (null: 0); whole text."""
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(words)).cast("long")


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column of a batch as UTF-8 bytes, without decoding."""
    return column.cast(pa.large_binary()).to_pylist()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_bits(rows: int, per_bucket: int) -> int:
    """How many bits of a hash to bucket by, so that buckets hold about ``per_bucket`` rows."""
    return max(0, (max(rows, 1) // per_bucket).bit_length())


def hash_bucket(hashed: Column, bits: int) -> Column:
    """The top ``bits`` bits of a 64-bit hash, in the order of the unsigned hash."""
    if not bits:
        return F.lit(0).cast("long")
    return F.shiftrightunsigned(hashed, 64 - bits)


def running_totals(df: DataFrame, group: list[str], bucket: str, order: list[str],
                   value: str, before: str, levels: int = 1) -> DataFrame:
    """Per group, the sum of ``value`` over all rows that precede a row in (bucket, order).

    Several levels keep a hot group out of a single task: a window inside each
    (group, bucket), and a window over one total per bucket; with more ``levels`` those
    totals are summed the same way in buckets of 4096 of them.  Rows that tie on
    the whole order get adjoining places; ``order`` must hold all columns that
    tell rows apart.
    """
    inside = (Window.partitionBy(*group, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local, ahead, total = (f"_{x}{levels}" for x in ("local", "ahead", "total"))
    counted = df.withColumn(local, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias(total))
    if levels > 1:
        wide = f"_wide{levels}"
        totals = running_totals(totals.withColumn(wide, F.shiftright(bucket, 12)), group, wide, [bucket], total,
                                ahead, levels - 1).drop(wide)
    else:
        over = (Window.partitionBy(*group).orderBy(bucket)
                .rowsBetween(Window.unboundedPreceding, -1))
        totals = totals.withColumn(ahead, F.coalesce(F.sum(total).over(over), F.lit(0)))
    names = [*group, bucket]
    totals = totals.select(*[F.col(c).alias(f"_t{levels}_{c}") for c in names], ahead)
    on = [F.col(c).eqNullSafe(F.col(f"_t{levels}_{c}")) for c in names]
    return (counted.join(totals, on, "inner")
                   .withColumn(before, (F.col(local) + F.col(ahead)).cast("long"))
                   .drop(local, ahead, *[f"_t{levels}_{c}" for c in names]))


def group_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows that stand together in a sorted partition: (key values, rows).

    The first ``keys`` columns are the key.  Holds one group at a time.
    """
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        marks = list(zip(*columns))
        start = 0
        for i, mark in enumerate(marks):
            if mark != current:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield current, pa.Table.from_batches(held)
                held, current, start = [], mark, i
        held.append(batch.slice(start))
    if held:
        yield current, pa.Table.from_batches(held)
