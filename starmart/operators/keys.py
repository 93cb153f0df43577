"""Dense surrogate keys without a single-task window.

``assign_dense_key`` numbers rows 1..n in the order of ``order_cols``, the
same result as ``row_number() OVER (ORDER BY order_cols)`` when the order is
unique, but computed in parallel:

1. range-partition on the order columns (adaptive execution sizes the partitions) and sort
   each partition;
2. tag rows with ``monotonically_increasing_id`` (partition id in the high
   bits, position in the partition in the low 33 bits);
3. write the tagged rows to the shared folder as Parquet, so the partition layout
   and positions are fixed (the range bounds come from sampling) and a lost
   executor re-reads instead of re-sampling;
4. count rows per partition, from the tag column alone.  That table has one row per partition
   (bounded by the partition count, not by the data): it comes to the driver and becomes an array
   of offsets in the plan, a size bound that holds at any volume.  The keyed rows are a projection of the
   written ones, so they need not be written again to cut their lineage.

``sequence_within`` gives ``row_number() OVER (PARTITION BY g ORDER BY o)`` from the same range partitions over
(g, o): a place in the group within its partition, plus what earlier partitions hold of the group that a
partition begins with.  A hot group is split across range partitions instead of landing in one task, and the
rows cross the network once, without a join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import materialize

_LOW_BITS = (1 << 33) - 1


def assign_dense_key(df: DataFrame, order_cols: list[str], key_col: str,
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` (BIGINT, 1..n) in the order of ``order_cols``."""
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = materialize(ranged.sortWithinPartitions(*order)
                               .withColumn("_sm_mid", F.monotonically_increasing_id()), "keys")
    pid = F.shiftright("_sm_mid", 33)
    counts = sorted((r[0], r[1]) for r in tagged.groupBy(pid.alias("p")).count().collect())
    offsets, running = [0] * (counts[-1][0] + 1 if counts else 1), 0
    for p, c in counts:
        offsets[p] = running
        running += c
    before = F.get(F.array(*[F.lit(n).cast("bigint") for n in offsets]), pid.cast("int"))
    return (tagged.withColumn(key_col, (before + F.col("_sm_mid").bitwiseAND(F.lit(_LOW_BITS)) + 1).cast("bigint"))
                  .drop("_sm_mid"))


def _places(n_group: int, distinct: bool):
    """Adds to sorted rows their place in the group (the first ``n_group`` columns), from 1; whether the partition begins
    with that group; and an edge (1: first row of the partition, 2: last one, 3: both).  ``distinct`` drops rows
    equal to the one before.  Self-contained, so that workers need no copy of this package for staging."""
    def changes(column: pa.ChunkedArray) -> np.ndarray:
        """For each value but the first: whether it differs from the one before it (nulls are alike, and NaNs)."""
        now, last = column.slice(1), column.slice(0, len(column) - 1)
        differs = pc.fill_null(pc.not_equal(now, last), False)
        if pa.types.is_floating(column.type):
            differs = pc.and_(differs, pc.invert(pc.fill_null(pc.and_(pc.is_nan(now), pc.is_nan(last)), False)))
        return np.asarray(pc.or_(differs, pc.xor(pc.is_null(now), pc.is_null(last))), dtype=bool)

    def run(batches):
        held, last, place, leading = None, None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [held, batch])
            changed = [changes(rows.column(i)) for i in range(rows.num_columns if distinct else n_group)]
            starts = np.logical_or.reduce(changed[:n_group])
            kept = np.logical_or.reduce(changed) if distinct else np.ones(len(starts), bool)
            if held is None:  # the first row has none before it
                starts, kept = np.append(True, starts), np.append(True, kept)
            held = batch.slice(batch.num_rows - 1)
            starts = starts[kept]
            if not len(starts):
                continue
            at = np.arange(len(starts))
            places = at - np.maximum.accumulate(np.where(starts, at, -place)) + 1
            first = np.cumsum(starts) <= (1 if place == 0 else 0) if leading else np.zeros(len(starts), bool)
            edge = np.zeros(len(starts), np.int32)
            edge[0] = place == 0
            place, leading = int(places[-1]), bool(first[-1])
            out = batch if kept.all() else batch.filter(pa.array(kept))
            out = pa.RecordBatch.from_arrays([*out.columns, pa.array(places), pa.array(first), pa.array(edge)],
                                             names=[*out.schema.names, "_sm_place", "_sm_first", "_sm_edge"])
            if last is not None:
                yield last
            yield out.slice(0, out.num_rows - 1)
            last = out.slice(out.num_rows - 1)  # which row is the last is known at the end
        if last is not None:
            edge = pa.array([last.column(last.num_columns - 1)[0].as_py() + 2], pa.int32())
            yield pa.RecordBatch.from_arrays([*last.columns[:-1], edge], names=last.schema.names)
    return run


def sequence_within(df: DataFrame, group_cols: list[str], order_cols: list[str], seq_col: str,
                    num_partitions: int | None = None, distinct: bool = False) -> DataFrame:
    """Add ``seq_col`` (INT, 1..k inside each group) in the order of ``order_cols``.

    ``distinct``: of rows equal in group and order, one counts and stays (``df`` has no other columns then).
    """
    by = [*group_cols, *order_cols]
    others = [c for c in df.columns if c not in by]
    if distinct and others:
        raise ValueError(f"rows can't be told apart by group and order alone: {others}")
    order = [F.col(c).asc_nulls_first() for c in by]
    ranged = df.select(*by, *others)
    ranged = ranged.repartitionByRange(num_partitions, *order) if num_partitions else ranged.repartitionByRange(*order)
    schema = T.StructType([*ranged.schema.fields, T.StructField("_sm_place", T.LongType()),
                           T.StructField("_sm_first", T.BooleanType()), T.StructField("_sm_edge", T.IntegerType())])
    placed = ranged.sortWithinPartitions(*order).mapInArrow(_places(len(group_cols), distinct), schema)
    tagged = materialize(placed.withColumn("_sm_pid", F.spark_partition_id()), "keys")
    # two rows per partition at most, bounded as in ``assign_dense_key``: its ends
    ends = tagged.where("_sm_edge > 0").select("_sm_pid", "_sm_edge", "_sm_place", "_sm_first", *group_cols).collect()
    ahead, before, carried = [0] * (max((r[0] for r in ends), default=0) + 1), None, 0
    for pid, edge, place, leading, *group in sorted(ends, key=lambda r: (r[0], r[1])):
        if edge != 2:
            ahead[pid] = carried if repr(before) == repr(group) else 0
        if edge != 1:
            before, carried = group, place + (ahead[pid] if leading else 0)
    more = F.get(F.array(*[F.lit(n).cast("bigint") for n in ahead]), F.col("_sm_pid"))
    seq = F.col("_sm_place") + F.when(F.col("_sm_first"), more).otherwise(F.lit(0))
    return tagged.select(*df.columns, seq.cast("int").alias(seq_col))
