"""Sharding indivisible groups by best-fit-decreasing bin packing (operator 5).

Groups (equal texts) enter, largest first, the bin with the least remaining capacity
that still holds them; open bins stand in a balanced search tree (an AA tree)
by remaining capacity.

* ``pack`` packs any number of groups into bins of a fixed capacity.  Groups are
  dealt into parts by hash; each part is packed in one pass over its sorted
  rows and keeps only its open bins.  At most one bin of a part stays under half full, so
  the bins are at most one a part more than twice the least number possible, and close to
  it when groups are small.
* ``shard_of_groups`` fills a fixed number of shards evenly: ``pack`` makes crates of
  1 / ``crates`` of a shard; the under-full ones, one a part, are packed together in Spark; then the crates (at most
  twice shards x crates, and one in ``PART`` parts) are packed on the driver, with the least capacity at which best-fit-decreasing needs
  no more bins than there are shards.  A group beyond an even share gets a shard of its own.

The law held is ``bytes``: shard sizes in bytes are near equal, as far as
indivisible groups allow.  Size is the text's UTF-8 length plus 1.

Defined results: a null text has size 1; null texts are one group, empty texts another;
repeated rows stay together, each with its own slot; ties go by the group's hash;
an empty table gives an empty result; extra columns are kept by ``shard_rows``
and ignored by ``sharded``.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_runs, materialise, partitions, running_totals, spread_bits

#: groups of one part, about
PART = 1 << 16
#: rows of one slot-numbering window, about
GROUP = 1 << 12


class CapacityTree:
    """Open bins by (remaining, bin) in an AA tree: balanced, least fitting one first."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # node: [key, level, left, right]

    @staticmethod
    def _skew(t):
        if t[2] is not None and t[2][1] == t[1]:
            left = t[2]
            t[2], left[3] = left[3], t
            return left
        return t

    @staticmethod
    def _split(t):
        if t[3] is not None and t[3][3] is not None and t[3][3][1] == t[1]:
            right = t[3]
            t[3], right[2] = right[2], t
            right[1] += 1
            return right
        return t

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def _add(self, t, key):
        if t is None:
            return [key, 1, None, None]
        side = 2 if key < t[0] else 3
        t[side] = self._add(t[side], key)
        return self._split(self._skew(t))

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def _remove(self, t, key):
        if key < t[0]:
            t[2] = self._remove(t[2], key)
        elif key > t[0]:
            t[3] = self._remove(t[3], key)
        elif t[2] is None and t[3] is None:
            return None
        elif t[2] is None:
            after = t[3]
            while after[2] is not None:
                after = after[2]
            t[0] = after[0]
            t[3] = self._remove(t[3], after[0])
        else:
            before = t[2]
            while before[3] is not None:
                before = before[3]
            t[0] = before[0]
            t[2] = self._remove(t[2], before[0])
        should = min(t[2][1] if t[2] else 0, t[3][1] if t[3] else 0) + 1
        if should < t[1]:
            t[1] = should
            if t[3] is not None and t[3][1] > should:
                t[3][1] = should
        t = self._skew(t)
        if t[3] is not None:
            t[3] = self._skew(t[3])
            if t[3][3] is not None:
                t[3][3] = self._skew(t[3][3])
        t = self._split(t)
        if t[3] is not None:
            t[3] = self._split(t[3])
        return t

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The key with the least remaining capacity of at least ``size``."""
        t, found = self.root, None
        while t is not None:
            if t[0][0] >= size:
                found, t = t[0], t[2]
            else:
                t = t[3]
        return found


def best_fit(sizes: Iterable[int], capacity: int, first_bin: int = 0):
    """The bin of each size, in the order given (largest first for best-fit-decreasing).

    A size beyond the capacity gets a bin of its own.
    """
    tree, opened = CapacityTree(), first_bin
    for size in sizes:
        found = tree.tightest(size)
        if found is None:
            chosen, rest = opened, capacity - size
            opened += 1
        else:
            tree.remove(found)
            chosen, rest = found[1], found[0] - size
        if rest > 0:
            tree.add((rest, chosen))
        yield chosen


def pack(groups: DataFrame, capacity: int) -> DataFrame:
    """(g, part, bin) for groups (g bigint, size bigint): bins of ``capacity``, numbered within parts."""
    parts = 1 << spread_bits(groups.count(), PART)
    sorted_groups = (groups.select(F.pmod(F.xxhash64("g"), F.lit(parts)).alias("part"), "g", "size")
                     .repartition(min(parts, partitions(groups.sparkSession)), "part")
                     .sortWithinPartitions("part", F.desc("size"), "g"))

    def run(batches):
        # one run per part; only the sizes of a part and its open bins are held
        for (part,), rows in group_runs(batches, 1):
            bins = list(best_fit(rows["size"].to_pylist(), capacity))
            made = pa.table({"g": rows["g"], "part": rows["part"], "bin": pa.array(bins, pa.int64())})
            yield from made.combine_chunks().to_batches()

    return sorted_groups.mapInArrow(run, "g bigint, part bigint, bin bigint")


def fill_shards(sizes: list[int], n_shards: int) -> list[int]:
    """A shard for each size (largest first), as even as best-fit-decreasing makes it."""
    out, left, open_shards, at = [], sum(sizes), n_shards, 0
    while at < len(sizes) and open_shards > 1 and sizes[at] * open_shards > left:
        out.append(n_shards - open_shards)  # more than an even share: alone
        left -= sizes[at]
        open_shards -= 1
        at += 1
    rest = sizes[at:]
    if not rest:
        return out
    low, high = max(rest[0], -(-left // open_shards)), left
    while low < high:
        middle = (low + high) // 2
        if max(best_fit(rest, middle)) < open_shards:
            high = middle
        else:
            low = middle + 1
    return out + list(best_fit(rest, high, n_shards - open_shards))


def crates_of_groups(groups: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """((g, part, bin), (part, bin, size)): ``pack``, and the crates under half full, one a part at most, packed once more.

    So under-full crates are as many as there are parts of parts; those made of crates have negative part numbers.
    """
    packed = materialise(pack(groups, capacity), "crates")
    loads = materialise(packed.join(groups, "g").groupBy("part", "bin").agg(F.sum("size").alias("size")), "loads")
    small = loads.where(F.col("size") * 2 < capacity).withColumn("crate", F.shiftleft("part", 32) + F.col("bin"))
    again = materialise(pack(small.select(F.col("crate").alias("g"), "size"), capacity)
                        .select(F.col("g").alias("crate"), (-1 - F.col("part")).alias("into"), F.col("bin").alias("at")), "crates")
    moved = small.join(again, "crate")
    final = (loads.where(F.col("size") * 2 >= capacity)
             .unionByName(moved.groupBy(F.col("into").alias("part"), F.col("at").alias("bin")).agg(F.sum("size").alias("size"))))
    placed = packed.join(moved.select("part", "bin", "into", "at"), ["part", "bin"], "left").select(
        "g", F.coalesce("into", "part").alias("part"), F.coalesce("at", "bin").alias("bin"))
    return placed, final


def shard_of_groups(groups: DataFrame, n_shards: int, crates: int = 256) -> DataFrame:
    """(g, shard) for groups (g, size)."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    placed, final = crates_of_groups(groups, max(1, total // (n_shards * crates)))
    # at most twice shards x crates are half full or more, and one in PART parts is not
    loads = final.orderBy(F.desc("size"), "part", "bin").collect()
    shards = fill_shards([r["size"] for r in loads], n_shards)
    dealt = groups.sparkSession.createDataFrame(
        [(r["part"], r["bin"], s) for r, s in zip(loads, shards)], "part bigint, bin bigint, shard int")
    return placed.join(F.broadcast(dealt), ["part", "bin"]).select("g", "shard")


def shard_rows(rows: DataFrame, n_shards: int, key: str = "doc_id") -> DataFrame:
    """``rows`` (with columns _g: group, _size) plus shard and slot; slots are gapless from 0."""
    groups = materialise(rows.groupBy(F.col("_g").alias("g")).agg(F.sum("_size").alias("size")), "groups")
    placed = rows.join(shard_of_groups(groups, n_shards), F.col("_g") == F.col("g")).drop("g")
    bits = spread_bits(rows.count(), GROUP)
    hashed = F.xxhash64(key)
    bucket = F.shiftrightunsigned(hashed, 64 - bits) if bits else F.lit(0).cast("long")
    placed = placed.withColumn("_h", hashed).withColumn("_b", bucket).withColumn("_one", F.lit(1))
    return running_totals(placed, ["shard"], "_b", ["_h", key, "_g"], "_one", "slot").drop("_h", "_b", "_one")


def text_size(text="text"):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def sharded(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document."""
    narrow = materialise(docs.select("doc_id", text_size().alias("_size"), F.xxhash64("text").alias("_g"),
                                     F.crc32(F.encode("text", "UTF-8")).alias("text_crc32")), "sized")
    return shard_rows(narrow, n_shards).select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
