"""Packing documents into token sequences by a grouping genetic algorithm (operator 13).

``token_pieces`` tokenises every document (its ids, then the end id) and cuts only those longer
than a sequence.  ``pack_sequences`` packs the pieces.  Whole sequences are done; the
others are dealt at random into parts of about ``PART`` pieces, and each part is packed by ``ISLANDS``
islands:

* a member is an assignment of pieces to bins; the first ones are best-fit packings in decreasing
  and in perturbed orders, and the grouping that the pieces came with;
* crossover injects whole well-filled bins of one parent into the other, takes out the bins that
  hold a piece twice and the emptiest one, and places the displaced pieces by best fit, largest first;
* fitness is fewer bins, then the mean square of their fill;
* after each epoch the best member of an island migrates to the next one (a shuffle).  A part that
  needs no more bins than its tokens fill is finished early.

In every part but the last, the emptiest eighth of the bins is then dissolved; their pieces,
grouped as they were, are dealt into parts again, eight times fewer, until one part is left.  As a part never
packs its pieces worse than they came, a level never adds a sequence.  A task holds one part.

Defined results: a null text counts as empty (the end id alone); a text is processed whole,
in stretches of about 1 MB, and its ids are held as 4 bytes each; repeated rows and null ids are
documents of their own; ties go by position in the part; an empty table gives an empty result; extra columns are
ignored.  Sequence numbers depend on the layout of the written pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, partitions, utf8

CAPACITY = 2048
PART = 4096
ISLANDS, EPOCHS, OFFSPRING, POPULATION = 2, 2, 12, 5
#: at each level one bin in so many is dissolved, and there are as many times fewer parts
SHRINK = 8


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) for every document."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]])

    def run(batches):
        from .tokens import encoder

        to_ids, end = encoder(path), np.array([end_id], "<u4")
        for batch in batches:
            rows, cuts = [], []
            for row, found in enumerate(to_ids.encode([t or b"" for t in utf8(batch.column(1))])):
                ids = np.concatenate([found, end])
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    rows.append(row)
                    cuts.append((piece, at, len(part), zlib.crc32(part.tobytes())))
            if rows:
                piece, start, length, crc = zip(*cuts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(piece, pa.int32()),
                     *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                    names=["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


class Bins:
    """Bins by what they have left, for best fit in a few steps: a bit for each amount with a bin."""

    def __init__(self, capacity: int):
        self.capacity, self.bits, self.held = capacity, 0, [[] for _ in range(capacity + 1)]

    def open(self, bin_: int, left: int) -> None:
        if left > 0:
            self.held[left].append(bin_)
            self.bits |= 1 << left

    def place(self, size: int, fresh: int) -> int:
        """The bin with the least room for ``size`` (``fresh`` if none has it), which gets it."""
        able = self.bits >> size
        if not able:
            self.open(fresh, self.capacity - size)
            return fresh
        left = size + (able & -able).bit_length() - 1
        held = self.held[left]
        chosen = held.pop()
        if not held:
            self.bits ^= 1 << left
        self.open(chosen, left - size)
        return chosen


def best_fit(sizes: np.ndarray, order: np.ndarray, capacity: int, member: np.ndarray, loads: list[int]) -> np.ndarray:
    """``member`` with the pieces ``order`` placed, one after the other, beside bins of ``loads``."""
    bins = Bins(capacity)
    for b, load in enumerate(loads):
        bins.open(b, capacity - load)
    fresh, out = len(loads), member.copy()
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        chosen = bins.place(size, fresh)
        fresh += chosen == fresh
        out[i] = chosen
    return out


def renumbered(member: np.ndarray) -> np.ndarray:
    return np.unique(member, return_inverse=True)[1].astype(np.int32)


def fitness(member: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, float]:
    """Smaller is better: bins, then what is lacking in the mean square of their fill."""
    loads = np.bincount(member, sizes)
    return len(loads), 1.0 - float(np.mean((loads / capacity) ** 2))


def crossed(rng, giver: np.ndarray, taker: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A child: whole well-filled bins of ``giver`` in ``taker``, displaced pieces by best fit."""
    fill = np.bincount(giver, sizes)
    good = np.argsort(-fill, kind="stable")[:max(1, len(fill) // 2)]
    pick = np.zeros(len(fill), bool)
    pick[rng.choice(good, max(1, len(good) // 4), replace=False)] = True
    injected = pick[giver]
    load = np.bincount(taker, sizes)
    hit = np.zeros(len(load), bool)
    hit[taker[injected]] = True
    hit[np.argmin(load)] = True
    displaced = hit[taker] & ~injected
    child = np.where(injected, giver + len(load), taker)
    stays = ~displaced
    child[stays] = renumbered(child[stays])
    loads = np.bincount(child[stays], sizes[stays]).astype(int).tolist() if stays.any() else []
    which = np.flatnonzero(displaced)
    return best_fit(sizes, which[np.argsort(-sizes[which], kind="stable")], capacity, child, loads)


def evolve(seed: list[int], sizes: np.ndarray, members: list[np.ndarray], capacity: int, offspring: int,
           population: int) -> list[np.ndarray]:
    """The population after some offspring, best first."""
    rng = np.random.default_rng(seed)
    none, least = np.zeros(len(sizes), np.int32), -(-int(sizes.sum()) // capacity)
    scored = [(fitness(m, sizes, capacity), m) for m in members]
    if len(scored) < population and min((s[0][0] for s in scored), default=len(sizes) + 1) > least:
        for n in range(population - len(scored)):
            noise = 1 + 0.1 * n * rng.random(len(sizes))
            made = best_fit(sizes, np.argsort(-sizes * noise, kind="stable"), capacity, none, [])
            scored.append((fitness(made, sizes, capacity), made))
            if scored[-1][0][0] == least:
                break
    scored.sort(key=lambda s: s[0])
    for _ in range(offspring):
        if scored[0][0][0] == least or len(scored) < 2:
            break
        a, b = rng.choice(len(scored), 2, replace=False)
        child = crossed(rng, scored[a][1], scored[b][1], sizes, capacity)
        scored.append((fitness(child, sizes, capacity), child))
        scored.sort(key=lambda s: s[0])
        scored = scored[:population]
    return [m for _, m in scored]


_STATE = "part bigint, island int, pids array<bigint>, sizes array<int>, members array<array<int>>, bins int, lack double, done boolean"


def _epoch(level: int, epoch: int, capacity: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                members = [renumbered(np.array(m, np.int64)) for m in row["members"]]
                best = evolve([level, epoch, row["part"], row["island"]], sizes, members, capacity, OFFSPRING, POPULATION)
                bins, lack = fitness(best[0], sizes, capacity)
                row |= {"members": [m.tolist() for m in best[:2]], "bins": int(bins), "lack": lack,
                        "done": int(bins) == -(-int(sizes.sum()) // capacity)}
                yield pa.RecordBatch.from_pylist([row], schema=out)

    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    out = pa.schema([("part", pa.int64()), ("island", pa.int32()), ("pids", longs), ("sizes", ints),
                     ("members", pa.list_(ints)), ("bins", pa.int32()), ("lack", pa.float64()), ("done", pa.bool_())])
    return run


def _settled(level: int, capacity: int, last: bool):
    """Places of the pieces of a part; ``stays`` is false for those of dissolved bins."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pids, sizes, member = (np.array(row[c], np.int64) for c in ("pids", "sizes", "member"))
                loads = np.bincount(member, sizes).astype(np.int64)
                dissolved = np.zeros(len(loads), bool)
                if not last:
                    emptiest = np.argsort(loads, kind="stable")[:max(1, len(loads) // SHRINK)]
                    dissolved[emptiest[loads[emptiest] < capacity]] = True
                order = np.argsort(member, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                first = np.concatenate([[0], np.cumsum(loads)[:-1]])
                offset = np.empty(len(pids), np.int64)
                offset[order] = before - first[member[order]]
                yield pa.RecordBatch.from_pydict({
                    "pid": pids, "length": sizes, "offset": offset, "stays": ~dissolved[member],
                    "sequence_id": (level << 57) + (row["part"] << 17) + member})

    return run


def pack_level(items: DataFrame, parts: int, level: int, capacity: int, last: bool) -> DataFrame:
    """(pid, length, offset, stays, sequence_id) for items (pid, length, was): the genetic algorithm in each part."""
    spark = items.sparkSession
    part = F.pmod(F.xxhash64("was", F.lit(level)), F.lit(parts)).alias("part")
    grouped = items.groupBy(part).agg(F.array_sort(F.collect_list(F.struct("was", "pid", "length"))).alias("all"))
    grouped = materialise(grouped, "parts")
    state = grouped.select("part", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
                           F.transform("all", lambda x: x["pid"]).alias("pids"),
                           F.transform("all", lambda x: x["length"].cast("int")).alias("sizes"),
                           # from the second level on, the grouping that the pieces came with is a member
                           (F.array(F.transform("all", lambda x: x["was"])) if level
                            else F.array().cast("array<array<bigint>>")).alias("members"))
    tasks = min(parts * ISLANDS, 8 * partitions(spark))
    held = state.repartition(tasks, "part", "island").mapInArrow(_epoch(level, 0, capacity), _STATE)
    held = materialise(held, "island")
    for epoch in range(1, EPOCHS):
        going = held.groupBy("part").agg(F.max("done").alias("ended")).where("NOT ended").select("part")
        if going.isEmpty():
            break
        guests = held.select("part", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"),
                             F.slice("members", 1, 1).alias("guest"))
        live = held.join(going, "part").join(guests, ["part", "island"])
        live = live.select("part", "island", "pids", "sizes", F.concat("members", "guest").alias("members"))
        moved = materialise(live.repartition(tasks, "part", "island")
                            .mapInArrow(_epoch(level, epoch, capacity), _STATE), "island")
        held = moved.unionAll(held.join(going, "part", "left_anti").select(*moved.columns))
    best = held.groupBy("part").agg(F.min_by(F.struct("pids", "sizes", F.element_at("members", 1).alias("member")),
                                             F.struct("bins", "lack", "island")).alias("b"))
    places = best.select("part", "b.pids", "b.sizes", "b.member").mapInArrow(
        _settled(level, capacity, last), "pid bigint, length bigint, offset bigint, stays boolean, sequence_id bigint")
    return materialise(places, "places")


def pack_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(pid, sequence_id, offset) for pieces (pid: unique, length)."""
    whole = pieces.where(F.col("length") >= capacity).select(
        "pid", (-1 - F.col("pid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < capacity).select("pid", "length", F.col("pid").alias("was"))
    placed, level, n = whole, 0, rest.count()
    parts = max(1, -(-n // PART))
    while n:
        done = pack_level(rest, parts, level, capacity, parts == 1)
        placed = placed.unionAll(done.where("stays").select("pid", "sequence_id", "offset"))
        if parts == 1:
            break
        rest = done.where("NOT stays").select("pid", "length", F.col("sequence_id").alias("was"))
        n, level, parts = rest.count(), level + 1, max(1, -(-parts // SHRINK))
    return placed


def packed_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    pieces = materialise(token_pieces(docs, path, capacity, 0, id_col, text_col)
                         .withColumn("pid", F.monotonically_increasing_id()), "pieces")
    return pieces.join(pack_sequences(pieces.select("pid", "length"), capacity), "pid").select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
