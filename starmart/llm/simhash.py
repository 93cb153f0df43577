"""SimHash near-duplicates by the generalised pigeonhole principle (operator 10).

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, all shingles of
``shingle`` words joined by a space (fewer words: the whole sequence), each
hashed by XXH64 with seed 42; a bit is set if it is set in over half the hashes.

Linking works on distinct fingerprints.  The 64 bits are dealt into ``parts``
partitions so that correlated bits stand together.  If two fingerprints differ in at
most ``d`` bits, then for any thresholds t_i with sum(t_i + 1) = d + 1 some
partition differs in at most t_i bits (t_i = -1: not probed).  Each fingerprint
gets its own thresholds by dynamic programming on the number of candidates: the
exact size of its block for t_i = 0, the expected size of the neighbouring blocks
above that.  It probes the blocks and every candidate is verified.

A fingerprint for which no allocation stays under ``most`` candidates (a crowded
block) takes the one-partition allocation instead (all bits, threshold d): the
enumeration is split between the two sides, so it emits itself and its neighbours within
d // 2 bits (and within (d + 1) // 2 for odd d), and fingerprints that meet at such
a point are linked through it.  A link needs one probing side or two
enumerating ones, so none is lost and no block is expanded into all its pairs.

Defined results: null and empty texts and texts without words have fingerprint 0 and
are linked like any other; repeated rows and repeated ids are kept; an empty table
gives an empty result; further columns are ignored; a null id takes part in the
links but is never the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, utf8
from .components import components

BITS = 64
SEED = 42
#: shingle hashes that are unpacked into bits at a time
CHUNK = 1 << 15
_PLACE = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint as an unsigned integer."""
    words = (text or b"").lower().split()  # bytes: A-Z only, gaps are 0x20 and 0x09-0x0D
    if not words:
        return 0
    if len(words) < shingle:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        total = len(words) - shingle + 1
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, CHUNK):
        n = min(CHUNK, total - start)
        hashes = np.fromiter((xxhash.xxh64_intdigest(next(shingles), SEED) for _ in range(n)), np.uint64, n)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(_PLACE[ones * 2 > total].sum())


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id_col, fp bigint) for every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64), pa.int64())],
                                             names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def _bit_groups(fps: DataFrame, parts: int) -> list[list[int]]:
    """Bits (0 is the highest) dealt into partitions, correlated bits together.

    Co-occurrence counts over all distinct fingerprints; 65 x 64 sums reach the driver.
    """
    def run(batches):
        both = np.zeros((BITS + 1, BITS))
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).astype(">i8")
            bits = np.unpackbits(raw.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
            both[:BITS] += bits.T @ bits
            both[BITS, 0] += len(bits)
        yield pa.RecordBatch.from_pydict({"row": list(range(BITS + 1)), "sums": both.tolist()})

    summed = (fps.select("fp").mapInArrow(run, "row bigint, sums array<double>")
                 .select("row", F.posexplode("sums")).groupBy("row", "pos").agg(F.sum("col").alias("s")).collect())
    both = np.zeros((BITS + 1, BITS))
    for row, pos, s in summed:
        both[row, pos] = s
    n = max(both[BITS, 0], 1.0)
    mean = np.diag(both[:BITS]) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    near = np.abs(both[:BITS] / n - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(near, 0)
    left, groups = set(range(BITS)), []
    for i in range(parts):
        room = BITS // parts + (i < BITS % parts)
        group = [max(left, key=lambda b: (round(near[b, sorted(left)].sum(), 6), -b))]
        left.remove(group[0])
        while len(group) < room:
            nxt = max(left, key=lambda b: (round(near[b, group].sum(), 6), -b))
            group.append(nxt)
            left.remove(nxt)
        groups.append(sorted(group))
    return groups


def _masks(groups: list[list[int]]) -> list[int]:
    return [int(sum(int(_PLACE[b]) for b in g)) for g in groups]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _flips(bits: list[int], most: int) -> np.ndarray:
    """All masks over ``bits`` with at most ``most`` bits set."""
    out = [0]
    for k in range(1, most + 1):
        out += [int(sum(int(_PLACE[b]) for b in c)) for c in combinations(bits, k)]
    return np.array(out, dtype=np.uint64)


def allocate(sizes: np.ndarray, widths: list[int], rows: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds plus one per fingerprint and partition, and their expected cost.

    ``sizes``: (fingerprints, parts) block sizes.  Knapsack over the partitions:
    spend distance + 1 units, unit e in partition i costs the candidates within e - 1 bits.
    """
    n, parts = sizes.shape
    units = distance + 1
    best = np.full((n, units + 1), np.inf)
    best[:, 0] = 0
    chosen = np.zeros((parts, n, units + 1), dtype=np.int8)
    for i, width in enumerate(widths):
        cost = [np.zeros(n)]
        extra = 0.0
        for e in range(1, units + 1):
            if e > 1:  # each further probe costs itself and the mean load of a block
                extra += comb(width, e - 1) * (1 + rows / 2.0 ** width)
            cost.append(sizes[:, i] + extra)
        new = np.full((n, units + 1), np.inf)
        for u in range(units + 1):
            for e in range(u + 1):
                c = best[:, u - e] + cost[e]
                better = c < new[:, u]
                new[better, u] = c[better]
                chosen[i, better, u] = e
        best = new
    spent = np.zeros((n, parts), dtype=np.int8)
    left = np.full(n, units)
    for i in reversed(range(parts)):
        spent[:, i] = chosen[i, np.arange(n), left]
        left = left - spent[:, i]
    return spent, best[:, units]


def links(fps: DataFrame, distance: int = 2, parts: int = 3, most: int = 64) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect exactly what
    differs in at most ``distance`` bits: every linked pair is joined directly or
    through a third fingerprint within the distance of both."""
    rows = fps.count()
    groups = _bit_groups(fps, parts)
    masks, widths = _masks(groups), [len(g) for g in groups]
    index = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
                       .alias("part", "value"))
    blocks = index.groupBy("part", "value").agg(F.count("*").alias("size"))
    sized = (index.join(blocks, ["part", "value"]).groupBy("fp")
             .agg(*[F.max(F.when(F.col("part") == i, F.col("size"))).alias(f"s{i}") for i in range(parts)]))

    def deal(batches):
        flips = [[_flips(g, e - 1) if e else np.zeros(0, np.uint64) for e in range(distance + 2)] for g in groups]
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.stack([batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(parts)],
                             axis=1).astype(float)
            spent, cost = allocate(sizes, widths, rows, distance)
            crowded = cost > most
            yield pa.RecordBatch.from_pydict({
                "fp": fp[crowded].view(np.int64), "part": np.full(int(crowded.sum()), -1, np.int32),
                "value": np.zeros(int(crowded.sum()), np.int64), "wide": np.ones(int(crowded.sum()), bool)})
            for i in range(parts):
                for e in range(1, distance + 2):
                    own = fp[(spent[:, i] == e) & ~crowded]
                    wide = (spent[(spent[:, i] == e) & ~crowded] > 1).any(axis=1)
                    for at in range(0, len(own), 4096):
                        some = own[at:at + 4096]
                        value = (some & np.uint64(masks[i]))[:, None] ^ flips[i][e][None, :]
                        k = value.shape[1]
                        yield pa.RecordBatch.from_pydict({
                            "fp": np.repeat(some, k).view(np.int64), "part": np.full(value.size, i, np.int32),
                            "value": value.reshape(-1).view(np.int64), "wide": np.repeat(wide[at:at + 4096], k)})

    dealt = materialise(sized.mapInArrow(deal, "fp bigint, part int, value bigint, wide boolean"), "probes")
    # expected loads may be wrong: count what the wide probes would really meet
    over = (dealt.where("wide and part >= 0").join(blocks, ["part", "value"])
            .groupBy("fp").agg(F.sum("size").alias("meets")).where(F.col("meets") > most).select("fp"))
    crowded = materialise(dealt.where("part < 0").select("fp").unionAll(over).distinct(), "crowded")
    probes = dealt.where("part >= 0").join(crowded, "fp", "left_anti")
    met = (probes.join(index.withColumnRenamed("fp", "other"), ["part", "value"])
           .where((F.col("fp") != F.col("other"))
                  & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance))
           .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")))

    near, far = distance // 2, distance - distance // 2

    def enumerate_(batches):
        flips = _flips(list(range(BITS)), far)
        # for odd distances one side may stand a bit further off: both stages are tagged
        inner = len(_flips(list(range(BITS)), near))
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 2048):
                some = fp[at:at + 2048]
                point = some[:, None] ^ flips[None, :]
                k = point.shape[1]
                yield pa.RecordBatch.from_pydict({
                    "point": point.reshape(-1).view(np.int64), "fp": np.repeat(some, k).view(np.int64),
                    "inner": np.tile(np.arange(k) < inner, len(some))})

    points = crowded.mapInArrow(enumerate_, "point bigint, fp bigint, inner boolean")
    centre = points.where("inner").groupBy("point").agg(F.min("fp").alias("c"), F.count("*").alias("n"))
    if near == far:  # any two that meet at a point are within the distance
        met_points = (points.join(centre.where("n > 1"), "point").where("fp <> c")
                      .select(F.least("fp", "c").alias("a"), F.greatest("fp", "c").alias("b")))
    else:  # an outer one is within the distance of every inner one at the point
        met_points = (points.join(centre, "point").where("fp <> c")
                      .select(F.least("fp", "c").alias("a"), F.greatest("fp", "c").alias("b")))
    return met.unionAll(met_points).distinct()


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 2, parts: int = 3, most: int = 64,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id that links reach, the document's own included.
    """
    prints = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), distance, parts, most))
    rooted = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return (prints.join(named, "fp")
            .select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
