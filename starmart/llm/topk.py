"""Exact top-k inner products by three-phase uniform thresholds (operator 9).

The components are cut into ``lists`` stretches.  For a query, each stretch is a score
list over all candidates (the partial inner products), and a score is the sum of a
candidate's entries in all lists.  Lists are held in blocks of candidates.

1. Every block of every list sends its k highest entries for each query, and its lowest.  The 4 k candidates of a
   query with the highest sums of these are completed from the other lists, so requests don't grow with the number
   of blocks; the k-th highest complete score t is a safe cutoff, as the k-th best score is at least t.
2. With f_i the lowest entry of list i, a candidate scoring t or more has an entry of
   f_i + (t - sum f) / lists or more in some list.  This uniform cutoff goes back with the
   queries, and every block sends all entries from it on.
3. A candidate seen in some lists is bounded by its entries and the cutoffs of
   the others.  Those that can still reach t are resolved exactly from the lists that
   miss, and ranked.

Components x count as floor(256 x).  Equal vectors form one class: only its
k + 1 smallest ids can appear in a result (one may be the query's own), so a vector that
fills a third of the table is searched once.  Work is dealt out in cells (list, query block,
candidate block) of bounded size; nothing is broadcast or collected but counts.

Defined results: rows with a null id, or vectors null or with null or non-finite
components, take no part; shorter vectors count as padded with zeros; repeated rows count once;
a query never lists its own id; fewer candidates than k are all listed; an
empty table gives an empty result; extra columns are ignored.  Scores are exact
while every sum stays below 2^53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import group_runs, materialise, partitions

SALTS = 256
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 4096
_CELL = "list int, qb bigint, cb bigint, kind int, id bigint, other bigint, vec array<bigint>, cut bigint"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec array<bigint>) of the rows that take part."""
    good = F.forall(vec_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & good)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(vec_col, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("vec")))


def _smallest(ids: str, n: int):
    return F.slice(F.array_sort(F.array_distinct(ids)), 1, n)


def classes(rows: DataFrame, every: int, keep: int) -> tuple[DataFrame, DataFrame, int]:
    """Classes (cls: smallest id, vec, ids: smallest ids), queries (query_id, cls) and the dimension.

    Two steps keep a very common vector out of a single task.
    """
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    padded = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec"))))
    part = (padded.groupBy("vec", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
            .agg(_smallest(F.collect_set("id"), keep).alias("ids")))
    merged = part.groupBy("vec").agg(_smallest(F.flatten(F.collect_list("ids")), keep).alias("ids"))
    made = materialise(merged.select(F.element_at("ids", 1).alias("cls"), "vec", "ids"), "classes")
    asked = padded.where(F.col("id") % every == 0).distinct().join(made.select("cls", "vec"), "vec")
    return made, materialise(asked.select(F.col("id").alias("query_id"), "cls"), "asked"), width


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _numbers(n: int):
    return F.explode(F.expr(f"sequence(0L, {n - 1}L)"))


class Grid:
    """Score lists in cells; ``run`` sends queries (and requests) through them."""

    def __init__(self, made: DataFrame, queries: DataFrame, width: int, lists: int):
        self.spark = made.sparkSession
        self.lists = max(1, min(lists, width))
        self.edges = [width * i // self.lists for i in range(self.lists + 1)]
        n, q = made.count(), queries.count()
        self.cbs, self.qbs = 1 + n // CANDIDATE_BLOCK, 1 + q // QUERY_BLOCK
        self.made, self.queries = made, queries

    def block(self, col: str, blocks: int):
        return F.pmod(F.xxhash64(col), F.lit(blocks))

    def _sliced(self, rows: DataFrame, *cols) -> DataFrame:
        pieces = F.array(*[F.slice("vec", a + 1, b - a) for a, b in zip(self.edges[:-1], self.edges[1:])])
        return rows.select(F.posexplode(pieces).alias("list", "vec"), *cols)

    def run(self, fn, schema: str, cuts: DataFrame | None = None, requests: DataFrame | None = None) -> DataFrame:
        """fn(query ids, cuts, Q, candidate ids, C, requests) -> dict of columns, for every cell.

        ``cuts``: (id, list, cut); ``requests``: (list, id, other).
        """
        ask = self._sliced(self.queries, F.col("cls").alias("id"))
        if cuts is not None:
            ask = ask.join(cuts, ["id", "list"])
        else:
            ask = ask.withColumn("cut", F.lit(None).cast("long"))
        null = F.lit(None).cast("long")
        ask = ask.select("list", self.block("id", self.qbs).alias("qb"),
                         _numbers(self.cbs).alias("cb"),
                         F.lit(0).alias("kind"), "id", null.alias("other"), "vec", "cut")
        held = self._sliced(self.made, F.col("cls").alias("id")).select(
            "list", _numbers(self.qbs).alias("qb"),
            self.block("id", self.cbs).alias("cb"), F.lit(1).alias("kind"), "id", null.alias("other"), "vec",
            null.alias("cut"))
        rows = ask.unionAll(held)
        if requests is not None:
            rows = rows.unionAll(requests.select(
                "list", self.block("id", self.qbs).alias("qb"), self.block("other", self.cbs).alias("cb"),
                F.lit(2).alias("kind"), "id", "other", F.lit(None).cast("array<bigint>"), null))
        cells = self.lists * self.cbs * self.qbs
        rows = (rows.repartition(min(cells, 4 * partitions(self.spark)), "list", "qb", "cb")
                .sortWithinPartitions("list", "qb", "cb", "kind", "id", "other"))

        def work(batches):
            for key, table in group_runs(batches, 3):
                kind = table["kind"].to_numpy()
                a, b = np.searchsorted(kind, [1, 2])
                if not a or a == b:
                    continue
                ids = table["id"].to_numpy()
                q, c, r = table.slice(0, a), table.slice(a, b - a), table.slice(b)
                out = fn(key[0], ids[:a], q["cut"], _matrix(q["vec"], a), ids[a:b], _matrix(c["vec"], b - a),
                         (ids[b:], r["other"].to_numpy()))
                yield pa.RecordBatch.from_pydict(out)

        return rows.mapInArrow(work, schema)


def _highest(k: int):
    def fn(which, q_ids, _, q, c_ids, c, __):
        scores = q @ c.T
        take = min(k, scores.shape[1])
        at = np.argpartition(-scores, take - 1, axis=1)[:, :take]
        n = len(q_ids)
        part = np.take_along_axis(scores, at, 1).astype(np.int64)
        return {"list": np.full(n * take, which, np.int32), "id": np.repeat(q_ids, take),
                "other": c_ids[at].reshape(-1), "part": part.reshape(-1),
                "low": np.repeat(scores.min(axis=1).astype(np.int64), take)}
    return fn


def _from_cut(which, q_ids, cuts, q, c_ids, c, _):
    scores = q @ c.T
    row, col = np.nonzero(scores >= cuts.to_numpy()[:, None])
    return {"list": np.full(len(row), which, np.int32), "id": q_ids[row], "other": c_ids[col],
            "part": scores[row, col].astype(np.int64)}


def _asked(which, q_ids, _, q, c_ids, c, wanted):
    ids, others = wanted
    row, col = np.searchsorted(q_ids, ids), np.searchsorted(c_ids, others)
    part = np.empty(len(ids), np.int64)
    for at in range(0, len(ids), 1 << 15):
        some = slice(at, at + (1 << 15))
        part[some] = np.einsum("ij,ij->i", q[row[some]], c[col[some]])
    return {"list": np.full(len(ids), which, np.int32), "id": ids, "other": others, "part": part}


_ENTRY = "list int, id bigint, other bigint, part bigint"


def _complete(grid: Grid, seen: DataFrame, label: str) -> DataFrame:
    """(id, other, score) from seen pairs (id, other, part, lists: those seen)."""
    everywhere = F.array(*[F.lit(i) for i in range(grid.lists)])
    missing = seen.select(F.explode(F.array_except(everywhere, F.col("lists"))).alias("list"), "id", "other")
    rest = grid.run(_asked, _ENTRY, requests=missing)
    both = seen.select("id", "other", "part").unionAll(rest.select("id", "other", "part"))
    return materialise(both.groupBy("id", "other").agg(F.sum("part").alias("score")), label)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, lists: int = 2, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query (id divisible by ``every``)."""
    keep = k + 1
    made, asked, width = classes(quantised(vectors, id_col, vec_col), every, keep)
    queries = made.join(asked.select("cls").distinct(), "cls", "left_semi")
    grid = Grid(made, queries, width, lists)

    first = materialise(grid.run(_highest(keep), _ENTRY + ", low bigint"), "highest")
    low = first.groupBy("id", "list").agg(F.min("low").alias("low"))
    pairs = first.groupBy("id", "other").agg(F.sum("part").alias("part"), F.collect_set("list").alias("lists"))
    # any complete scores make a safe cutoff: those of the pairs with the highest sums so far
    leading = Window.partitionBy("id").orderBy(F.desc("part"), "other")
    pairs = pairs.withColumn("n", F.row_number().over(leading)).where(F.col("n") <= 4 * keep).drop("n")
    known = _complete(grid, pairs, "known")
    place = Window.partitionBy("id").orderBy(F.desc("score"), "other")
    safe = (known.withColumn("n", F.row_number().over(place)).where(F.col("n") == keep)
            .select("id", F.col("score").alias("t")))
    lows = low.groupBy("id").agg(F.sum("low").alias("lows"))
    share = F.floor((F.col("t") - F.col("lows")) / grid.lists).cast("long")
    cuts = materialise(low.join(lows, "id").join(safe, "id", "left")  # no cutoff: all entries
                       .select("id", "list", (F.col("low") + F.coalesce(share, F.lit(0))).alias("cut"), "t"), "cuts")

    entries = grid.run(_from_cut, _ENTRY, cuts=cuts.select("id", "list", "cut"))
    seen = entries.groupBy("id", "other").agg(F.sum("part").alias("part"), F.collect_set("list").alias("lists"))
    bounds = cuts.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("list", "cut"))).alias("cut"),
                                    F.first("t").alias("t"))
    most = F.col("part") + F.aggregate(
        F.map_entries("cut"), F.lit(0).cast("long"),
        lambda acc, e: acc + F.when(F.array_contains("lists", e["key"]), F.lit(0).cast("long")).otherwise(e["value"]))
    able = materialise(seen.join(bounds, "id").where(F.col("t").isNull() | (most >= F.col("t")))
                       .select("id", "other", "part", "lists"), "able")
    scores = _complete(grid, able, "scores")

    best = scores.withColumn("n", F.row_number().over(place)).where(F.col("n") <= keep)
    listed = (best.join(made.select(F.col("cls").alias("other"), "ids"), "other")
              .groupBy("id").agg(F.array_sort(F.flatten(F.collect_list(F.transform(
                  "ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("vec_id")))))).alias("all")))
    result = asked.join(listed, asked["cls"] == listed["id"])
    others = F.slice(F.filter("all", lambda e: e["vec_id"] != F.col("query_id")), 1, k)
    return result.select("query_id", F.posexplode(others).alias("at", "e")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"),
        (-F.col("e.minus")).alias("score"))


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(ROW_NUMBER() OVER w AS INT) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY ROW_NUMBER() OVER w <= 5"""
