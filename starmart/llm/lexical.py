"""Ranked lexical search with pair-bound MaxScore (operator 11).

An item's score for a document is the sum of integer impacts of its terms there, each
w * ((10^9 tf) div (1000 tf + 20 m)) with w from the document frequency and m from the document's length.

1. ``term_counts``: one pass over the texts counts the terms that items hold; Spark sums up
   the number of documents and terms and the document frequencies.
2. ``block_index``: blocks of documents with about ``BLOCK`` postings, one row a block: for each term
   the list of documents and impacts and their maximum, and for each pair of terms the
   maximum joint impact over the union of its two lists, and the documents of the intersection with the highest
   joint impacts.  The pairs are those of neighbouring document frequency in an item.
3. First round: every block scores only the documents of the intersection lists of an item (and the best postings of
   single terms) completely.  The k-th best score found anywhere is a safe cutoff.
4. Second round: an item's terms stand in units, pairs or single terms, each bounded by its maximum in
   the block.  As the best document for one term of a pair is seldom the best one for the other, the joint maximum is below
   the sum of the two term maxima, so more units fit under the cutoff than with independent maxima.  Units
   whose bounds together stay below the cutoff bring no new documents; documents from the other lists
   are completed unit by unit as long as their score and the bounds left can reach the cutoff.

Each task keeps the k best of each item over its blocks, and Spark ranks those.  No document at or above the
cutoff is skipped, so the result is exact.  Items are worked off in sets of about ``VOCABULARY`` terms, which travel with
the tasks; nothing else is broadcast, and only the cutoffs of such a set come to the driver.

Defined results: null texts and texts without a term are no documents, and null items find nothing; repeated rows are
documents of their own; rows of one item id count as one item that holds the terms of all; null document ids rank behind
equal scores, null item ids are an item; a text is processed whole, in parts of about 1 MB; fewer documents
than k with a score above 0 are all listed; empty tables give an empty result; extra columns are ignored.
Impacts are exact while they fit 64 bits.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, utf8
from .tokens import parts_of

#: terms of one set of items, about
VOCABULARY = 1 << 16
#: postings of one block of documents, about, and documents at most
BLOCK, BLOCK_DOCS = 1 << 17, 1 << 14
#: entries of an intersection list that are kept: those of the highest joint impact
INTERSECTION = 64

#: ASCII but letters and digits separates terms; A-Z become a-z; other bytes belong to terms
FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a part at a time."""
    for part in parts_of(text.translate(FOLD)):
        yield part.split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term) for the distinct terms of every item, in as many rows."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("item", items.schema[id_col].dataType), T.StructField("term", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for row, text in enumerate(utf8(batch.column(1))):
                terms = sorted({t for part in terms_of(text or b"") for t in part})
                if terms:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([row] * len(terms))), pa.array(terms, pa.binary())], names=["item", "term"])

    return items.select(id_col, text_col).mapInArrow(run, schema).distinct()


def term_counts(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(doc, n, terms, tfs) for documents with a term: how often each term of the vocabulary occurs."""
    def run(batches):
        number = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            at, sizes, terms, tfs = [], [], [], []
            for row, text in enumerate(utf8(batch.column(1))):
                n, found = 0, Counter()
                for part in terms_of(text or b""):
                    n += len(part)
                    found.update(map(number.get, part))
                if n:
                    found.pop(None, None)
                    at.append(row)
                    sizes.append(n)
                    terms.append(list(found.keys()))
                    tfs.append(list(found.values()))
            if at:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                     pa.array(tfs, pa.list_(pa.int64()))], names=["doc", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("doc"), text_col).mapInArrow(
        run, "doc bigint, n bigint, terms array<int>, tfs array<bigint>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """A set of items: terms by number, units (pairs or single terms) and the pairs to index."""

    def __init__(self, names: list, terms: list[list[int]], frequency: dict[int, int]):
        self.names, self.units = names, []
        pairs: dict[tuple[int, int], int] = {}
        for held in terms:
            ordered = sorted((t for t in held if t in frequency), key=lambda t: (frequency[t], t))
            units = []
            for a, b in zip(ordered[::2], ordered[1::2]):
                units.append(pairs.setdefault((min(a, b), max(a, b)), len(pairs)))
            self.units.append((units, ordered[-1:] if len(ordered) % 2 else []))
        self.pairs = list(pairs)


_BLOCK = "docs array<bigint>, terms array<int>, starts array<int>, rows array<int>, impacts array<bigint>, " \
         "best array<bigint>, pair_best array<bigint>, pair_starts array<int>, pair_rows array<int>"


def block_index(counts: DataFrame, weights: list[int], n_docs: int, n_terms: int, pairs: list[tuple[int, int]]) -> DataFrame:
    """One row a block: postings by term with impacts, maxima of terms and pairs, heads of intersection lists."""
    def built(held):
        rows = np.repeat(np.arange(len(held), dtype=np.int32), [len(h[2]) for h in held])
        terms = np.array([t for h in held for t in h[2]], np.int32)
        tfs = np.array([f for h in held for f in h[3]], np.int64)
        lengths = np.array([50 + 50 * n * n_docs // n_terms for _, n, _, _ in held], np.int64)
        weight = np.array(weights, np.int64)
        impacts = weight[terms] * ((10 ** 9 * tfs) // (1000 * tfs + 20 * lengths[rows]))
        order = np.argsort(terms, kind="stable")
        terms, rows, impacts = terms[order], rows[order], impacts[order]
        present, starts = np.unique(terms, return_index=True)
        ends = np.append(starts[1:], len(terms))
        best = np.maximum.reduceat(impacts, starts) if len(starts) else impacts
        place = {t: i for i, t in enumerate(present.tolist())}
        pair_best, heads = np.zeros(len(pairs), np.int64), []
        for k, (a, b) in enumerate(pairs):
            i, j = place.get(a), place.get(b)
            pair_best[k] = max(best[x] for x in (i, j) if x is not None) if i is not None or j is not None else 0
            if i is None or j is None:
                heads.append(rows[:0])
                continue
            x, y = rows[starts[i]:ends[i]], rows[starts[j]:ends[j]]
            both, p, q = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            joint = impacts[starts[i]:ends[i]][p] + impacts[starts[j]:ends[j]][q]
            if len(joint):
                pair_best[k] = max(pair_best[k], joint.max())
            if len(joint) > INTERSECTION:
                both = both[np.argpartition(-joint, INTERSECTION)[:INTERSECTION]]
            heads.append(both)
        made = {"docs": [d for d, _, _, _ in held], "terms": present, "starts": np.append(starts, len(terms)).astype(np.int32),
                "rows": rows, "impacts": impacts, "best": best, "pair_best": pair_best,
                "pair_starts": np.cumsum([0, *map(len, heads)]).astype(np.int32),
                "pair_rows": np.concatenate([rows[:0], *heads]).astype(np.int32)}
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for (_, v), f in zip(made.items(), out)], schema=out)

    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    out = pa.schema([("docs", longs), ("terms", ints), ("starts", ints), ("rows", ints), ("impacts", longs), ("best", longs),
                     ("pair_best", longs), ("pair_starts", ints), ("pair_rows", ints)])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                held.append(row)
                size += len(row[2])
                if size >= BLOCK or len(held) >= BLOCK_DOCS:
                    yield built(held)
                    held, size = [], 0
        if held:
            yield built(held)

    return counts.where(F.size("terms") > 0).select("doc", "n", "terms", "tfs").mapInArrow(run, _BLOCK)


class Block:
    """A block in memory, with the search in it."""

    def __init__(self, batch: pa.RecordBatch, row: int, items: Items):
        def held(name):
            return batch.column(name)[row].values.to_numpy(zero_copy_only=False)

        # null ids behind all others; positions stand for documents
        ids = batch.column("docs")[row].values
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.docs = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.starts, self.rows, self.impacts = held("starts"), held("rows"), held("impacts")
        self.best, self.pair_best = held("best"), held("pair_best")
        self.pair_starts, self.pair_rows = held("pair_starts"), held("pair_rows")
        self.place = {t: i for i, t in enumerate(held("terms").tolist())}
        self.items = items

    def units(self, item: int) -> list[tuple[int, list[int], int]]:
        """(bound, term places, pair or -1) of an item's units that occur here, highest bound first."""
        pairs, single = self.items.units[item]
        found = []
        for k in pairs:
            places = [self.place[t] for t in self.items.pairs[k] if t in self.place]
            if places:
                found.append((int(self.pair_best[k]), places, k))
        for t in single:
            if t in self.place:
                found.append((int(self.best[self.place[t]]), [self.place[t]], -1))
        return sorted(found, key=lambda u: -u[0])

    def postings(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[place], self.starts[place + 1])
        return self.rows[at], self.impacts[at]

    def add(self, score: np.ndarray, candidates: np.ndarray, places: list[int]) -> None:
        """Add the impacts of terms to the scores of the candidates, by the shorter way."""
        for place in places:
            rows, impacts = self.postings(place)
            if len(candidates) * 16 < len(rows):
                at = np.searchsorted(rows, candidates)
                at[at == len(rows)] = 0
                hit = rows[at] == candidates
                score[candidates[hit]] += impacts[at[hit]]
            else:
                score[rows] += impacts

    def seeds(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """Complete scores of the documents in the item's intersection lists and of its best single postings."""
        units = self.units(item)
        heads = [self.pair_rows[self.pair_starts[k]:self.pair_starts[k + 1]] for _, _, k in units if k >= 0]
        for _, places, k in units:
            if k < 0 or self.pair_starts[k] == self.pair_starts[k + 1]:
                for place in places:
                    rows, impacts = self.postings(place)
                    most = min(len(rows), INTERSECTION)
                    heads.append(rows[np.argpartition(-impacts, most - 1)[:most]])
        if not heads:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        rows = np.unique(np.concatenate(heads))
        score = np.zeros(len(self.docs), np.int64)
        self.add(score, rows, [p for _, places, _ in units for p in places])
        return rows, score[rows]

    def search(self, item: int, cutoff: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all documents with a score of at least ``cutoff`` (over 0)."""
        units = self.units(item)
        left = [0] * (len(units) + 1)  # bound of the units from here on
        for i in range(len(units) - 1, -1, -1):
            left[i] = left[i + 1] + units[i][0]
        if left[0] < cutoff:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        score, seen, i = np.zeros(len(self.docs), np.int64), [], 0
        while i < len(units) and left[i] >= cutoff:  # lists that can bring documents
            for place in units[i][1]:
                rows, impacts = self.postings(place)
                score[rows] += impacts
                seen.append(rows)
            i += 1
        mark = np.zeros(len(self.docs), bool)
        for rows in seen:
            mark[rows] = True
        candidates = np.flatnonzero(mark)
        while i < len(units) and len(candidates):
            candidates = candidates[score[candidates] + left[i] >= cutoff]
            self.add(score, candidates, units[i][1])
            i += 1
        candidates = candidates[score[candidates] >= cutoff]
        return candidates, score[candidates]


def _search(items: Items, k: int, cutoffs: list[int], find) -> object:
    """The k best (item, doc, score) of each item over the blocks of a task."""
    def run(batches):
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * len(items.names)
        floor = list(cutoffs)
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row, items)
                for item in range(len(items.names)):
                    rows, scores = find(block, item, floor[item])
                    some = scores > 0
                    if not some.any():
                        continue
                    rows, scores = rows[some], scores[some]
                    found = (scores, block.null[rows], block.docs[rows])
                    if kept[item] is not None:
                        found = tuple(np.concatenate(x) for x in zip(kept[item], found))
                    order = np.lexsort((found[2], found[1], -found[0]))[:k]
                    kept[item] = tuple(x[order] for x in found)
                    if len(order) == k:
                        floor[item] = max(floor[item], int(kept[item][0][-1]))
        for item, found in enumerate(kept):
            if found is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found[0]), item, np.int32)), pa.array(found[2], pa.int64(), mask=found[1]),
                     pa.array(found[0], pa.int64())], names=["item", "doc", "score"])

    return run


_FOUND = "item int, doc bigint, score bigint"


def search_items(docs: DataFrame, names: list, held: list[list[bytes]], k: int, id_col: str, text_col: str) -> DataFrame:
    """(item: place in ``names``, doc, score): the k best documents of each item, and some more."""
    vocabulary = sorted({t for terms in held for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    counts = materialise(term_counts(docs, vocabulary, id_col, text_col), "terms")
    n_docs, n_terms = counts.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = dict(map(tuple, counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))
    weights = [term_weight(n_docs, frequency.get(i, 0)) for i in range(len(vocabulary))]
    items = Items(names, [[number[t] for t in terms] for terms in held], frequency)
    index = materialise(block_index(counts, weights, n_docs, n_terms, items.pairs), "postings")
    none = [1] * len(names)
    first = index.mapInArrow(_search(items, k, none, lambda block, item, _: block.seeds(item)), _FOUND)
    place = Window.partitionBy("item").orderBy(F.desc("score"))
    safe = dict(map(tuple, first.withColumn("n", F.row_number().over(place)).where(F.col("n") == k)
                    .select("item", "score").collect()))
    cutoffs = [safe.get(i, 1) for i in range(len(names))]
    return index.mapInArrow(_search(items, k, cutoffs, lambda block, item, floor: block.search(item, floor)), _FOUND)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", item_id: str = "item_id",
                     text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest score above 0 for every item."""
    terms = materialise(item_terms(items, item_id, text_col), "items")
    name = terms.schema["item"].dataType
    sets = 1 + terms.count() // VOCABULARY
    spark, result = docs.sparkSession, None
    terms = terms.withColumn("set", F.pmod(F.xxhash64("item"), F.lit(sets)))
    for s in range(sets):
        rows = terms.where(F.col("set") == s).groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        if not rows:
            continue
        names, held = [r["item"] for r in rows], [[bytes(t) for t in r["terms"]] for r in rows]
        found = search_items(docs, names, held, k, doc_id, text_col)
        labels = spark.createDataFrame(list(enumerate(names)), f"item int, {item_id} {name.simpleString()}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        ranked = (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(labels, "item")
                  .select(item_id, F.col("rank").cast("int").alias("rank"), F.col("doc").alias(doc_id), "score"))
        result = ranked if result is None else result.unionAll(ranked)
    if result is None:
        return spark.createDataFrame([], f"{item_id} {name.simpleString()}, rank int, {doc_id} bigint, score bigint")
    return result


RANKED_SQL = """
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS ws
  FROM documents WHERE text IS NOT NULL),
sized AS (SELECT d, doc_id, ws, CAST(len(ws) AS BIGINT) AS n FROM words WHERE len(ws) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM sized),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM benchmark),
tf AS (SELECT d, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, doc_id, n, unnest(ws) AS term FROM sized)
       WHERE term IN (SELECT term FROM wanted) GROUP BY d, doc_id, n, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM tf, total GROUP BY term),
impact AS (SELECT term, d, doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))) AS part
           FROM tf JOIN weight USING (term), total),
scored AS (SELECT item_id, d, doc_id, CAST(sum(part) AS BIGINT) AS score
           FROM wanted JOIN impact USING (term) GROUP BY item_id, d, doc_id HAVING sum(part) > 0)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER w <= 50"""
