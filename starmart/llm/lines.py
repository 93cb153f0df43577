"""Line deduplication by a suffix array over line-id sequences (operator 4).

Only DataFrame operations.  A document is the sequence of its non-blank lines
(blanks, tabs and carriage returns at the ends don't count).

* Prefix doubling: the rank of a suffix by its first line is the number of lines with a smaller id; its
  rank by its first 2h lines follows from the ranks by h lines of itself and of the suffix
  h lines on.  Within a group of equal rank, suffixes move up by the number of members
  whose second rank is smaller (a document's end ranks lowest).  Suffixes alone in
  their group are settled and leave the work; rounds go on until none is left.
* LCP intervals: the suffixes that share their first ``min_lines`` lines form an interval of the suffix
  array, known by the ranks of two overlapping stretches of 2^k lines.  Its earliest
  member (by document and line) is the original, the others are later copies.
* The length of a repeat is the longest common prefix with the original, put together from the
  doubling's ranks, largest stretch first.  Only the starts of repeats are measured: a copy whose line before
  is a copy of the line before the original belongs to a repeat already begun.
* Every line of a later copy is deleted.

Ranks are sums over range buckets at several levels, groups are aggregated before
they are ordered, and no document, line or group is gathered in one task.

Defined results: null, empty and blank texts have no lines and keep their text; blank lines are never
deleted; documents come in the order of (doc_id, hash of the text), null ids
first; repeated rows are copies like any others; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import assign_dense_key
from .common import hash_bucket, materialise, running_totals, spread_bits

#: rows of one window group, about
GROUP = 1 << 12
ENDS = " \t\r"


def sequences(docs: DataFrame) -> DataFrame:
    """d (number of the document), doc_id, lines: array of (no, h1, h2, chars); written once."""
    numbered = F.transform(F.split("text", "\n"), lambda x, i: F.struct(
        i.alias("no"), F.btrim(x, F.lit(ENDS)).alias("line")))
    full = F.filter(numbered, lambda s: s["line"] != "")
    hashed = F.transform(full, lambda s: F.struct(
        s["no"].alias("no"), F.xxhash64(s["line"]).alias("h1"), F.hash(s["line"]).alias("h2"),
        F.length(s["line"]).alias("chars")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(hashed, F.array()).alias("lines"))
    return materialise(assign_dense_key(rows, ["doc_id", "h"], "d").drop("h"), "lines")


def _groups(ranked: DataFrame) -> DataFrame:
    """Members of groups of two and more."""
    shared = ranked.groupBy("rank").count().where("count > 1").select("rank")
    return ranked.join(shared, "rank", "left_semi")


def _first_ranks(lines: DataFrame) -> DataFrame:
    """(d, pos, n, rank): rank by the first line, the number of lines with a smaller id."""
    ids = lines.groupBy("h1", "h2").count()
    bits = spread_bits(ids.count(), GROUP)
    # the order of ids is that of the unsigned hash
    ids = ids.withColumn("_b", hash_bucket(F.col("h1"), bits)).withColumn("_o", F.shiftrightunsigned("h1", 1))
    ranks = running_totals(ids, [], "_b", ["_o", "h1", "h2"], "count", "rank", levels=2)
    return lines.join(ranks.select("h1", "h2", "rank"), ["h1", "h2"]).select("d", "pos", "n", "rank")


def rank_levels(lines: DataFrame) -> list[DataFrame]:
    """[(d, pos, n, rank)] by the first 1, 2, 4 ... lines, of the suffixes that long whose
    stretch occurs again; doubling ends when no suffix shares its rank with another."""
    ranks = materialise(_first_ranks(lines), "ranks")
    active = materialise(_groups(ranks), "rank-level")
    levels, h = [], 1
    while not active.isEmpty():
        levels.append(active)
        ahead = ranks.select("d", (F.col("pos") - h).alias("pos"), F.col("rank").alias("second"))
        pairs = active.join(ahead, ["d", "pos"], "left").withColumn("second", F.coalesce("second", F.lit(-1)))
        pairs = materialise(pairs, "pairs")
        kinds = pairs.groupBy("rank", "second").count().withColumn("_b", F.shiftright("second", 16))
        moved = running_totals(kinds, ["rank"], "_b", ["second"], "count", "up")
        moved = moved.select("rank", "second", (F.col("rank") + F.col("up")).alias("moved"))
        refined = materialise(pairs.join(moved, ["rank", "second"])
                              .select("d", "pos", "n", F.col("moved").alias("rank")), "refined")
        ranks = materialise(ranks.join(refined.select("d", "pos"), ["d", "pos"], "left_anti").unionByName(refined),
                            "ranks")
        h *= 2
        # shorter suffixes are compared to their end: what still ties is equal for good
        active = materialise(_groups(refined).where(F.col("pos") + h <= F.col("n")), "rank-level")
    return levels


def _at(level: DataFrame, side: str) -> DataFrame:
    return level.select(F.col("d").alias(f"_{side}d"), F.col("pos").alias(f"_{side}p"),
                        F.col("rank").alias(f"_{side}r"))


def repeats(levels: list[DataFrame], min_lines: int) -> DataFrame:
    """d, pos, run, src_d, src_pos: the starts of later copies, their length and original."""
    k = min_lines.bit_length() - 1
    level, shift = levels[k], min_lines - (1 << k)
    second = level.select("d", (F.col("pos") - shift).alias("pos"), F.col("rank").alias("rank2"))
    deep = materialise(level.join(second, ["d", "pos"]), "intervals")
    origin = deep.groupBy("rank", "rank2").agg(F.min(F.struct("d", "pos")).alias("first"))
    copies = materialise(
        deep.join(origin, ["rank", "rank2"]).where(F.struct("d", "pos") != F.col("first"))
        .select("d", "pos", F.col("first.d").alias("src_d"), F.col("first.pos").alias("src_pos")), "copies")
    begun = copies.select("d", (F.col("pos") + 1).alias("pos"), "src_d", (F.col("src_pos") + 1).alias("src_pos"))
    found = copies.join(begun, ["d", "pos", "src_d", "src_pos"], "left_anti").withColumn("run", F.lit(0).cast("long"))
    for u in reversed(range(len(levels))):
        here, there = _at(levels[u], "a"), _at(levels[u], "b")
        found = (found.join(here, (F.col("d") == F.col("_ad")) & (F.col("pos") + F.col("run") == F.col("_ap")), "left")
                 .join(there, (F.col("src_d") == F.col("_bd")) & (F.col("src_pos") + F.col("run") == F.col("_bp")), "left")
                 .withColumn("run", F.col("run") + F.when(F.col("_ar") == F.col("_br"), F.lit(1 << u)).otherwise(0))
                 .select("d", "pos", "src_d", "src_pos", "run"))
        found = materialise(found, "repeats")
    return found


def repeated_lines(docs: DataFrame, min_lines: int = 1) -> tuple[DataFrame, DataFrame]:
    """(sequences, repeats): repeats hold d, pos, run, src_d, src_pos; positions count non-blank lines."""
    made = sequences(docs)
    lines = made.select("d", F.size("lines").cast("long").alias("n"), F.posexplode("lines").alias("pos", "line"))
    lines = lines.select("d", F.col("pos").cast("long").alias("pos"), "n", "line.h1", "line.h2")
    levels = rank_levels(lines)
    if len(levels) <= min_lines.bit_length() - 1:  # nothing occurs again at that length
        none = "d bigint, pos bigint, src_d bigint, src_pos bigint, run bigint"
        return made, docs.sparkSession.createDataFrame([], none)
    return made, repeats(levels, min_lines)


def deduplicated_lines(docs: DataFrame, min_lines: int = 1) -> DataFrame:
    """doc_id, lines, deleted_lines, kept_chars, deleted (line numbers) for every document."""
    made, found = repeated_lines(docs, min_lines)
    # runs of a document may overlap: one entry per line
    gone = (found.select("d", F.explode(F.expr("sequence(pos, pos + run - 1)")).alias("pos")).distinct()
            .groupBy("d").agg(F.array_sort(F.collect_list(F.col("pos").cast("int"))).alias("at")))
    both = made.withColumnRenamed("lines", "all").join(gone, "d", "left").withColumn("at", F.coalesce("at", F.array().cast("array<int>")))
    left = F.aggregate("all", F.lit(0).cast("long"), lambda acc, x: acc + x["chars"]) - F.aggregate(
        "at", F.lit(0).cast("long"), lambda acc, i: acc + F.get("all", i)["chars"])
    return both.select("doc_id", F.size("all").cast("long").alias("lines"),
                       F.size("at").cast("long").alias("deleted_lines"), left.alias("kept_chars"),
                       F.transform("at", lambda i: F.get("all", i)["no"]).alias("deleted"))


def line_dedup_report(docs: DataFrame, min_lines: int = 1) -> DataFrame:
    """doc_id, lines, deleted_lines, kept_chars, first_deleted, last_deleted (line numbers from 0)."""
    return deduplicated_lines(docs, min_lines).select(
        "doc_id", "lines", "deleted_lines", "kept_chars", F.get("deleted", F.lit(0)).alias("first_deleted"),
        F.get("deleted", F.size("deleted") - 1).alias("last_deleted"))


def without_repeats(docs: DataFrame, min_lines: int = 1) -> DataFrame:
    """doc_id, text without the deleted lines, for every document (rows alike in both get the shortest text)."""
    cut = deduplicated_lines(docs, min_lines).where("deleted_lines > 0").select("doc_id", "deleted")
    keyed = docs.select("doc_id", "text").join(cut, "doc_id")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("deleted", i))
    changed = keyed.select("doc_id", F.array_join(kept, "\n").alias("text"))
    return changed.unionAll(docs.select("doc_id", "text").join(cut, "doc_id", "left_anti"))


def line_dedup_sql(min_lines: int = 1) -> str:
    """DuckDB SQL of ``line_dedup_report``: windows of ``min_lines`` lines that stood somewhere before."""
    following = ", ".join(f"LEAD(line, {i}) OVER q" for i in range(1, min_lines)) or "NULL"
    return f"""
WITH numbered AS (
  SELECT doc_id, ROW_NUMBER() OVER (ORDER BY doc_id NULLS FIRST, text) AS d, string_split(text, chr(10)) AS parts
  FROM documents),
listed AS (
  SELECT d, unnest(parts) AS line, unnest(range(len(parts))) AS no FROM numbered),
lines AS (
  SELECT d, no, trim(line, ' ' || chr(9) || chr(13)) AS line,
         ROW_NUMBER() OVER (PARTITION BY d ORDER BY no) AS pos, COUNT(*) OVER (PARTITION BY d) AS n
  FROM listed WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
starts AS (
  SELECT d, pos, n, [line, {following}] AS run FROM lines WINDOW q AS (PARTITION BY d ORDER BY pos)),
again AS (
  SELECT d, pos FROM starts WHERE pos + {min_lines} - 1 <= n
  QUALIFY ROW_NUMBER() OVER (PARTITION BY run ORDER BY d, pos) > 1),
gone AS (
  SELECT DISTINCT d, pos + step AS pos FROM again, range({min_lines}) AS steps(step)),
sums AS (
  SELECT l.d, COUNT(*) AS lines, COUNT(g.pos) AS deleted_lines,
         SUM(CASE WHEN g.pos IS NULL THEN length(line) ELSE 0 END) AS kept_chars,
         MIN(CASE WHEN g.pos IS NOT NULL THEN no END) AS first_deleted,
         MAX(CASE WHEN g.pos IS NOT NULL THEN no END) AS last_deleted
  FROM lines l LEFT JOIN gone g ON l.d = g.d AND l.pos = g.pos GROUP BY l.d)
SELECT n.doc_id, CAST(COALESCE(lines, 0) AS BIGINT) AS lines, CAST(COALESCE(deleted_lines, 0) AS BIGINT) AS deleted_lines,
       CAST(COALESCE(kept_chars, 0) AS BIGINT) AS kept_chars, CAST(first_deleted AS INT) AS first_deleted,
       CAST(last_deleted AS INT) AS last_deleted
FROM numbered n LEFT JOIN sums s ON n.d = s.d"""
