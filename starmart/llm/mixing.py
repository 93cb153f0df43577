"""Mixing sources to target weights by a low-discrepancy schedule (operator 3).

Only DataFrame operations.  The mix is a sequence of slots, each of which takes one
block of ``block_words`` words from one source:

* A source's share is its weight; a target stops at ``most`` times the source's
  words and the excess is shared out again by weight.  Its number of slots is its
  target in blocks, rounded up; the last block is cut so that the target is met
  to the word.
* Slot i sits at the base-2 van der Corput point of i, the bit reversal of i over
  2^m >= N slots.  The points are mapped through the cumulative slot counts; those of
  the first 2^m indices are all different and fill the cumulative range, so every
  source gets exactly its number of slots, evenly spread.  As bit reversal undoes
  itself, each source makes its slots from its own stretch of the cumulative range;
  points above N are idle and their indices are not used.
* Slots are ranked per source.  Each source's documents are shuffled (by MD5 of
  the id), laid end to end and cut into blocks of equal size, again and again if the target
  exceeds the source; the k-th slot takes the k-th block.

All ranks and running sums have two levels (inside a bucket, over buckets), so
no source is gathered in one task.

Defined results: null, empty and wordless texts have size 0 and are never
taken; a null source is a source of its own and comes last; repeated rows and
repeated ids take their own places; without any words all targets are 0; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import assign_dense_key
from .common import materialise, partitions, running_totals, spread_bits, word_count

#: rows of one window group in the two-level sums, about
GROUP = 1 << 12


def source_targets(sized: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size, rank, weight, target: one row per source.

    Weights repeat ``cycle`` along the sources in code point order, null last.
    Sharing out the excess repeats until no target stands above its limit; each
    round is one sum over the sources table.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = sums.withColumn("_null", F.col("source").isNull())
    ranked = assign_dense_key(sums, ["_null", "source"], "rank").withColumn("rank", F.col("rank") - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.col("rank") % len(cycle) + 1).cast("int"))
    ranked = materialise(ranked.drop("_null").withColumn("weight", weight.cast("long")), "sources")
    limit = F.col("source_size") * most
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # level: what one unit of weight gets, as a fraction left / weights
    left, weights = total, ranked.agg(F.sum("weight")).first()[0] or 0
    while weights:
        at_limit = F.col("source_size") * most * F.lit(weights) <= F.lit(left) * F.col("weight")
        held, free = ranked.agg(F.sum(F.when(at_limit, limit)), F.sum(F.when(~at_limit, F.col("weight")))).first()
        now = total - (held or 0), free or 0
        if now == (left, weights):
            break
        left, weights = now
    if weights:
        share = F.lit(float(left)) * F.col("weight") / F.lit(float(weights))
        target = F.least(limit.cast("double"), share)
    else:
        target = limit.cast("double")
    return ranked.withColumn("target", target)


def _reversed_bits(x: Column, bits: int) -> Column:
    if not bits:
        return F.lit(0).cast("long")
    return F.conv(F.reverse(F.lpad(F.bin(x), bits, "0")), 2, 10).cast("long")


def slots(targets: DataFrame, block_words: int) -> DataFrame:
    """source, block, slot: the k-th slot of a source takes its k-th block."""
    spark = targets.sparkSession
    counted = targets.select("source", "rank", F.ceil(F.col("take") / block_words).cast("long").alias("slots"))
    counted = running_totals(counted.withColumn("_b", F.shiftright("rank", 12)), [], "_b", ["rank"], "slots", "start")
    total = counted.agg(F.sum("slots")).first()[0] or 0
    bits = max(0, total - 1).bit_length()
    chunks = (counted.where("slots > 0")
              .select("source", "start", "slots",
                      F.explode(F.expr(f"sequence(0L, slots - 1, {GROUP}L)")).alias("first"))
              .repartition(partitions(spark), "source", "first"))
    made = chunks.select("source", F.explode(F.expr(
        f"sequence(start + first, start + least(first + {GROUP}L, slots) - 1)")).alias("point"))
    made = made.select("source", _reversed_bits(F.col("point"), bits).alias("slot"), F.lit(1).alias("one"))
    made = made.withColumn("_b", F.shiftright("slot", GROUP.bit_length() - 1))
    return running_totals(made, ["source"], "_b", ["slot"], "one", "block").select("source", "block", "slot")


def blocks(sized: DataFrame, targets: DataFrame, block_words: int, seed: int) -> DataFrame:
    """One row per document and block: id, source, size, start, block, word_from, words.

    Documents that no block touches have one row with a null block.
    """
    rows = sized.count()
    bits = spread_bits(rows, GROUP)
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    line = sized.withColumn("_h", order)
    line = line.withColumn("_b", F.shiftright(F.conv(F.substring("_h", 1, 15), 16, 10).cast("long"), 60 - bits)
                           if bits else F.lit(0).cast("long"))
    line = running_totals(line, ["source"], "_b", ["_h", "id", "size"], "size", "start").drop("_h", "_b")
    meant = targets.select(F.col("source").alias("_s"), "source_size", "target", "take")
    line = line.join(meant, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    turns = F.transform(
        F.expr("sequence(0L, greatest(0L, (take - start - 1) div source_size))"),
        lambda turn: F.struct((F.col("start") + turn * F.col("source_size")).alias("at"),
                              F.least(F.col("start") + turn * F.col("source_size") + F.col("size"),
                                      F.col("take")).alias("end")))
    used = (line.where("size > 0 and start < take").select("*", F.inline(turns))
            .select("*", F.explode(F.expr(f"sequence(at div {block_words}L, (end - 1) div {block_words}L)"))
                    .alias("block")))
    first = F.greatest(F.col("at"), F.col("block") * block_words)
    last = F.least(F.col("end"), (F.col("block") + 1) * block_words)
    names = ["id", "source", "size", "start", "source_size", "target"]
    used = used.select(*names, "block", (first - F.col("at")).alias("word_from"), (last - first).alias("words"))
    idle = line.where("not (size > 0 and start < take)").select(
        *names, F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("word_from"),
        F.lit(0).cast("long").alias("words"))
    return used, idle


def mix(sized: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3, block_words: int = 256,
        seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(schedule, idle) of rows (id, source, size): what each slot takes, and what no slot takes.

    schedule: slot, block, id, source, size, start, word_from, words (and the
    source's size and target); in the order of ``slot``, ``start`` it is the mix itself.
    """
    targets = source_targets(sized, cycle, most)
    targets = targets.withColumn("take", F.floor(F.col("target") + 0.5).cast("long"))
    used, idle = blocks(sized, targets, block_words, seed)
    made = slots(targets, block_words).select(F.col("source").alias("_s"), F.col("block").alias("_k"), "slot")
    schedule = used.join(made, (F.col("block") == F.col("_k")) & F.col("source").eqNullSafe(F.col("_s")))
    return schedule.drop("_s", "_k"), idle


def sized_documents(docs: DataFrame, id_col: Column | None = None) -> DataFrame:
    """(id, source, size in words) of every document, written once: later steps read no text."""
    key = F.col("doc_id") if id_col is None else id_col
    return materialise(docs.select(key.alias("id"), F.col("source").cast("string").alias("source"),
                                   word_count(F.col("text")).alias("size")), "sizes")


def words_taken(sized: DataFrame, **options) -> DataFrame:
    """id, source, size, source_size, target, taken, first_slot, slots: one row per row of ``sized``.

    ``first_slot`` is where in the mix the row appears first, ``slots`` how many slots hold words of it.
    """
    schedule, idle = mix(sized, **options)
    names = ["id", "source", "size", "source_size", "target"]
    # a slot holds words of a row twice where the row's end and its next turn meet in one block
    each = schedule.groupBy(*names, "start", "slot").agg(F.sum("words").alias("words"))
    taken = each.groupBy(*names, "start").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"),
                                              F.count("slot").alias("slots")).drop("start")
    return taken.unionByName(idle.select(*names, F.col("words").alias("taken"), F.lit(None).cast("long").alias("first_slot"),
                                         F.lit(0).cast("long").alias("slots")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot, slots for every document."""
    out = words_taken(sized_documents(docs), **options)
    return out.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken", "first_slot", "slots")


def mixing_sql(cycle: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42, block_words: int = 256) -> str:
    """DuckDB SQL of ``mixed_documents``: words taken in closed form, and the slots of a document's blocks."""
    weights = ", ".join(map(str, cycle))
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sums AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CAST(list_extract([{weights}], CAST((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % {len(cycle)} + 1 AS INT))
              AS BIGINT) AS weight
  FROM sized GROUP BY source),
ladder AS (
  SELECT source, source_size, weight,
         SUM(source_size) OVER () - COALESCE(SUM({most} * source_size) OVER (
             ORDER BY {most}.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         SUM(weight) OVER (
             ORDER BY {most}.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM sums),
level AS (
  SELECT CAST(left_over AS DOUBLE) AS left_over, CAST(weights AS DOUBLE) AS weights FROM ladder
  WHERE {most} * source_size * weights > left_over * weight
  ORDER BY {most}.0 * source_size / weight, source LIMIT 1),
targets AS (
  SELECT source, source_size,
         LEAST(CAST({most} * source_size AS DOUBLE),
               COALESCE((SELECT left_over FROM level) * weight / (SELECT weights FROM level),
                        CAST({most} * source_size AS DOUBLE))) AS target
  FROM sums),
laid AS MATERIALIZED (
  SELECT ROW_NUMBER() OVER () AS r, s.doc_id, s.source, s.size, t.source_size, t.target, CAST(FLOOR(t.target + 0.5) AS BIGINT) AS take,
         CAST(SUM(s.size) OVER (PARTITION BY s.source ORDER BY md5('{seed}:' || CAST(s.doc_id AS VARCHAR)), s.doc_id, s.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS BIGINT) AS begun
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
meant AS (
  SELECT source, source_size, CAST(FLOOR(target + 0.5) AS BIGINT) AS take,
         CAST(CEIL(FLOOR(target + 0.5) / {block_words}) AS BIGINT) AS n,
         CAST(SUM(CEIL(FLOOR(target + 0.5) / {block_words})) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              - CEIL(FLOOR(target + 0.5) / {block_words}) AS BIGINT) AS begun
  FROM targets),
bits AS (SELECT CASE WHEN SUM(n) > 1 THEN LENGTH(BIN(CAST(SUM(n) - 1 AS BIGINT))) ELSE 0 END AS m FROM meant),
points AS (SELECT source, UNNEST(RANGE(begun, begun + n)) AS point FROM meant),
slots AS (
  SELECT source, slot, ROW_NUMBER() OVER (PARTITION BY source ORDER BY slot) - 1 AS block
  FROM (SELECT source, CAST(COALESCE(LIST_SUM(LIST_TRANSFORM(RANGE(m), lambda i: ((point >> i) & 1) << (m - 1 - i))), 0) AS BIGINT) AS slot
        FROM points, bits)),
turns AS (
  SELECT *, UNNEST(RANGE(0, CAST(GREATEST(0, (take - begun - 1) // source_size) AS BIGINT) + 1)) AS turn
  FROM laid WHERE size > 0 AND begun < take),
held AS (
  SELECT r, MIN(slot) AS first_slot, COUNT(DISTINCT slot) AS slots
  FROM (SELECT r, source, UNNEST(RANGE((begun + turn * source_size) // {block_words},
               (LEAST(begun + turn * source_size + size, take) - 1) // {block_words} + 1)) AS block FROM turns) t
  JOIN slots s ON t.source IS NOT DISTINCT FROM s.source AND t.block = s.block GROUP BY r)
SELECT doc_id, source, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE CAST((take // source_size) * size
         + GREATEST(0, LEAST(size, take % source_size - begun)) AS BIGINT) END AS taken,
       first_slot, CAST(COALESCE(slots, 0) AS BIGINT) AS slots
FROM laid LEFT JOIN held USING (r)"""
