"""A corpus pipeline over ``documents``: five stages, each one operator of ``starmart.llm``.

quality classifier -> SimHash near-duplicates -> benchmark decontamination ->
mixing of sources -> sharding.  Each stage takes the documents that the one before it kept, as
(spark, docs, sf_dir), and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each result as Parquet in the shared folder and reads it again.

Rows are told apart by doc_id and a hash of the text; rows alike in both count as
copies of one another, one of which stays.  Null ids, null texts and an empty table crash no stage; texts of any length
are processed whole; ties (equal ids, copies of one size) go by the hash of the text.  Further columns are kept whatever their names
are; only ``size``, ``shard`` and ``slot`` are replaced by the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm import decontam, mixing, quality, sharding, simhash
from starmart.llm.common import WORD_GAP, materialise, read_table

#: words of a shingle and differing bits of the near-duplicate stage
SHINGLE, DISTANCE = 3, 2
SHARDS = 8


def _key(docs: DataFrame):
    """Identity of a row, in the order of ids, null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                    F.xxhash64("text").alias("hash"))


def _held(docs: DataFrame, *helpers) -> DataFrame:
    """The rows in one column, ``row``, beside helper columns: no name in the documents can clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *helpers)


def _one_row_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """row (see ``_held``) and the further columns of ``chosen``, for one row of each key that is in ``chosen``."""
    parts = lambda key: [F.col(f"{key}.none").alias("none"), F.coalesce(F.col(f"{key}.id"), F.lit(0)).alias("id"),
                         F.col(f"{key}.hash").alias("hash")]
    names = ["none", "id", "hash"]
    keyed = _held(docs, _key(docs).alias("key")).select("row", *parts("key"))
    wanted = chosen.select(*parts("_key"), *[c for c in chosen.columns if c != "_key"])
    first = Window.partitionBy(*names).orderBy(F.lit(0))
    return keyed.join(wanted, names).withColumn("nth", F.row_number().over(first)).where("nth = 1").drop(*names, "nth")


def _by_rows(docs: DataFrame, stage) -> DataFrame:
    """A stage that hands whole rows to Python, for which column names must be plain identifiers."""
    plain = [c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)]
    return stage(docs.toDF(*plain)).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    model = quality.train(docs, labels)
    return _by_rows(docs, lambda rows: quality.select_good(rows, model))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component."""
    keyed = docs.select(_key(docs).alias("_key"), "text")
    found = simhash.simhash_components(keyed, SHINGLE, DISTANCE, id_col="_key")
    kept = materialise(found.where("_key = component_id").select("_key").distinct(), "kept")
    return _one_row_each(docs, kept).select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return _by_rows(docs, lambda rows: decontam.clean(rows, items))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it whole; what the mix leaves out goes.

    Where a source's target ends inside a document (one a source), that copy is cut to the words taken, joined by
    spaces, and its ``n_chars`` counts what is left; so every source meets its target to the word.
    """
    taken = mixing.words_taken(mixing.sized_documents(docs, _key(docs)))
    copies = (taken.where("taken > 0").groupBy(F.col("id").alias("_key"))
              .agg(F.sum("taken").alias("words"), F.first("size").alias("size")))
    copies = copies.select("_key", F.expr("words div size").alias("whole"), (F.col("words") % F.col("size")).cast("int").alias("rest"))
    mixed = _one_row_each(docs, materialise(copies, "copies"))
    turns = F.concat(F.array_repeat(F.lit(0), F.col("whole").cast("int")),
                     F.when(F.col("rest") > 0, F.array("rest")).otherwise(F.array().cast("array<int>")))
    mixed = mixed.withColumn("cut", F.explode(turns))
    words = F.filter(F.split("row.text", WORD_GAP), lambda w: w != "")
    text = F.when(F.col("cut") > 0, F.array_join(F.slice(words, 1, F.greatest("cut", F.lit(1))), " ")).otherwise(F.col("row.text"))
    mixed = mixed.withColumn("text", text)
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        chars = F.col("row.n_chars")
        made["n_chars"] = F.when(F.col("cut") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(chars)
    return mixed.select(*[made.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with size, shard and slot (which replace columns of these names)."""
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    rows = _held(docs, "doc_id", F.xxhash64("text").alias("_g"), sharding.text_size().alias("_size"))
    placed = sharding.shard_rows(rows, SHARDS)
    return placed.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], F.col("_size").alias("size"), "shard", "slot")


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing_sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: trained weights, SimHash and latent vectors have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
