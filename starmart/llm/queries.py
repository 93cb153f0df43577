"""Registered queries of the data-preparation operators and their DuckDB SQL.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .decontam import matches
from .lexical import RANKED_SQL, ranked_documents
from .licences import licence_scan
from .lines import line_dedup_report, line_dedup_sql
from .mixing import mixed_documents, mixing_sql
from .packing import packed_documents
from .passages import repeated_passages
from .periodic import run_digests
from .quality import quality_grades
from .sharding import sharded
from .simhash import simhash_components
from .topk import TOP_K_SQL, top_k
from .warc import WARC_SQL, capture_histories


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(read_table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(read_table(spark, sf_dir, "documents", "doc_id", "text"), 8)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                   read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_histories(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_grades(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                          read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                            read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                            public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_mixing_sources": op3_mixing_sources,
    "op4_line_dedup": op4_line_dedup,
    "op5_sharding": op5_sharding,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_warc": op7_warc,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLE: dict[str, str] = {
    "op3_mixing_sources": mixing_sql(),
    "op4_line_dedup": line_dedup_sql(),
    "op7_warc": WARC_SQL,
    "op9_exact_top_k": TOP_K_SQL,
    "op11_ranked_search": RANKED_SQL,
}
