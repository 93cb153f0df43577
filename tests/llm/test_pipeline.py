from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from starmart.llm.decontam import Settings
from starmart.llm.quality import quality_grades
from test_decontam import brute as leaks
from test_mixing import brute_targets
from test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        docs.append(pipeline.materialise(stage(spark, docs[-1], SF), name))
    return docs


def test_stages_in_order(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination",
                                               "mixing_sources", "sharding"]
    for docs in stages[:-1]:
        assert docs.columns == COLUMNS


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality_grades(stages[0], labels)
    want = {r.doc_id for r in scored.where("kept").collect()}
    assert {r.doc_id for r in stages[1].collect()} == want
    good = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    assert len(good - want) <= 0.02 * len(good)


def test_near_duplicate_stage(stages):
    prints = [(r.doc_id, brute_print(r.text)) for r in stages[1].collect()]
    parts = brute_components(prints)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(parts.values()))


def test_decontamination_stage(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in stages[2].collect()]
    bad = {d for d, _ in leaks(docs, items, Settings())}
    assert {r.doc_id for r in stages[3].collect()} == {d for d, _ in docs} - bad


def test_mixing_stage(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    after = stages[4].collect()
    whole = Counter(r.doc_id for r in after if r.text == before[r.doc_id].text)
    assert {r.doc_id for r in after} <= set(before) and max(whole.values()) <= 3
    sizes, words, cut = Counter(), Counter(), Counter()
    for r in before.values():
        sizes[r.source] += len(r.text.split())
    for r in after:
        words[r.source] += len(r.text.split())
        if r.text != before[r.doc_id].text:
            cut[r.source] += 1
            assert before[r.doc_id].text.split()[:len(r.text.split())] == r.text.split() and r.n_chars == len(r.text)
    assert words == Counter({s: int(t + 0.5) for s, t in brute_targets(sizes).items()})  # to the word
    assert max(cut.values()) == 1


CLASHING = ["_id", "_hash", "_n", "_none", "_copies", "_copy", "_g", "_size", "_key", "g", "row", "cut", "none", "id", "hash", "nth",
            "whole", "rest", "key", "words", "_h", "_b", "_one", "a.b"]


def test_clashing_columns_keep_their_values(spark):
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    odd = plain.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id")).alias(c) for c in CLASHING],
                       *[F.col("doc_id").alias(c) for c in ("size", "shard", "slot")])
    for name, stage in pipeline.STAGES:
        want, got = stage(spark, plain, SF), stage(spark, odd, SF)
        if name != "sharding":
            assert got.columns == odd.columns
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert set(CLASHING) <= set(got.columns)
        for r in got.collect():
            assert all(r[c] == f"{c} {r['doc_id']}" for c in CLASHING)


def test_sharding_stage(stages):
    rows = stages[5].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in stages[4].collect())
    home = {}
    for r in rows:
        assert home.setdefault(r.text, r.shard) == r.shard
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_run_equals_the_stages(spark, stages):
    out = pipeline.run(spark, SF)
    key = ["doc_id", "text", "size", "shard", "slot"]
    assert sorted(map(tuple, out.select(key).collect())) == sorted(map(tuple, stages[5].select(key).collect()))


def test_edge_cases(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, _copy int"
    long = "the long one " * 30000
    rows = [(1, None, None, None, None, 1, 1), (2, "", "en", "a", 0, 2, None), (None, "no id here at all", "en", "b", 3, 1, 1),
            (None, "no id here at all", "en", "b", 3, 1, 1), (3, "same text of two rows", "en", "a", 3, 1, 1),
            (3, "same text of two rows", "en", "a", 3, 1, 1), (3, "other text under one id", "en", None, 3, 1, 1),
            (4, long, "en", "c", 9, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0
    unique = pipeline.near_duplicate_stage(spark, docs, SF)
    texts = [r.text or "" for r in unique.collect()]
    assert len(texts) == len(set(texts)) and unique.columns == docs.columns
    assert pipeline.decontamination_stage(spark, docs, SF).count() == len(rows)
    mixed = pipeline.mixing_stage(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.where(F.trim("text") == "").count() == 0
    placed = pipeline.sharding_stage(spark, docs, SF)
    assert placed.count() == len(rows) and placed.columns[-3:] == ["size", "shard", "slot"]
