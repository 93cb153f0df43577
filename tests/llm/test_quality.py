import numpy as np

from starmart.llm.quality import BUCKETS, features, fit_ordinal, graded, quality_grades, select_good, train
from starmart.llm.queries import op8_quality_classifier

DOCS = "doc_id bigint, text string, quality int"     # an extra column with a clashing name
LABELS = "doc_id bigint, quality int, toxic int"


def test_fit_recovers_order():
    rng = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(3000):
        x = np.flatnonzero(rng.random(30) < 0.3)
        score = 2.0 * np.isin(x, [1, 2]).sum() - 2.0 * np.isin(x, [3, 4]).sum() + rng.logistic()
        rows.append(x.astype(np.int32))
        grades.append(int(score > -1) + int(score > 1))
    model = fit_ordinal(rows, np.array(grades), 3)
    assert (np.diff(model.cuts) > 0).all()
    np.testing.assert_allclose(model.weights[[1, 2]], 2, atol=0.3)
    np.testing.assert_allclose(model.weights[[3, 4]], -2, atol=0.3)
    np.testing.assert_allclose(model.cuts, [-1, 1], atol=0.3)


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    fitted = train(docs, labels.where("doc_id % 5 <> 0"))
    held = graded(labels.where("doc_id % 5 = 0")).join(docs, "doc_id")
    rows = select_good(held, fitted).groupBy("grade").count().collect()
    total = {r.grade: r["count"] for r in held.groupBy("grade").count().collect()}
    kept = {r.grade: r["count"] for r in rows}
    assert kept[2] >= 0.98 * total[2]
    assert kept.get(0, 0) <= 0.05 * total[0]
    assert kept.get(1, 0) <= 0.5 * total[1]


def test_query_returns_every_document(spark, sf_dir):
    out = op8_quality_classifier(spark, sf_dir).toPandas()
    ids = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").toPandas()
    assert sorted(out.doc_id) == sorted(ids.doc_id)
    assert out.tail_probability.between(0, 1).all() and out.expected_grade.between(0, 2).all()
    assert (out.expected_grade >= out.tail_probability - 1e-6).all()
    again = op8_quality_classifier(spark, sf_dir).toPandas()
    assert out.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()


def test_edge_cases(spark):
    docs = [(1, None, 0), (2, "", None), (3, "word " * 60000, 1), (3, "word " * 60000, 1), (None, "a b", 1)]
    labels = [(1, None, None), (2, 1, 0), (9, 0, 0), (None, 0, 1)]
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    rows = quality_grades(d, lab).collect()
    assert len(rows) == 5 and all(r.kept and r.tail_probability == 1 for r in rows)  # one grade only
    assert quality_grades(d.limit(0), lab).count() == 0
    assert quality_grades(d, lab.limit(0)).where("kept").count() == 5
    assert select_good(d, train(d, lab)).columns == ["doc_id", "text", "quality"]


def test_features_cover_the_whole_text():
    a = features(b"plain words " * 30000)
    b = features(b"plain words " * 30000 + b"last")
    assert len(b) == len(a) + 1 and (b < BUCKETS).all()
    assert set(features(None)) == set(features(b""))
