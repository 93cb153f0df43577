"""The quality stage sends texts alone to Python, and holds few of them as objects at once."""

import numpy as np
import pyarrow as pa

from starmart.llm import quality


def _model():
    return quality.OrdinalModel(np.linspace(-1, 1, quality.BUCKETS).astype(np.float32), np.array([-0.5, 0.5]))


def test_rows_stay_in_spark(spark):
    docs = spark.createDataFrame([(i, None if i % 5 == 0 else f"word{i} and more", "x" * i) for i in range(40)],
                                 "doc_id long, text string, other string")
    tails = sorted(r.tail_probability for r in quality.score(docs, _model()).collect())
    middle = (tails[19] + tails[-1]) / 2
    kept = quality.select_good(docs, _model(), 2, middle)
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()
    want = {r.doc_id for r in quality.score(docs, _model(), 2, middle).where("kept").collect()}
    assert 0 < len(want) < 40
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns


def test_texts_are_read_in_pieces(monkeypatch):
    sizes = []
    real = quality.utf8
    monkeypatch.setattr(quality, "utf8", lambda column: sizes.append(len(column)) or real(column))
    texts = pa.array([f"text {i}" for i in range(1000)])
    assert len(quality._scored(_model(), texts)) == 1000
    assert max(sizes) <= 256 and sum(sizes) == 1000
