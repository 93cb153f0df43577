import math
import random

from against_sql import assert_same

from starmart.llm.queries import op9_exact_top_k
from starmart.llm.topk import TOP_K_SQL, top_k

SCHEMA = "vec_id bigint, embedding array<float>, label string, score int"


def brute(rows, k=5, every=50):
    vec = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            vec[i] = [math.floor(256 * x) for x in e]
    out = []
    for q in vec:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(vec[q], v)), i) for i, v in vec.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, e, "x", 0) for i, e in rows], SCHEMA)
    return sorted(map(tuple, top_k(frame, **options).collect()))


def test_query_against_sql(spark, sf_dir):
    assert_same(op9_exact_top_k(spark, sf_dir), TOP_K_SQL, sf_dir)


def test_random_vectors_ties_and_copies(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5]) for _ in range(5)]) for i in range(900)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.25, -1.0]) for i in range(500)]  # a third are copies
    rng.shuffle(rows)
    for lists in (1, 2, 3):
        assert run(spark, rows, lists=lists) == brute(rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (50, [0.1, 0.2]), (100, None), (150, [nan, 0.0]), (200, [inf, 0.0]), (250, [None, 1.0]),
            (300, [1.0]), (350, []), (7, [0.5, -0.5]), (7, [0.5, -0.5]), (None, [1.0, 1.0]), (8, [-1.0, 1.0, 3.0])]
    want = brute([r for r in rows if r[0] is not None])
    assert run(spark, rows) == want
    assert run(spark, rows[:1]) == []
    assert run(spark, rows[:2]) == brute(rows[:2])
    frame = spark.createDataFrame([], SCHEMA)
    assert top_k(frame).count() == 0


def test_many_blocks(spark, monkeypatch):
    import starmart.llm.topk as module
    monkeypatch.setattr(module, "CANDIDATE_BLOCK", 100)
    monkeypatch.setattr(module, "QUERY_BLOCK", 7)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(1000)]
    rows = [(i, [float(format(x, ".3f")) for x in e]) for i, e in rows]
    single = [tuple(r) for r in spark.createDataFrame(rows, "i bigint, e array<float>").collect()]
    assert run(spark, rows, every=20) == brute(single, every=20)
