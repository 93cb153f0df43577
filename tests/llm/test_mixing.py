import pyarrow as pa
from against_sql import assert_same
from pyspark.sql import functions as F

from starmart.llm.mixing import mix, mixed_documents, mixing_sql, sized_documents, source_targets
from starmart.llm.queries import op3_mixing_sources

SCHEMA = "doc_id bigint, text string, source string, size string"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_query_against_sql(spark, sf_dir):
    out = op3_mixing_sources(spark, sf_dir)
    assert_same(out, mixing_sql(), sf_dir)
    pdf = out.toPandas()
    got = pdf.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((got.taken - got.target).abs() <= 0.5).all()
    assert (pdf.taken <= 3 * pdf["size"]).all()


def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: (1, 2, 3)[i % 3] for i, n in enumerate(names)}
    target, left = {n: 0.0 for n in names}, float(sum(sizes.values()))
    free = set(names)
    while left > 1e-9 and free:
        total, over = sum(weight[n] for n in free), 0.0
        for n in list(free):
            target[n] += left * weight[n] / total
        for n in list(free):
            if target[n] >= 3 * sizes[n]:
                over += target[n] - 3 * sizes[n]
                target[n] = 3.0 * sizes[n]
                free.discard(n)
        left = over
    return target


def test_targets_are_shared_again(spark):
    sizes = {"a": 5, "b": 1000, "B": 40, "é": 0, "z": 7000, None: 3, "": 600}
    rows = [(i, "w " * n, s, None) for i, (s, n) in enumerate(sizes.items())]
    sized = sized_documents(docs_of(spark, rows))
    got = {r.source: r.target for r in source_targets(sized).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_schedule_is_spread_evenly(spark):
    rows = [(i, "w " * (50 + i % 90), f"s{i % 4}", None) for i in range(800)]
    sized = sized_documents(docs_of(spark, rows))
    schedule, _ = mix(sized, block_words=16)
    slots = schedule.select("source", "block", "slot").distinct().orderBy("slot").collect()
    count = {}
    for r in slots:  # the k-th slot of a source takes its k-th block
        assert r.block == count.get(r.source, 0)
        count[r.source] = r.block + 1
    n = len(slots)
    for source, total in count.items():  # every stretch has its share
        marks = [r.source == source for r in slots]
        for at in range(0, n - n // 8, n // 8):
            assert abs(sum(marks[at:at + n // 8]) - total / 8) <= 8
    words = schedule.groupBy("slot").agg(F.sum("words").alias("w"), F.first("source").alias("s")).collect()
    assert sum(r.w != 16 for r in words) <= 4  # only each source's last block is cut


def test_edge_cases(spark):
    long = "word\t" * 70000
    rows = [(1, None, "a", "x"), (2, "", "a", None), (3, " \n\t", None, None), (4, "one two", "a", "y"),
            (4, "one two", "a", "y"), (5, long, "b", "z"), (6, "a b c", None, None), (None, "x y", "c", None),
            (7, "v w x\x1fy", "c", None)]
    docs = docs_of(spark, rows)
    frame = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows],
                      "source": [r[2] for r in rows]})
    out = mixed_documents(docs)
    assert out.count() == len(rows)
    sql = mixing_sql().replace("CAST(s.doc_id AS VARCHAR)", "COALESCE(CAST(s.doc_id AS VARCHAR), '')")
    assert_same(out, sql, documents=frame)
    assert mixed_documents(docs.limit(0)).count() == 0
    blank = mixed_documents(docs.where("doc_id < 4")).collect()
    assert len(blank) == 3 and all(r.taken == 0 and r.target == 0 for r in blank)


def test_hot_source(spark):
    rows = [(i, "w " * (i % 37), "hot" if i % 3 else f"s{i % 50}", None) for i in range(3000)]
    frame = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "source": [r[2] for r in rows]})
    assert_same(mixed_documents(docs_of(spark, rows), block_words=8), mixing_sql(block_words=8), documents=frame)
