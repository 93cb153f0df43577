import random

import pyarrow as pa
import pytest
from against_sql import assert_same

from starmart.llm.lines import (deduplicated_lines, line_dedup_report, line_dedup_sql, rank_levels, repeated_lines,
                                without_repeats)
from starmart.llm.queries import op4_line_dedup

SCHEMA = "doc_id bigint, text string, lines string, pos int"


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)


def as_arrow(docs):
    return pa.table({"doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string())})


def test_query_against_sql(spark, sf_dir):
    assert_same(op4_line_dedup(spark, sf_dir), line_dedup_sql(), sf_dir)


def made_up(seed, docs=40):
    rng = random.Random(seed)
    runs = [[f"line {rng.randint(0, 9)}" for _ in range(rng.randint(1, 9))] for _ in range(6)]
    out = []
    for d in range(docs):
        lines = []
        for _ in range(rng.randint(0, 5)):
            lines += rng.choice(runs) if rng.random() < 0.6 else [f"own {rng.randint(0, 400)}"]
            if rng.random() < 0.2:
                lines.append("  ")
        out.append((d, "\n".join(lines)))
    return out


@pytest.mark.parametrize("min_lines", [1, 3])
def test_against_sql_on_repetitive_documents(spark, min_lines):
    docs = made_up(min_lines)
    assert_same(line_dedup_report(frame(spark, docs), min_lines), line_dedup_sql(min_lines), documents=as_arrow(docs))


def test_ranks_and_lengths_against_brute_force(spark):
    docs = made_up(11, 12) + [(50, "a\n" * 9), (51, "a\n" * 6)]
    made, found = repeated_lines(frame(spark, docs), 2)
    seq = {r.d: [(x.h1, x.h2) for x in r.lines] for r in made.collect()}
    for r in found.collect():
        n = 0
        a, b = seq[r.d][r.pos:], seq[r.src_d][r.src_pos:]
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert r.run == n >= 2 and (r.src_d, r.src_pos) < (r.d, r.pos)
    lines = spark.createDataFrame([(d, p, len(s), *h) for d, s in seq.items() for p, h in enumerate(s)],
                                  "d bigint, pos bigint, n bigint, h1 bigint, h2 int")
    for u, level in enumerate(rank_levels(lines)):
        h = 1 << u
        block = {(d, p): tuple((x % 2 ** 64, x >> 0, y) for x, y in s[p:p + h]) for d, s in seq.items() for p in range(len(s))}
        rows = {(r.d, r.pos): r.rank for r in level.collect()}
        want = {k for k, v in block.items() if len(v) == h and sum(v == o for o in block.values()) > 1}
        assert set(rows) == want
        for a in rows:  # equal ranks for equal stretches, ordered like the sequences
            for b in rows:
                x, y = [[v[0] for v in block[k]] for k in (a, b)]
                assert (rows[a] < rows[b]) == (x < y) and (rows[a] == rows[b]) == (x == y)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "\n \t\r\n"), (4, "a\nb\nc"), (5, "x\n\n a\r\nb \ny"), (6, "a\nb\nc"), (7, "solo"),
            (8, "solo"), (9, "w" * 200000 + "\nq"), (10, "q\n" * 3000)]
    assert_same(line_dedup_report(frame(spark, docs)), line_dedup_sql(), documents=as_arrow(docs))
    gone = {r.doc_id: list(r.deleted) for r in deduplicated_lines(frame(spark, docs)).collect()}
    assert gone[5] == [2, 3] and gone[6] == [0, 1, 2] and gone[4] == [] and gone[8] == [0]
    text = {r.doc_id: r.text for r in without_repeats(frame(spark, docs)).collect()}
    assert text[5] == "x\n\ny" and text[4] == "a\nb\nc" and text[1] is None and len(text) == len(docs)
    again = [(4, "a\nb"), (4, "a\nb"), (None, "a\nb")]
    assert sorted(r.deleted_lines for r in line_dedup_report(frame(spark, again)).collect()) == [0, 2, 2]
    assert line_dedup_report(frame(spark, docs[:3])).count() == 3
    assert line_dedup_report(frame(spark, [])).count() == 0


def test_hot_line_and_copies(spark):
    docs = [(i, "header\ncommon\n" + f"own {i}\nfooter {i % 3}") for i in range(300)] + [(1000 + i, "p\nq\nr\ns") for i in range(200)]
    assert_same(line_dedup_report(frame(spark, docs)), line_dedup_sql(), documents=as_arrow(docs))
