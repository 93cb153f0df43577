import base64
import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from against_sql import assert_same

from starmart.llm.queries import op7_warc
from starmart.llm.warc import WARC_SQL, LoserTree, capture_histories, read_archives, write_archives

SCHEMA = "page_id bigint, url string, html string, captured string, place int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        to = first.get(html or "")
        back = to is not None and i != to
        out.append((i, len((html or "").encode()), digest(html), "revisit" if back else "response", to if back else None))
    return sorted(out, key=str)


def test_query_against_sql(spark, sf_dir):
    assert_same(op7_warc(spark, sf_dir), WARC_SQL, sf_dir)


def test_order_is_global(spark, sf_dir):
    rows = op7_warc(spark, sf_dir).collect()
    keys = [(r.url_key.encode(), r.captured, r.page_id) for r in rows]
    assert keys == sorted(keys) and len(keys) == 250


def test_edge_cases(spark, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    rows = [(3, "http://a.b/c", tricky), (1, None, tricky), (2, "http://www.A.b:80?q#f", None), (4, "", ""),
            (5, "x\r\ny", "é\x00" * 100000), (5, "x\r\ny", "é\x00" * 100000), (None, "http://u@h", tricky),
            (None, "http://h/", "alone"), (None, "http://h/", "alone"), (6, "http://h/", "one")]
    got = sorted((tuple(r)[:5] for r in capture_histories(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)
    assert capture_histories(frame(spark, rows).limit(0)).count() == 0
    key = {r.page_id: r.url_key for r in capture_histories(frame(spark, rows)).collect()}
    assert (key[2], key[3], key[1]) == ("b,a)/?q", "b,a)/c", "")
    write_archives(frame(spark, rows), str(tmp_path / "least"), least=20)
    types = {r.page_id: r.record_type for r in read_archives(spark, str(tmp_path / "least")).collect()}
    assert types[4] == "response" and types[3] == "revisit"  # short payloads are all responses


def test_hot_payload_and_url_over_many_archives(spark, tmp_path):
    rng = random.Random(0)
    rows = [(i, "http://hot.com/" if i % 3 else f"http://h{i % 7}.org/{i}", "copy" if rng.random() < 0.4 else f"p{i % 50}")
            for i in range(3000)]
    rng.shuffle(rows)
    made = frame(spark, rows).repartition(6)
    write_archives(made, str(tmp_path / "w"), records=100)
    index = read_archives(spark, str(tmp_path / "w"))
    assert index.select("archive").distinct().count() >= 30
    got = sorted((tuple(r)[:5] for r in capture_histories(made).collect()), key=str)
    assert got == brute(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=8), max_size=9))
def test_loser_tree(runs):
    merged = list(LoserTree([iter(sorted(r)) for r in runs]))
    assert merged == sorted(x for r in runs for x in r)
