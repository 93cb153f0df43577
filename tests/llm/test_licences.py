import random
import textwrap

import pytest

from starmart.llm.decontam import words_of
from starmart.llm.licences import TEMPLATES, UNKNOWN, corpus_lines, fit, licence_scan, scan, shares, stretches
from starmart.llm.queries import op1_license_scan

SCHEMA = "doc_id bigint, text string, family string, line int"


@pytest.fixture(scope="module")
def model(spark):
    return fit(corpus_lines(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")))


def rows_of(spark, model, docs):
    return scan(spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA), model).collect()


def test_query_finds_the_planted_lines(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.doc_id, r.line): r.family for r in op1_license_scan(spark, sf_dir).collect() if r.confirmed}
    known = {" ".join(map(bytes.decode, words_of(t.encode()))): f for f, ts in TEMPLATES.items() for t in ts}
    want = {(d, n): known[key] for d, t in docs for n, line in enumerate((t or "").split("\n"))
            if (key := " ".join(map(bytes.decode, words_of(line.encode())))) in known}
    assert want and want == got


def test_held_out_accuracy(spark, model):
    """Variants the fit has not seen, inside prose, against prose with licence words."""
    rng = random.Random(8)
    prose = [" ".join(map(bytes.decode, w)) for w in corpus_lines(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 300)]
    prose = [p for p in prose if "licen" not in p and "rights" not in p]
    docs, truth = [], {}
    for family, texts in TEMPLATES.items():
        for text in texts:
            for _ in range(3):
                words = text.split()
                if len(words) > 12:
                    words = [w for w in words if rng.random() > 0.05]
                lead = rng.choice(prose).split()[:3]
                truth[len(docs)] = family
                docs.append((len(docs), "Some prose first.\n" + " ".join([*lead, *words]).upper() + "\nand after"))
    hard = ["The driver showed a license to the free public.", "General conditions apply to this software course.",
            "Copies of the notice were released under the bridge.", "A creative work of the commons, version two."]
    clean = [(10000 + i, t) for i, t in enumerate(prose + hard)]
    rows = rows_of(spark, model, docs + clean)
    right = sum(1 for d, f in truth.items() if any(r.doc_id == d and r.family == f for r in rows))
    assert right >= 0.93 * len(truth)
    # the same paragraph stands in several families' texts only as variants of one another
    assert not [r for r in rows if r.doc_id >= 10000 and r.confirmed]
    assert all(r.line == 1 for r in rows if r.doc_id < 10000)


def wrapped(text, width=72):
    return textwrap.wrap(text, width, break_long_words=False)


def test_notices_over_several_lines(spark, model):
    """Every template wrapped at 72 columns, as a paragraph and inside one, with its first line and extent."""
    docs, want = [], {}
    for family, texts in TEMPLATES.items():
        for text in texts:
            lines = wrapped(text)
            for before, after in ((["A line of prose.", ""], ["", "More prose."]), (["Words of a file:"], ["And so on."])):
                docs.append((len(docs), "\n".join(before + lines + after)))
                want[len(docs) - 1] = family, len(before), len(lines)
    rows = rows_of(spark, model, docs)
    several = {d: w for d, w in want.items() if w[2] > 1}
    assert len(several) >= 30
    for d, (family, first, count) in several.items():
        mine = [r for r in rows if r.doc_id == d and r.confirmed]
        assert any(r.family == family for r in mine), (d, family)
        whole = [r for r in mine if r.lines > 1 and r.family == family]
        assert all(first <= r.line and r.line + r.lines <= first + count + 1 for r in whole)
    text = dict(docs)
    for d, (family, first, count) in several.items():  # the extent is known unless a line holds the notice alone
        alone = any(shares(words_of(x.encode()), family)[0] >= 0.8 for x in text[d].split("\n"))
        assert alone or any(r.lines > 1 and r.family == family for r in rows if r.doc_id == d), text[d]


def test_stretches_against_brute_force(model):
    """Every run of lines that holds a template, cut to what matters, against the windows' search."""
    rng = random.Random(3)
    prose = [[b"p%d" % rng.randint(0, 900) for _ in range(rng.randint(1, 14))] for _ in range(400)]
    lines, want = [], set()
    for _ in range(25):
        family = rng.choice(sorted(TEMPLATES))
        notice = [words_of(x.encode()) for x in wrapped(rng.choice(TEMPLATES[family]), 60)]
        lines += rng.sample(prose, rng.randint(0, 9)) + ([[]] if rng.random() < 0.5 else [])
        if len(notice) > 1:
            want.add((len(lines), len(notice), b" ".join(w for x in notice for w in x)))
        lines += notice
    got = {(first, count): family for first, count, family, *_ in stretches(model, lines)}
    hit = [w for w in want if any(first <= w[0] + 1 and first + count >= w[0] + w[1] - 1 for first, count in got)]
    assert len(hit) >= 0.9 * len(want)  # notices that stand side by side share their windows
    for first, count in got:
        assert any(first < at + n and at < first + count for at, n, _ in want)


def test_edge_cases(spark, model):
    notice = "Released under the MIT License."
    docs = [(1, None), (2, ""), (3, "\n\n" + notice + "\n"), (3, "\n\n" + notice + "\n"), (None, notice),
            (4, "filler words here\n" * 30000 + notice), (5, "license"), (6, "x" * 100000), (7, notice.lower())]
    rows = rows_of(spark, model, docs)
    assert sorted(((r.doc_id, r.line, r.family) for r in rows if r.confirmed), key=str) == sorted(
        [(3, 2, "mit"), (3, 2, "mit"), (None, 0, "mit"), (4, 30000, "mit"), (7, 0, "mit")], key=str)
    assert all(r.family == UNKNOWN for r in rows if not r.confirmed)
    empty = spark.createDataFrame([], SCHEMA)
    assert licence_scan(empty).count() == 0


def test_fit_is_repeatable(spark):
    lines = corpus_lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    a, b = fit(lines), fit(lines)
    assert a.index == b.index and (a.weights == b.weights).all() and a.cutoff == b.cutoff
