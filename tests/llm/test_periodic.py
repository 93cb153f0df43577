import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from starmart.llm import periodic
from starmart.llm.common import read_table
from starmart.llm.periodic import periodic_runs, run_digests, runs_of
from starmart.llm.queries import op12_periodic_runs

SCHEMA = "doc_id bigint, text string, runs string, start int, collapsed int"


def brute(words):
    """All runs by comparing the words with themselves at every distance."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        j = 0
        while j < n - q:
            if words[j] != words[j + q]:
                j += 1
                continue
            s = j
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - s + q >= max(24, 3 * q):
                found.setdefault((s, j + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def digest_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + k for s, k, q in runs)]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


def repeated(rng, k):
    letter = lambda: str(rng.randrange(k))
    words = [letter() for _ in range(rng.randint(0, 120))]
    for _ in range(rng.randint(0, 4)):
        root = [letter() for _ in range(rng.randint(1, 60))]
        words += (root * 6)[:rng.randint(2 * len(root), 5 * len(root))]
        words += [letter() for _ in range(rng.randint(0, 30))]
    return words * 3 if rng.random() < 0.2 else words


def test_runs_against_brute_force():
    rng = random.Random(4)
    texts = [[w.encode() for w in repeated(rng, k)] for k in (1, 2, 2, 3, 5, 50) for _ in range(25)]
    assert runs_of(texts) == [brute(t) for t in texts]
    assert sum(map(len, runs_of(texts))) > 100


def test_words_full_of_repeats():
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(11):
        a, b = b, b + a
    assert runs_of([b]) == [brute(b)]
    ruler = [str((i & -i).bit_length()).encode() for i in range(1, 700)]
    assert runs_of([ruler]) == [brute(ruler)]


def test_every_period_and_offset():
    """Runs of exactly three periods at odd places, for periods around the borders of the scales."""
    rng, texts = random.Random(6), []
    for q in [*range(6, 35), 47, 48, 49, 63, 64, 65, 95, 96, 97, 127, 128, 129, 191, 192, 193]:
        root = [f"{rng.randrange(9)}" for _ in range(q)]
        lead, tail = ([f"x{rng.random()}" for _ in range(rng.randint(0, 40))] for _ in range(2))
        texts.append([w.encode() for w in lead + (root * 4)[:max(24, 3 * q)] + tail])
    assert runs_of(texts) == [brute(t) for t in texts]


def test_chosen_positions_depend_on_the_words_alone():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    twice = np.concatenate([hashes, hashes])
    chosen = set(periodic.synchronising(twice, 9).tolist())
    assert {i for i in chosen if 8 <= i < 392} == {i - 400 for i in chosen if 408 <= i < 792}
    assert all(any(i + j in chosen for j in range(9)) for i in range(792))


def test_query_against_brute_force(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").collect()
    got = {tuple(r) for r in op12_periodic_runs(spark, sf_dir).collect()}
    some = [d for d in docs if len((d["text"] or "").split()) < 700]
    assert len(got) == len(docs) and len(some) > 500
    assert {digest_row(d["doc_id"], d["text"]) for d in some} <= got
    assert any(r[1] for r in got)


def test_edge_cases(spark):
    ten = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(1, None), (2, ""), (3, " \t\x0b\n"), (ten, None), (ten, "one"), (ten, "a b c d e f g h i j " * 9), (None, "x y " * 30),
            (4, "lone " * 24), (5, "lone " * 23), (6, "é ü ö " * 20), (6, "é ü ö " * 20), (7, "a b " * 40000),
            (8, " ".join(map(str, range(50000))))]
    frame = spark.createDataFrame([(i, t, "x", 0, 0) for i, t in rows], SCHEMA)
    got = sorted(map(tuple, run_digests(frame).collect()), key=repr)
    assert [r for r in got if r[0] not in (7, 8)] == sorted((digest_row(*r) for r in rows if r[0] not in (7, 8)), key=repr)
    long = {r[0]: r for r in got}
    assert long[7][1:6] == (1, 0, 80000, 2, 40000000) and long[8][1] == 0
    found = {r["id"]: r for r in periodic_runs(frame).collect()}
    assert found[4]["collapsed"] == "lone" and [tuple(r) for r in found[4]["runs"]] == [(0, 24, 1)]
    assert found[7]["collapsed"] == "a b" and found[1]["collapsed"] == "" and found[5]["runs"] == []
    assert run_digests(frame.limit(0)).count() == 0
