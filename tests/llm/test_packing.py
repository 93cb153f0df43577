import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import starmart.llm.packing as packing
from starmart.llm.common import read_table
from starmart.llm.packing import best_fit, crossed, evolve, fitness, pack_sequences, packed_documents
from starmart.llm.queries import op13_best_fit_packing
from starmart.llm import tokens
from starmart.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, pid int, id string, length int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, tokenizer, capacity=2048):
    """Every document whole, every sequence gapless and within its capacity; the number of sequences."""
    want = []
    for i, text in docs:
        ids = ids_of(tokenizer, text)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=repr) == sorted(want, key=repr)
    placed = {}
    for r in rows:
        placed.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in placed.values():
        ends = list(itertools.accumulate(n for _, n in sorted(held)))
        assert [o for o, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(placed)


def test_query_against_whole_encoding(spark, sf_dir, tokenizer):
    docs = [tuple(r) for r in read_table(spark, sf_dir, "documents", "doc_id", "text").collect()]
    rows = op13_best_fit_packing(spark, sf_dir).collect()
    used = check(rows, docs, tokenizer)
    assert used <= 1.01 * sum(r["length"] for r in rows) / 2048 + 1


def test_ids_equal_those_of_the_tokenizer(tokenizer, monkeypatch):
    odd = ["it's I'LL don't <|endoftext|> a<|startoftext|>b !'s '", "É́ é ß ẞ İ ŉ ſ × ÷ ª º ¹ ² x2y3", "σΣς ΑΣ \u0085 \x1c \x00",
           "日本語 ابجد \U0001f600👍🏽 é   x", "don't_can't--we'll...", ""]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in odd * 2]
    for together in (1, 40, 1 << 23):
        monkeypatch.setattr(tokens, "TOGETHER", together)
        small = Encoder(PATH, remembered=3)
        assert [x.tolist() for x in small.encode([t.encode() for t in odd * 2])] == want
    assert list(small.encode([])) == []
    other = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    assert [x.tolist() for x in other.encode([b"two  words"])] == [whole.encode("two  words", add_special_tokens=False).ids]


def test_small_cases_reach_the_optimum():
    """Against trying every assignment."""
    rng = random.Random(3)

    def least(sizes, capacity):
        for n in range(1, len(sizes) + 1):
            loads = [0] * n

            def fits(i):
                if i == len(sizes):
                    return True
                for b in sorted(set(loads), reverse=True):
                    j = loads.index(b)
                    if b + sizes[i] <= capacity:
                        loads[j] += sizes[i]
                        if fits(i + 1):
                            return True
                        loads[j] -= sizes[i]
                return False

            if fits(0):
                return n

    for case in range(40):
        sizes = np.array(sorted((rng.randint(5, 60) for _ in range(rng.randint(1, 9))), reverse=True))
        found = evolve([case], sizes, [], 100, 60, 6)
        assert fitness(found[0], sizes, 100)[0] == least(sizes.tolist(), 100)


def test_crossover_keeps_every_piece_and_whole_bins():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 90, 300)
    a, b = (best_fit(sizes, rng.permutation(300), 100, np.zeros(300, np.int32), []) for _ in range(2))
    child = crossed(rng, a, b, sizes, 100)
    assert len(child) == 300 and np.bincount(child, sizes).max() <= 100
    bins = lambda m: {frozenset(np.flatnonzero(m == x).tolist()) for x in set(m.tolist())}
    assert bins(child) & bins(a) and bins(child) & bins(b)


def test_evolution_beats_best_fit_decreasing():
    """Three pieces fill a bin exactly; best fit decreasing alone needs more bins."""
    rng = random.Random(9)
    sizes = []
    for _ in range(20):
        a, b = rng.randint(26, 48), rng.randint(26, 48)
        sizes += [a, b, 100 - a - b] if 100 - a - b > 0 else [a, 100 - a]
    sizes = np.array(sizes)
    plain = best_fit(sizes, np.argsort(-sizes, kind="stable"), 100, np.zeros(len(sizes), np.int32), [])
    found = evolve([1], sizes, [], 100, 600, 12)
    assert fitness(found[0], sizes, 100) < fitness(plain, sizes, 100)


def test_parts_and_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART", 60)
    rng = random.Random(1)
    sizes = [rng.choice([1, 7, 30, 55, 64]) + rng.randint(0, 30) for _ in range(1500)] + [100] * 40
    frame = spark.createDataFrame(list(enumerate(sizes)), "pid bigint, length bigint")
    rows = pack_sequences(frame, 100).collect()
    assert sorted(r["pid"] for r in rows) == list(range(len(sizes)))
    loads = {}
    for r in rows:
        loads.setdefault(r["sequence_id"], []).append((r["offset"], sizes[r["pid"]]))
    for held in loads.values():
        assert sum(n for _, n in held) <= 100
        assert [o for o, _ in sorted(held)] == [0, *itertools.accumulate(n for _, n in sorted(held)[:-1])]
    one = evolve([0], np.array(sizes[:1500]), [], 100, 0, 1)
    assert len(loads) - 40 <= 1.12 * fitness(one[0], np.array(sizes[:1500]), 100)[0]  # parts of 60 pieces


def test_edge_cases(spark, tokenizer):
    docs = [(1, None), (2, ""), (3, "word"), (3, "word"), (None, "a b c"), (4, "long words here " * 4000), (5, "x " * 2047),
            (6, "x " * 2046), (7, "\n \t")]
    frame = spark.createDataFrame([(i, t, 0, "x", 0) for i, t in docs], SCHEMA)
    used = check(packed_documents(frame, PATH).collect(), docs, tokenizer)
    assert used == -(-sum(len(ids_of(tokenizer, t)) for _, t in docs) // 2048)
    assert packed_documents(frame.limit(0), PATH).count() == 0
