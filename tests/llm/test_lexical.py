import math
import random
import re
from collections import Counter

import pytest
from against_sql import assert_same

import starmart.llm.lexical as lexical
from starmart.llm.lexical import RANKED_SQL, ranked_documents
from starmart.llm.queries import op11_ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id bigint, text string, n int, terms string, score int", "item_id bigint, text string, rank int"


def brute(docs, items, k):
    held = [(i, TERM.findall(t.translate(FOLD))) for i, t in docs if t]
    held = [(i, t) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = Counter(t for _, words in held for t in set(words))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(TERM.findall((t or "").translate(FOLD)))
    out = []
    for item, terms in wanted.items():
        found = []
        for i, words in held:
            tf, m = Counter(words), 100 - 50 + (50 * len(words) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in terms if t in tf)
            if score:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def run(spark, docs, items, k=5):
    d = spark.createDataFrame([(i, t, 0, "x", 0) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    return sorted(map(tuple, ranked_documents(d, q, k).collect()), key=repr)


def made(rng, n, words, size):
    return [(i, " ".join(rng.choices(words, k=rng.randint(1, size)))) for i in range(n)]


def test_query_against_sql(spark, sf_dir):
    assert_same(op11_ranked_search(spark, sf_dir), RANKED_SQL, sf_dir)


@pytest.mark.parametrize("block", [40, 1 << 17])
def test_random_texts(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK", block)
    rng = random.Random(block)
    words = [f"w{int(rng.paretovariate(0.6)) % 90}" for _ in range(400)]
    docs, items = made(rng, 400, words, 30), made(rng, 25, words, 12)
    docs += [(1000 + i, docs[3][1]) for i in range(200)]  # a third are copies: ties by id
    assert run(spark, docs, items) == brute(docs, items, 5)


def test_skips_documents_but_loses_none(spark, monkeypatch):
    """With a cutoff, units that can't reach it bring no candidates; every document from it on is found."""
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(300)]
    held = [(i, 20, rng_terms, [1] * len(rng_terms)) for i in range(500)
            for rng_terms in [sorted(rng.sample(range(30), 6))]]
    frequency = Counter(t for _, _, terms, _ in held for t in terms)
    items = lexical.Items([0], [list(range(12))], frequency)
    weights = [lexical.term_weight(500, frequency[t]) for t in range(30)]
    counts = spark.createDataFrame(held, "doc bigint, n bigint, terms array<int>, tfs array<bigint>").coalesce(1)
    batch = lexical.block_index(counts, weights, 500, 10000, items.pairs).toArrow().combine_chunks().to_batches()[0]
    block = lexical.Block(batch, 0, items)
    everything = dict(zip(*map(list, block.search(0, 1))))
    assert len(everything) > 400 and words
    for cutoff in sorted(everything.values())[::40]:
        rows, scores = block.search(0, int(cutoff))
        assert dict(zip(rows, scores)) == {r: s for r, s in everything.items() if s >= cutoff}
    # the joint maximum of a pair never exceeds the sum of the maxima of its terms, and is less somewhere
    alone = [sum(int(block.best[block.place[t]]) for t in p if t in block.place) for p in items.pairs]
    assert all(b <= a for a, b in zip(alone, block.pair_best))
    seeds, scores = block.seeds(0)
    assert all(everything[r] == s for r, s in zip(seeds, scores))


def test_sets_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "VOCABULARY", 20)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    docs, items = made(rng, 80, words, 25), made(rng, 12, words, 10)
    assert run(spark, docs, items) == brute(docs, items, 5)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "... ,"), (4, "Über ÜBER straße"), (5, "a\u0000b c"), (6, "alpha Beta beta"),
            (6, "alpha Beta beta"), (None, "alpha Beta beta"), (7, "alpha " * 30000 + "rare"), (8, "gamma"), (0, "BETA")]
    items = [(1, "beta RARE"), (2, None), (3, "--"), (4, "über gamma"), (4, "alpha"), (None, "rare"), (5, "absent")]
    assert run(spark, docs, items, 4) == brute(docs, items, 4)
    assert run(spark, docs, []) == []
    assert run(spark, [], items) == []
    assert run(spark, docs[:3], items) == []
