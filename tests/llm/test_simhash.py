import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm.queries import op10_simhash_near_dedup
from starmart.llm.simhash import allocate, fingerprint, links, simhash_components

SCHEMA = "doc_id bigint, text string, fp string"


def brute_print(text, shingle=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    """prints: [(id, fp)] -> {(id, fp): smallest id}"""
    fps = sorted({f for _, f in prints})
    arr = np.array(fps, dtype=np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= distance):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    at = {f: find(i) for i, f in enumerate(fps)}
    least = {}
    for d, f in prints:
        if d is not None:
            least[at[f]] = min(least.get(at[f], d), d)
    return {(d, f): least.get(at[f]) for d, f in prints}


def check(rows, docs):
    prints = [(d, brute_print(t)) for d, t in docs]
    want = brute_components(prints)
    got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows), key=str)
    assert got == sorted(((d, f, want[d, f]) for d, f in prints), key=str)


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(op10_simhash_near_dedup(spark, sf_dir).collect(), docs)


def test_edge_cases(spark):
    docs = [(1, None, "x"), (2, "", "x"), (3, " \t\n\x0b\x0c\r", None), (4, "One two", "y"), (5, "one TWO", None),
            (6, "É é a b c d", "z"), (6, "É é a b c d", "z"), (7, "word " * 50000, None), (None, "one two", None),
            (8, "a b c", None)]
    rows = simhash_components(spark.createDataFrame(docs, SCHEMA)).collect()
    check(rows, [d[:2] for d in docs])
    assert simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_crowded_blocks_lose_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 12, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:  # dense clouds around a few centres, and random ones
        for _ in range(150):
            x = int(b)
            for bit in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(bit)
            fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 2 ** 63, 300, dtype=np.uint64)}
    signed = [(f - 2 ** 64 if f >= 2 ** 63 else f) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    for distance, parts, most in ((2, 3, 64), (2, 3, 8), (2, 4, 4), (3, 3, 64), (3, 2, 2), (1, 2, 16)):
        edges = [tuple(r) for r in links(df, distance, parts, most).collect()]
        u = [(a % 2 ** 64, b % 2 ** 64) for a, b in edges]
        assert all((a ^ b).bit_count() <= distance for a, b in u)
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in u:
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        want = brute_components([(f, f) for f in fps], distance)
        assert {f: find(f) for f in fps} == {f: want[f, f] for f in fps}, (distance, parts, most)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("abAZé \t\n  "), max_size=60))
def test_fingerprint(text):
    assert fingerprint(text.encode(), 3) == brute_print(text)


def test_allocation_spends_all_units():
    sizes = np.array([[1, 500, 400], [3, 3, 3], [1000, 1000, 1000]], float)
    spent, cost = allocate(sizes, [22, 21, 21], 1000, 2)
    assert (spent.sum(axis=1) == 3).all() and spent[0, 0] >= 2 and list(spent[1]) == [1, 1, 1]
    assert cost[2] > cost[0]
