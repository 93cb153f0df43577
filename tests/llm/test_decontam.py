import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm.decontam import Item, Settings, clean, latent_basis, lcs, matches, words_of
from starmart.llm.queries import op6_benchmark_decontamination

DOCS = "doc_id bigint, text string, item_id string"
BENCH = "item_id bigint, text string, doc_id int"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), min_size=1, max_size=30),
       st.lists(st.sampled_from([b"a", b"b", b"c", b"x"]), max_size=40))
def test_lcs(a, b):
    assert lcs(Item(0, a, a).masks(), len(a), b) == plain_lcs(a, b)


def brute(docs, items, s):
    """Every window start of every document against every item, without retrieval."""
    out = set()
    for d, text in docs:
        words = words_of((text or "").encode())
        for i, item in items:
            target = words_of((item or "").encode())
            if len(target) < s.min_words:
                continue
            masks, n = Item(0, target, []).masks(), len(target)
            tail = target[-(-3 * n // 4):]
            # windows are as wide as the item, about
            width = next((w for w in s.widths if n < 3 * w // 2), s.widths[-1])
            for start in range(0, max(1, len(words)), width // 2):
                around = words[max(0, start - n):start + max(width, s.window) + n]
                if sum(w in masks for w in around) < 0.6 * n:
                    continue
                share = lcs(masks, n, around) / n
                answer = lcs(Item(0, tail, []).masks(), len(tail), around) / len(tail)
                if share >= 0.8 or share >= 0.6 and answer >= 0.8:
                    out.add((d, i))
                    break
    return out


def test_query_against_brute_force(spark, sf_dir):
    s = Settings()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = op6_benchmark_decontamination(spark, sf_dir).collect()
    got, want = {(r.doc_id, r.item_id) for r in rows}, brute(docs, items, s)
    assert got <= want and len(rows) == len(got)
    assert got == want  # the latent search reaches every match
    # all verbatim leaks
    gram = {tuple(w[j:j + 12]): i for i, t in items for w in [words_of(t.encode())] for j in range(len(w) - 11)}
    leaks = {(d, gram[g]) for d, t in docs for w in [words_of(t.encode())] for j in range(len(w) - 11)
             if (g := tuple(w[j:j + 12])) in gram}
    assert leaks <= got


def planted(spark, sf_dir):
    rng = random.Random(4)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
            .where("doc_id < 400").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    own = brute(docs, items, Settings())
    base = [d for d in docs if d[0] not in {x for x, _ in own}][:60]
    rows, want = list(docs), set()
    for n, (i, text) in enumerate(items):
        words = text.split()
        new = [w if rng.random() > 0.1 else "swapped" for w in words]
        if n % 2:
            new = [w.upper() for w in new]
        host = base[n % len(base)][1].split()
        at = rng.randint(0, len(host))
        rows.append((100000 + n, " ".join(host[:at] + new + host[at:]), None))
        want.add((100000 + n, i))
    return [r[:2] for r in rows], items, want, own


def test_planted_paraphrases(spark, sf_dir):
    rows, items, want, own = planted(spark, sf_dir)
    docs = spark.createDataFrame([(d, t, None) for d, t in rows], DOCS)
    bench = spark.createDataFrame([(i, t, None) for i, t in items], BENCH)
    got = {(r.doc_id, r.item_id) for r in matches(docs, bench).collect()}
    assert len(want & got) >= 0.95 * len(want)
    kept = {r.doc_id for r in clean(docs, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in got}
    assert {d for d, _ in got} <= {d for d, _ in want | own}  # clean documents stay


def test_edge_cases(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    docs = [(1, None), (2, ""), (3, "x " * 70000 + item + " y" * 70000), (4, item.upper()), (4, item.upper()),
            (None, f"é {item}!"), (5, "alpha beta gamma"), (6, "none of these words")]
    frame = spark.createDataFrame([(d, t, "extra") for d, t in docs], DOCS)
    bench = spark.createDataFrame([(1, item, 7), (2, None, None), (3, "", None), (4, "too short", 1), (5, item, None),
                                   (None, "other text that no document holds at all", None)], BENCH)
    got = sorted(((r.doc_id, r.item_id) for r in matches(frame, bench).collect()), key=str)
    assert got == sorted([(d, i) for d in (3, 4, 4, None) for i in (1, 5)], key=str)
    assert sorted(r.doc_id for r in clean(frame, bench).collect()) == [1, 2, 5, 6]
    assert clean(frame, bench).columns == ["doc_id", "text", "item_id"]
    assert matches(frame.limit(0), bench).count() == 0
    # short items: a line of just these words, here
    lines = spark.createDataFrame([(1, "Too short!\nmore"), (2, "one is too short here"), (3, None), (4, "\n\nx\n too  SHORT"), (None, "yes")],
                                  "doc_id bigint, text string")
    short = spark.createDataFrame([(1, "too short"), (2, "yes"), (3, "..."), (4, item)], "item_id bigint, text string")
    got = sorted(((r.doc_id, r.item_id, r.first_word) for r in matches(lines, short).collect()), key=str)
    assert got == [(1, 1, 0), (4, 1, 1), (None, 2, 0)]
    assert sorted(r.doc_id for r in clean(lines, short).collect()) == [2, 3]
    assert matches(frame, bench.limit(0)).count() == 0 and clean(frame, bench.limit(0)).count() == len(docs)


def test_answer_column(spark):
    docs = spark.createDataFrame([(1, "one two three four five six q r s t paris"),
                                  (2, "one two three four five six q r s t london")]
                                 + [(9 + i, f"filler {i} text {i * i}") for i in range(300)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine", "paris")],
                                  "item_id bigint, text string, answer string")
    assert [r.doc_id for r in matches(docs, bench).collect()] == [1]


def test_latent_basis():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((500, 8)) @ rng.standard_normal((8, 60)) + 1e-3 * rng.standard_normal((500, 60))
    s = Settings(rank=8, oversample=8)
    test = np.random.default_rng(s.seed).standard_normal((60, 16)).astype(np.float32)
    basis = latent_basis(a.T @ (a @ test), s)
    right = np.linalg.svd(a, full_matrices=False)[2][:8].T
    assert basis.shape == (60, 8) and np.linalg.norm(right - basis @ (basis.T @ right)) < 1e-2


def filler(rng, n):
    return [f"f{rng.randint(0, 5000)}" for _ in range(n)]


def test_short_items_among_other_vocabulary(spark):
    """Verbatim short items between weighted words of other items."""
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(600)]
    items = [(i, " ".join(rng.sample(vocabulary, rng.choice([7, 9, 12, 40])))) for i in range(60)]
    rows, want = [(d, " ".join(filler(rng, 120) + rng.sample(vocabulary, 3))) for d in range(400)], set()
    for i, text in items:
        for k in range(3):
            around = [w if rng.random() < 0.5 else rng.choice(vocabulary) for w in filler(rng, 80)]
            at = rng.randint(0, len(around))
            rows.append((1000 + 3 * i + k, " ".join([*around[:at], text, *around[at:]])))
            want.add((1000 + 3 * i + k, i))
    docs = spark.createDataFrame([(d, t, None) for d, t in rows], DOCS)
    got = {(r.doc_id, r.item_id) for r in matches(docs, spark.createDataFrame([(i, t, 0) for i, t in items], BENCH)).collect()}
    assert want <= got and got == brute(rows, items, Settings())


def test_weighted_words_in_different_windows(spark):
    """A copy whose two weighted words stand in no common window, at every offset; frequent words carry no weight."""
    rng = random.Random(13)
    common = [f"c{i}" for i in range(40)]
    items = [(1, " ".join(["rareone", *common[:24], "raretwo", *common[24:30]])),
             (2, " ".join(["rarethree", "rarefour", *common[:20]]))]
    rows = [(d, " ".join(common + filler(rng, 60))) for d in range(500)]
    want = set()
    for at in range(16):
        rows.append((1000 + at, " ".join([*filler(rng, at), items[0][1], *filler(rng, 50)])))
        want.add((1000 + at, 1))
    docs = spark.createDataFrame([(d, t, None) for d, t in rows], DOCS)
    got = {(r.doc_id, r.item_id) for r in matches(docs, spark.createDataFrame([(i, t, 0) for i, t in items], BENCH)).collect()}
    assert want <= got


def test_items_of_frequent_words_leave_the_others_alone(spark):
    """An item without a rare word is searched apart: the cosines of the other items stay as they were."""
    rng = random.Random(21)
    common = [f"c{i}" for i in range(12)]
    rows = [(d, " ".join(common + filler(rng, 60))) for d in range(300)]
    items = [(1, " ".join(f"r{i}" for i in range(20))), (2, " ".join(f"s{i}" for i in range(30)))]
    rows += [(900 + i, " ".join([*filler(rng, 7 * i), t, *filler(rng, 40)])) for i, t in items]
    often = (3, " ".join(reversed(common)))
    rows.append((990, " ".join([*filler(rng, 30), often[1], *filler(rng, 30)])))
    docs = spark.createDataFrame([(d, t, None) for d, t in rows], DOCS)

    def found(some):
        return {(r.doc_id, r.item_id): r.cosine for r in matches(docs, spark.createDataFrame([(i, t, 0) for i, t in some], BENCH)).collect()}

    alone, both = found(items), found([*items, often])
    assert {(901, 1), (902, 2)} <= set(alone) and (990, 3) in both
    assert {k: v for k, v in both.items() if k[1] != 3} == alone
