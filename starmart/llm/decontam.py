"""Benchmark decontamination by latent semantic retrieval (operator 6).

1. Vocabulary: the words of the benchmark.  Every document is coded once, as the places and numbers of its
   vocabulary words.  The document frequencies are counted over all passages of the corpus (disjoint windows
   of ``window`` words); words in more than ``max_df`` of the passages carry no weight.  Items whose words are all
   frequent form a search of their own, in which these words do.
2. Randomised SVD of the TF-IDF matrix A (all passages x vocabulary): every task
   multiplies its rows by the same Gaussian test matrix W and returns its share of
   A'(A W); the shares are summed by Spark.  The Nystrom formula turns the sum into
   the leading right singular vectors, in one pass.
3. Search: overlapping windows of every document, as wide as the items (16, 32 or 64 words), and the items
   are projected and compared by cosine; all pairs from ``min_cosine`` on are candidates.
4. Check: the longest common subsequence of the item with the document around
   the window.  A match needs ``min_lcs`` of the item's words, or ``paraphrase_lcs``
   of them together with ``min_answer`` of the answer's (column ``answer``
   where the benchmark has one, else the last quarter of the item).

Items of under ``min_words`` words match a document with a line of exactly their words.

The benchmark is the query set.  It is worked off in blocks of about ``BLOCK_CHARS``
characters, so what is sent to the tasks has a fixed bound; documents are
never gathered.  Words: punctuation is a gap, case is folded.

Defined results: null and empty documents match nothing; null items and items without words match nothing; repeated
rows and ids are treated alike; equal items all match, and of windows that match equally well the first is
reported; texts are processed whole; an empty table gives an empty result; extra columns are ignored
(``matches``) or kept (``clean``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, partitions, utf8

BLOCK_CHARS = 1 << 19
#: words of documents that are worked on together
TOGETHER = 1 << 17
#: windows with a candidate that are looked at together
HITS = 1 << 15
#: words of the smallest piece of a window
UNIT = 8
#: terms of one shuffled piece of the sketch
PIECE = 64
_PLAIN = bytes(32 if c < 48 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 127
               else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    if not text:
        return []
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(_PLAIN).split()


@dataclass(frozen=True)
class Settings:
    window: int = 32
    rank: int = 128
    oversample: int = 16
    max_df: float = 0.01
    widths: tuple[int, ...] = (16, 32, 64)
    min_cosine: float = 0.45
    min_lcs: float = 0.8
    paraphrase_lcs: float = 0.6
    min_answer: float = 0.8
    min_words: int = 6
    seed: int = 42


@dataclass
class Item:
    item_id: int
    words: list
    answer: list

    def masks(self) -> dict:
        out: dict = {}
        for i, w in enumerate(self.words):
            out[w] = out.get(w, 0) | 1 << i
        return out

    def coded(self, index: dict[bytes, int]) -> "Item":
        """With numbers for words; a word of the answer that no item has gets one that no document has."""
        return Item(self.item_id, [index[w] for w in self.words], [index.get(w, -1) for w in self.answer])


def lcs(masks: dict, size: int, words: list) -> int:
    """Length of the longest common subsequence; one bit per word of the item."""
    full = (1 << size) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


@dataclass
class Coded:
    """Documents by their vocabulary words: document k has the entries at[k] to at[k + 1] of pos and term."""

    sizes: np.ndarray
    at: np.ndarray
    pos: np.ndarray
    term: np.ndarray

    def units(self, step: int, apart: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """(unit of each entry, first unit of each document, units): ``step`` words a unit, ``apart`` units between documents."""
        counts = -(-self.sizes // step) + apart
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return np.repeat(first[:-1], np.diff(self.at)) + self.pos // step, first, int(first[-1])


def code(lists: list[list[bytes]], index: dict[bytes, int]) -> Coded:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    get, pos, term = index.get, [], []
    for words in lists:
        ids = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        at = np.flatnonzero(ids >= 0)
        pos.append(at.astype(np.int32))
        term.append(ids[at])
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in pos])]).astype(np.int64)
    none = [np.zeros(0, np.int32)]
    return Coded(sizes, bounds, np.concatenate(pos + none), np.concatenate(term + none))


def _together(batches: Iterator[pa.RecordBatch], text_at: int):
    """Documents in groups of about TOGETHER words: (batch, first row, word lists)."""
    for batch in batches:
        first, lists, held = 0, [], 0
        for row, text in enumerate(utf8(batch.column(text_at))):
            words = words_of(text)
            lists.append(words)
            held += len(words)
            if held >= TOGETHER:
                yield batch, first, lists
                first, lists, held = row + 1, [], 0
        if lists:
            yield batch, first, lists


def coded_documents(docs: DataFrame, vocabulary: list[bytes], key: str | None = "doc_id") -> DataFrame:
    """(key, words, pos, term) of every document, written once."""
    index = {w: i for i, w in enumerate(vocabulary)}
    shared = docs.sparkSession.sparkContext.broadcast(index)
    cols = ([F.col(key).alias("key")] if key else [F.lit(0).alias("key")]) + ["text"]
    narrow = docs.select(*cols)

    def run(batches):
        for batch, first, lists in _together(batches, 1):
            c = code(lists, shared.value)
            bounds = pa.array(c.at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(lists)), pa.array(c.sizes, pa.int64()),
                 pa.ListArray.from_arrays(bounds, pa.array(c.pos)), pa.ListArray.from_arrays(bounds, pa.array(c.term))],
                names=["key", "words", "pos", "term"])

    kind = narrow.schema["key"].dataType.simpleString()
    return materialise(narrow.mapInArrow(run, f"key {kind}, words bigint, pos array<int>, term array<int>"), "coded")


def _groups(batches: Iterator[pa.RecordBatch]):
    """Coded documents in groups of about TOGETHER words: (keys, Coded)."""
    for batch in batches:
        sizes = batch.column(1).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TOGETHER, "right")))
            part = batch.slice(start, stop - start)
            pos, term = part.column(2), part.column(3)
            offsets = pos.offsets.to_numpy()
            yield part.column(0), Coded(sizes[start:stop], (offsets - offsets[0]).astype(np.int64),
                                        pos.flatten().to_numpy(zero_copy_only=False), term.flatten().to_numpy(zero_copy_only=False))
            start = stop


def _document_frequencies(coded: DataFrame, size: int, window: int) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and passages in all."""
    def run(batches):
        df, passages = np.zeros(size + 1, np.int64), 0
        for _, c in _groups(batches):
            unit, _, n = c.units(window)
            df[:size] += np.bincount(np.unique(unit * size + c.term) % size, minlength=size)
            passages += n
        df[size] = passages
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": at, "df": df[at]})

    out = np.zeros(size + 1, np.int64)
    for term, df in coded.mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out[:size], int(out[size])


def _rows(chunk, term, idf):
    """Unit TF-IDF rows of the chunks that hold terms: (row per entry, term, weight, rows)."""
    if not len(chunk):
        return chunk, term, np.zeros(0), 0
    size = len(idf)
    pair, count = np.unique(chunk * size + term, return_counts=True)
    term, chunk = pair % size, pair // size
    weight = count * idf[term]
    starts = np.flatnonzero(np.diff(chunk, prepend=-1))
    row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(chunk))))
    norm = np.sqrt(np.add.reduceat(weight ** 2, starts))
    return row, term, weight / norm[row], len(starts)


def _chunk_sums(term: np.ndarray, starts: np.ndarray, basis: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Sum of the (weighted) basis rows of each chunk's terms, and a last row of zeros; most chunks have one or two."""
    counts = np.diff(np.append(starts, len(term)))
    sums = np.zeros((len(starts) + 1, basis.shape[1]), basis.dtype)
    np.take(basis, term[starts], axis=0, out=sums[:-1])
    if weight is not None:
        sums[:-1] *= weight[starts, None]
    more, k = np.flatnonzero(counts > 1), 1
    while len(more):
        at = starts[more] + k
        sums[more] += basis[term[at]] if weight is None else basis[term[at]] * weight[at, None]
        k += 1
        more = more[counts[more] > k]
    return sums


def _project(row, term, weight, rows, basis):
    """Rows times ``basis`` (entries stand sorted by row)."""
    if not rows:
        return np.zeros((0, basis.shape[1]), basis.dtype)
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    return _chunk_sums(term, starts, basis, weight.astype(basis.dtype))[:-1]


def _sketch(coded: DataFrame, place: np.ndarray, idf: np.ndarray, s: Settings) -> np.ndarray:
    """A'(A W) over all passages of the corpus; ``place`` numbers the terms with a weight (-1: none).

    The number of tasks, and with it of shares of the sum, is that of the shuffle partitions at most.
    """
    size = len(idf)
    width = min(s.rank + s.oversample, size)
    shared = coded.sparkSession.sparkContext.broadcast((place, idf))
    pieces = -(-size // PIECE)

    def run(batches):
        place, idf = shared.value
        test = np.random.default_rng(s.seed).standard_normal((size, width)).astype(np.float32)
        total = np.zeros((size, width))
        for _, c in _groups(batches):
            unit, _, _ = c.units(s.window)
            weighted = place[c.term]
            some = weighted >= 0
            row, term, weight, rows = _rows(unit[some], weighted[some], idf)
            if not rows:
                continue
            y = _project(row, term, weight, rows, test)
            order = np.argsort(term, kind="stable")
            t = term[order]
            starts = np.flatnonzero(np.diff(t, prepend=-1))
            total[t[starts]] += np.add.reduceat(y[row[order]] * weight[order, None], starts, axis=0)
        yield pa.RecordBatch.from_pydict({
            "piece": list(range(pieces)),
            "sums": [total[i * PIECE:(i + 1) * PIECE].tobytes() for i in range(pieces)]})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(part)
                sums[piece] = sums[piece] + part if piece in sums else part
        yield pa.RecordBatch.from_pydict({"piece": pa.array(list(sums), pa.int64()),
                                          "sums": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    parts = (coded.coalesce(partitions(coded.sparkSession)).mapInArrow(run, "piece bigint, sums binary").repartition("piece")
             .mapInArrow(add, "piece bigint, sums binary").collect())  # weighted terms x width
    out = np.zeros((size, width))
    for p in parts:
        out[p["piece"] * PIECE:(p["piece"] + 1) * PIECE] = np.frombuffer(p["sums"]).reshape(-1, width)
    return out


def latent_basis(sketch: np.ndarray, s: Settings) -> np.ndarray:
    """Leading right singular vectors from B = G W, G = A'A: G is near B (W'B)^-1 B'."""
    size, width = sketch.shape
    test = np.random.default_rng(s.seed).standard_normal((size, width)).astype(np.float32).astype(float)
    shift = np.sqrt(size) * 1e-9 * max(np.linalg.norm(sketch), 1e-30)
    b = sketch + shift * test
    core = test.T @ b
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    keep = values > values.max() * 1e-12
    half = b @ (vectors[:, keep] / np.sqrt(values[keep]))
    left, _, _ = np.linalg.svd(half, full_matrices=False)
    return left[:, :s.rank]


class Search:
    """The projected items of one block, and the check of documents against them."""

    def __init__(self, items: list[Item], vocabulary: list[bytes], place: np.ndarray, idf: np.ndarray, basis: np.ndarray, s: Settings,
                 short: dict[tuple, list] | None = None):
        self.s, self.place = s, place
        self.short = short or {}
        self.index = {w: i for i, w in enumerate(vocabulary)}
        self.items = [i.coded(self.index) for i in items]
        self.basis = (basis * idf[:, None]).astype(np.float32)
        self.masks = [(i.masks(), Item(0, i.answer, []).masks()) for i in self.items]
        # items by the width of their windows: (width, vectors, item of each)
        self.classes = []
        sizes = self.sizes = np.array([len(i.words) for i in items], np.int64)
        # (item, word) pairs and how often the item has the word
        self.pairs, self.times = np.unique([k * len(vocabulary) + w for k, i in enumerate(self.items) for w in i.words] or [-1],
                                           return_counts=True)
        for n, width in enumerate(s.widths):
            low = 0 if n == 0 else 3 * s.widths[n - 1] // 2
            high = np.inf if n + 1 == len(s.widths) else 3 * width // 2
            vectors, owner = [], []
            for i in np.flatnonzero((sizes >= low) & (sizes < high)).tolist():
                words = self.items[i].words
                starts = [0] if len(words) < high and len(words) <= 3 * width // 2 else range(0, len(words) - width // 2, width // 2)
                for start in starts:
                    part = words if starts == [0] else words[start:start + width]
                    at = place[part]
                    v = self.basis[at[at >= 0]].sum(axis=0)
                    norm = float(np.sqrt(v @ v))
                    if norm > 1e-9:
                        vectors.append(v / norm)
                        owner.append(i)
            if vectors:
                self.classes.append((width, np.array(vectors, np.float32), np.array(owner)))

    def find(self, c: Coded):
        """(document, item, cosine, share of the item, share of the answer, first word) of every match."""
        best: dict[tuple[int, int], dict[int, tuple[float, int]]] = {}
        weighted = self.place[c.term]
        some = weighted >= 0
        if not some.any() or not self.classes:
            return
        apart = max(self.s.widths) // UNIT - 1  # so that no window meets two documents
        unit, first, n = c.units(UNIT, apart)
        unit, term = unit[some], weighted[some]
        full = np.flatnonzero(np.diff(unit, prepend=-1))
        level = np.zeros((n + 1, self.basis.shape[1]), np.float32)
        level[unit[full]] = _chunk_sums(term, full, self.basis)[:-1]
        width, step = UNIT, 1  # rows of ``level``: windows of ``width`` words that begin ``step`` units apart
        for wide, vectors, owner in self.classes:
            while width < wide:
                half = width // (UNIT * step)
                level = (level[:-half] + level[half:])
                if width > UNIT:
                    level, step = level[::2], step * 2
                width *= 2
            norm = np.sqrt(np.einsum("ij,ij->i", level, level))
            rows = np.flatnonzero(norm > 1e-9)
            doc_of = np.searchsorted(first, rows * step + width // UNIT - 1, "right") - 1
            for at in range(0, len(rows), 4096):
                some_rows = rows[at:at + 4096]
                near = (level[some_rows] @ vectors.T) / norm[some_rows, None]
                hit, q = np.nonzero(near >= self.s.min_cosine)
                for part in range(0, len(hit), HITS):
                    h, owned = hit[part:part + HITS], owner[q[part:part + HITS]]
                    doc = doc_of[at + h]
                    start = np.maximum((some_rows[h] * step - first[doc]) * UNIT, 0)
                    able = np.flatnonzero(self._able(c, doc, owned, start, width))
                    cosine = near[h[able], q[part:part + HITS][able]]
                    for d, i, cos, word in zip(doc[able].tolist(), owned[able].tolist(), cosine.tolist(), start[able].tolist()):
                        seen = best.setdefault((d, i), {})
                        if word not in seen or seen[word][0] < cos:
                            seen[word] = cos, width
        for (doc, item), seen in sorted(best.items()):
            low, high = c.at[doc], c.at[doc + 1]
            found, cosine = None, max(cos for cos, _ in seen.values())
            pos, terms = c.pos[low:high], c.term[low:high]
            for start in sorted(seen):
                hit = self._check(pos, terms, item, start, seen[start][1])
                if hit and (found is None or hit > found[:2]):
                    found = (*hit, start)
            if found:
                yield doc, item, cosine, *found

    def _able(self, c: Coded, doc, item, start, width) -> np.ndarray:
        """Whether enough words of the item stand around a window: a bound of their common subsequence."""
        far = int(c.sizes.max(initial=0)) + 2 * int(self.sizes.max(initial=0)) + max(width, self.s.window) + 1
        line = np.repeat(np.arange(len(c.sizes)), np.diff(c.at)) * far + c.pos
        size = self.sizes[item]
        low = np.searchsorted(line, doc * far + np.maximum(start - size, 0))
        high = np.searchsorted(line, doc * far + np.minimum(start + max(width, self.s.window) + size, far - 1))
        many = high - low
        entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        hit = np.repeat(np.arange(len(doc)), many)
        key = item[hit] * len(self.index) + c.term[entry]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        held = self.pairs[at] == key
        once = np.unique(hit[held] * len(self.pairs) + at[held])
        count = np.bincount(once // len(self.pairs), self.times[once % len(self.pairs)], len(doc))
        return count >= self.s.paraphrase_lcs * size

    def _check(self, pos, terms, item, start, width):
        words, answer, masks = self.items[item].words, self.items[item].answer, self.masks[item]
        size = len(words)
        low, high = np.searchsorted(pos, [start - size, start + max(width, self.s.window) + size])
        around = terms[low:high].tolist()
        share = lcs(masks[0], size, around) / size
        if share < self.s.paraphrase_lcs:
            return None
        answered = lcs(masks[1], len(answer), around) / len(answer)
        if share >= self.s.min_lcs or answered >= self.s.min_answer:
            return share, answered
        return None

    def lines(self, text: bytes | None):
        """(item id, first word) of the short items that are a line of a text."""
        if not self.short or not text:
            return
        seen, word = set(), 0
        for line in text.split(b"\n"):
            words = words_of(line)
            for i in self.short.get(tuple(words), ()):
                if i not in seen:
                    seen.add(i)
                    yield i, word
            word += len(words)


def _blocks(bench: DataFrame, s: Settings) -> Iterator[tuple[list[Item], dict[tuple, list]]]:
    """The benchmark in blocks of bounded size: (items, ids of short items by their words)."""
    if "answer" not in bench.columns:
        bench = bench.withColumn("answer", F.lit(None).cast("string"))
    bench = bench.select("item_id", "text", "answer").where("text is not null")
    chars = bench.agg(F.sum(F.length("text") + F.coalesce(F.length("answer"), F.lit(0)))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    for k in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        items, short = [], {}
        for r in rows:
            words = words_of(r["text"].encode())
            if len(words) >= s.min_words:
                answer = words_of((r["answer"] or "").encode()) or words[-(-3 * len(words) // 4):]
                items.append(Item(r["item_id"], words, answer))
            elif words:
                short.setdefault(tuple(words), []).append(r["item_id"])
        if items or short:
            yield items, short


def searches(docs: DataFrame, bench: DataFrame, s: Settings, key: str | None = None) -> Iterator[tuple[Search, DataFrame]]:
    """(fitted search, coded documents) for each block of the benchmark."""
    for items, short in _blocks(bench, s):
        vocabulary = sorted({w for i in items for w in [*i.words, *i.answer]})
        coded = coded_documents(docs, vocabulary, key)
        df, passages = _document_frequencies(coded, len(vocabulary), s.window)
        rare = df <= s.max_df * passages
        number = {w: k for k, w in enumerate(vocabulary)}
        has_rare = [bool(rare[[number[w] for w in i.words]].any()) for i in items]
        kinds = [([i for i, h in zip(items, has_rare) if h], rare)]
        frequent = [i for i, h in zip(items, has_rare) if not h]
        if frequent:
            theirs = np.zeros(len(vocabulary), bool)
            theirs[[number[w] for i in frequent for w in i.words]] = True
            kinds.append((frequent, theirs))
        for n, (some, weighted) in enumerate(kinds):
            place = np.full(max(1, len(vocabulary)), -1)
            place[np.flatnonzero(weighted)] = np.arange(weighted.sum())
            idf = np.log((1 + passages) / (1 + df[weighted])) + 1e-3
            basis = latent_basis(_sketch(coded, place, idf, s), s) if some else np.zeros((len(idf), 1))
            yield Search(some, vocabulary, place, idf, basis, s, short if n == 0 else None), coded


def matches(docs: DataFrame, bench: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, cosine, item_share, answer_share, first_word of every match."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = bench.schema["item_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, item_id {item_kind}, cosine double, item_share double, answer_share double, "
              "first_word bigint")
    out = docs.sparkSession.createDataFrame([], schema)
    names = ["doc_id", "item_id", "cosine", "item_share", "answer_share", "first_word"]

    def rows(keys, found):
        at, item, cosine, share, answer, start = zip(*found)
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(at)), pa.array(item, pa.int64()), pa.array(np.round(cosine, 4)), pa.array(np.round(share, 4)),
             pa.array(np.round(answer, 4)), pa.array(start, pa.int64())], names=names)

    for search, coded in searches(docs, bench, s, "doc_id"):
        shared = docs.sparkSession.sparkContext.broadcast(search)

        def run(batches, shared=shared):
            items = shared.value.items
            for keys, c in _groups(batches):
                found = [(d, items[i].item_id, *rest) for d, i, *rest in shared.value.find(c)]
                if found:
                    yield rows(keys, found)

        def short(batches, shared=shared):
            for batch in batches:
                found = [(d, i, 1.0, 1.0, 1.0, at) for d, t in enumerate(utf8(batch.column(1))) for i, at in shared.value.lines(t)]
                if found:
                    yield rows(batch.column(0), found)

        out = out.unionAll(coded.mapInArrow(run, schema))
        if search.short:
            out = out.unionAll(docs.select("doc_id", "text").mapInArrow(short, schema))
    return out


def clean(docs: DataFrame, bench: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents without a match, with all their columns."""
    kept = docs
    for search, _ in searches(docs, bench, s):
        shared = docs.sparkSession.sparkContext.broadcast(search)
        text_at = docs.columns.index("text")

        def run(batches, shared=shared):
            for batch, first, lists in _together(batches, text_at):
                search = shared.value
                hit = {d for d, *_ in search.find(code(lists, search.index))}
                part = batch.slice(first, len(lists))
                if search.short:
                    hit |= {d for d, t in enumerate(utf8(part.column(text_at))) if any(search.lines(t))}
                yield part.filter(pa.array([d not in hit for d in range(len(lists))]))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
