"""Periodic runs of words by string synchronising sets (operator 12).

A run is a stretch of words with smallest period q (words q apart are equal) and a length of at
least max(24, 3 q) that no neighbouring word extends.  Documents are worked on in
groups of some hundred thousand words, laid out one after the other, with a word of its own behind each.

* Highly periodic regions: runs with a period up to ``SMALL`` (8) are found apart, by comparing the words with
  themselves at each of these distances.
* Dyadic scales: periods in [a, c) for (a, c) = (8, 12), (12, 16), (16, 24), (24, 32) and so on.  The context of a
  position is its next c words, known by a hash built by doubling.  A position belongs to the
  synchronising set if its context has the least hash among some 2a - c + 1 positions in a row, so
  the choice depends on nothing but the words there, and equal stretches choose equal places.
* Each chosen position and the next one with an equal context propose their distance as a
  period, if it is in the range.  In a run of period q in [a, c) and length 3 q or more, the position chosen
  among the first 2a - c + 1 ones is chosen again q words later, both contexts lie in the run, and
  no nearer one is equal, as a context of q words or more tells the rotations of the period apart.
* Every proposal is extended word by word to both sides; stretches long enough are runs.  One
  with a smaller period has been found at an earlier scale.

Words are compared by numbers given to them, so hashes decide nothing but where to look.

Defined results: a null or empty text has no words and no run; a text is processed whole and needs memory
in proportion to its words; of runs with equal exponent the first, then the one with the smaller period
counts; repeated rows and null ids are documents of their own; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import count
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL = 8
LEAST = 24
EXPONENT = 3
#: words of one group of documents, about
GROUP = 300_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of every element."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0xBF58476D1CE4E5B9)


def joined(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """Hash of the stretches of ``a`` followed by those of ``b`` that begin ``shift`` later."""
    n = max(0, len(b) - shift)
    return mixed(a[:n] * np.uint64(0xD6E8FEB86659FD93) + b[shift:shift + n])


def sliding(x: np.ndarray, width: int, fn) -> np.ndarray:
    """fn over every ``width`` neighbouring elements."""
    have = 1
    while have * 2 <= width:
        x = fn(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return fn(x[:len(x) - rest], x[rest:]) if rest else x


def synchronising(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions with the least hash of some ``width`` positions in a row."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    least = sliding(hashes, width, np.minimum)
    edge = np.zeros(width - 1, hashes.dtype)
    highest = sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(highest == hashes)


def proposals(hashes: np.ndarray, chosen: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of chosen positions to the next one with an equal context, in [low, high)."""
    order = chosen[np.argsort(hashes[chosen], kind="stable")]
    same = hashes[order[1:]] == hashes[order[:-1]]
    distance = (order[1:] - order[:-1])[same]
    at = order[:-1][same]
    fits = (distance >= low) & (distance < high)
    return at[fits], distance[fits]


def matching(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How far the words from ``at`` on, in direction ``step``, equal those ``period`` later."""
    found, width = 0, 64
    while True:
        if step > 0:
            a = words[at + found:at + found + width]
            b = words[at + found + period:at + found + period + width]
            a = a[:len(b)]
        else:
            end = at - found + 1
            a = words[max(0, end - width):max(0, end)][::-1]
            b = words[max(0, end - width) + period:max(0, end) + period][::-1]
        if not len(a):
            return found
        differs = np.flatnonzero(a != b)
        if len(differs):
            return found + int(differs[0])
        found, width = found + len(a), width * 4


def small_periods(words: np.ndarray, found: dict) -> None:
    for q in range(1, min(SMALL, len(words) - 1) + 1):
        equal = np.concatenate([[False], words[:-q] == words[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        start, end = edges[::2], edges[1::2] + q
        for s, e in zip(start[end - start >= LEAST].tolist(), end[end - start >= LEAST].tolist()):
            found.setdefault((s, e), q)


def find_runs(words: np.ndarray, sizes: np.ndarray) -> dict[tuple[int, int], int]:
    """{(start, end): period} of all runs in documents laid out by decreasing size.

    ``sizes`` counts the word that ends each document, which stands nowhere else.
    """
    found: dict[tuple[int, int], int] = {}
    small_periods(words, found)
    ends, longest = np.cumsum(sizes), int(sizes[0]) if len(sizes) else 0
    hashes, a, width = mixed(words.astype(np.uint64) + np.uint64(1)), SMALL, 1
    while EXPONENT * a < longest:
        # only documents that can hold a run of this scale; ``hashes`` is of stretches of ``width`` words
        n = int(ends[np.searchsorted(-sizes, -EXPONENT * a, "left") - 1])
        text = words[:n]
        hashes = hashes[:n]
        half = hashes
        while width < a:
            half, hashes, width = hashes, joined(hashes, hashes, width), width * 2
        for low, high, context in ((a, a + a // 2, joined(hashes, half, a)), (a + a // 2, 2 * a, joined(hashes, hashes, a))):
            at, distance = proposals(context, synchronising(context, 2 * low - high + 1), low, high)
            order = np.lexsort((at, distance))
            done, period = 0, 0
            for i, q in zip(at[order].tolist(), distance[order].tolist()):
                if q == period and i < done:
                    continue  # in the stretch looked at before
                s = i + 1 - matching(text, i, q, -1)
                e = i + q + matching(text, i, q, 1)
                period, done = q, max(i + 1, e - q)
                if e - s >= max(LEAST, EXPONENT * q):
                    found.setdefault((s, e), q)
        a *= 2
    return found


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, given as words, by start, then period."""
    order = sorted((i for i, t in enumerate(texts) if len(t) >= LEAST), key=lambda i: -len(texts[i]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not order:
        return out
    numbers: dict[bytes, int] = {}
    fresh, laid = count(), []
    for place, i in enumerate(order):
        laid.append(np.fromiter(map(numbers.setdefault, texts[i], fresh), np.int64, len(texts[i])))
        laid.append(np.array([-1 - place], np.int64))
    sizes = np.array([len(texts[i]) + 1 for i in order])
    begin = np.cumsum(sizes) - sizes
    for (s, e), q in sorted(find_runs(np.concatenate(laid), sizes).items()):
        place = int(np.searchsorted(begin, s, "right")) - 1
        out[order[place]].append((s - int(begin[place]), e - s, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        drop[s + q] += 1
        drop[s + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  prepare: Callable[[Any, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, runs array<struct<start, length, period>>, collapsed) for every document.

    ``prepare`` (id, words) gives the words to look at, where they aren't those of the text.
    """
    run_type = "array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           *T.StructType.fromDDL(f"runs {run_type}, collapsed string").fields])
    fields = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def group(ids, texts):
        runs = runs_of(texts)
        named = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
        text = pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.binary())
        return pa.RecordBatch.from_arrays([ids, pa.array(named, fields), text.cast(pa.string())],
                                          names=["id", "runs", "collapsed"])

    def run(batches):
        for batch in batches:
            ids, raw = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            at, texts, size = 0, [], 0
            for i, doc_id in enumerate(ids):
                words = (raw[i].as_py() or b"").split()
                texts.append(prepare(doc_id, words) if prepare else words)
                size += len(words)
                if size >= GROUP or i + 1 == len(ids):
                    yield group(batch.column(0).slice(at, i + 1 - at), texts)
                    at, texts, size = i + 1, [], 0

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """For every tenth hash of an id, the words from some place on repeated with a period (null ids: as they are)."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * (1 + (n - a) // p))[:n - a]


def run_digests(docs: DataFrame) -> DataFrame:
    """One row a document: number of runs, the one of the highest exponent, digests of runs and of what is kept."""
    found = periodic_runs(docs, prepare=planted)
    better = lambda a, b: ((a["length"] * b["period"] > b["length"] * a["period"])
                           | ((a["length"] * b["period"] == b["length"] * a["period"])
                              & (F.struct(b["start"], b["period"]) > F.struct(a["start"], a["period"]))))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda top, r: F.when(better(r, top), r).otherwise(top))
    best = F.when(F.size("runs") > 0, best)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("b"), "runs", "collapsed").select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period",
        F.expr("1000 * b.length div b.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
