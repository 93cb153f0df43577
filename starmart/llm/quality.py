"""Ordinal quality classifier (operator 8).

A cumulative-link (proportional-odds) regression on graded ratings: one weight
vector over hashed text features is shared by all grades, ordered thresholds
t_1 < t_2 < ... cut its score, and P(grade >= k) = sigmoid(w.x - t_k).

Grades come from ``labels``: 0 poor quality, 1 fair but toxic, 2 good.  A
document is kept if its tail probability P(grade >= ``keep_grade``) reaches
``keep_from``.

Features, over the whole text: every distinct lower-cased word and every kind of
run of marks (such as ``!!``), each in a hash bucket; and stepped shares of runs of
marks, of upper-case words and of words that repeat the one before them.

Fitting uses at most ``sample`` labelled documents (those with the smallest id
hashes), the only bound here; scoring covers every document.  Only buckets whose
documents differ in mean grade from the sample by ``screen`` standard errors
get a weight; the others would only fit noise.

Defined results: null and empty texts are scored on the shares alone;
labels that are null or whose document is missing are left out; several labels
of a document all count; without usable labels, or with a single grade, all
documents get the top grade with probability 1; an empty table gives an empty
result; repeated rows are scored alike; extra columns are ignored (``score``) or
passed through (``select_good``).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

BUCKETS = 1 << 18
#: buckets from here on hold the shares
SHARES = BUCKETS - 64
_MARK = frozenset((*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)))
#: marks that stand singly in plain prose
_USUAL = frozenset((b".", b",", b";", b":", b"?", b"!", b"'", b'"', b"-", b"(", b")"))
#: only marks, or only capitals, are left; the rest become gaps
_ONLY_MARKS = bytes(c if c in _MARK else 32 for c in range(256))
_ONLY_CAPITALS = bytes(c if 65 <= c <= 90 else 32 for c in range(256))
#: lower case, marks become gaps
_PLAIN = bytes(32 if c in _MARK else c + 32 if 65 <= c <= 90 else c for c in range(256))


def _share(part: int, whole: int) -> int:
    """Share in steps: 0, up to 2 %, 10 %, 25 %, 50 %, more."""
    if not part:
        return 0
    x = part / whole
    return 1 + (x > 0.02) + (x > 0.1) + (x > 0.25) + (x > 0.5)


def features(text: bytes | None) -> np.ndarray:
    """The buckets of a text, distinct and sorted."""
    text = text or b""
    words = text.translate(_PLAIN).split()
    runs = [r for r in text.translate(_ONLY_MARKS).split() if r not in _USUAL]
    shouts = sum(len(w) > 2 for w in text.translate(_ONLY_CAPITALS).split())
    found = {zlib.crc32(w) % SHARES for w in set(words)}
    found.update(zlib.crc32(b"\x00" + m) % SHARES for m in {r[:3] for r in runs})
    counts = (len(runs), shouts, sum(map(bytes.__eq__, words, words[1:])))
    found.update(SHARES + 8 * i + _share(c, len(words) or 1) for i, c in enumerate(counts))
    found.add(SHARES + 8 * len(counts) + (0 if not words else 1 + (len(words) > 5)))
    return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass
class OrdinalModel:
    weights: np.ndarray      # one per bucket
    cuts: np.ndarray         # ordered thresholds, one less than grades

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..; one row per score."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.cuts[None, :], -40, 40)))


def _rows_dot(indptr, indices, weights):
    sums = np.concatenate([[0.0], np.cumsum(weights[indices])])
    return sums[indptr[1:]] - sums[indptr[:-1]]


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, screen: float = 3.5,
                l2: float = 1e-4, steps: int = 300, rate: float = 0.08) -> OrdinalModel:
    """Maximum likelihood by full-batch Adam; the gaps between cuts stay positive."""
    sizes = np.array([len(r) for r in rows])
    indices = np.concatenate(rows).astype(np.int64)
    indptr = np.concatenate([[0], np.cumsum(sizes)])
    which = np.repeat(np.arange(len(rows)), sizes)
    held = np.bincount(indices, minlength=BUCKETS)
    off = np.bincount(indices, weights=(grades - grades.mean())[which], minlength=BUCKETS)
    often = (held >= 4) & (np.abs(off) >= screen * grades.std() * np.sqrt(held))
    keep = often[indices]
    columns = np.flatnonzero(often)
    indices, which = np.searchsorted(columns, indices[keep]), which[keep]
    indptr = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(rows)))])
    width = len(columns)
    n, k = len(rows), n_grades - 1
    share = np.array([(grades >= g).mean() for g in range(1, n_grades)]).clip(1e-3, 1 - 1e-3)
    cuts = -np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(width), [cuts[0]], np.log(np.maximum(np.diff(cuts), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, gaps = theta[:width], np.exp(theta[width + 1:])
        cuts = theta[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = _rows_dot(indptr, indices, w)
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts[None, :], -40, 40)))
        tail = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
        up, low = tail[np.arange(n), grades], tail[np.arange(n), grades + 1]
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p      # of -log p: score and cuts
        d_score = -(d_up - d_low) / n
        d_cut = np.zeros(k)
        np.add.at(d_cut, np.maximum(grades - 1, 0), np.where(grades > 0, d_up / n, 0))
        np.add.at(d_cut, np.minimum(grades, k - 1), np.where(grades < k, -d_low / n, 0))
        grad = np.zeros_like(theta)
        grad[:width] = np.bincount(indices, weights=d_score[which], minlength=width) + l2 * w
        grad[width] = d_cut.sum()
        for j in range(1, k):
            grad[width + j] = d_cut[j:].sum() * gaps[j - 1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    cuts = theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1:]))])
    weights = np.zeros(BUCKETS)
    weights[columns] = theta[:width]
    return OrdinalModel(weights, cuts)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 poor, 1 fair but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("doc_id is not null and quality is not null").select("doc_id", grade.alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 16000, screen: float = 3.5) -> OrdinalModel:
    """Fit on at most ``sample`` labelled documents; the fit runs in one task on that bounded sample."""
    grades = graded(labels)
    n_grades = 3
    taken = (grades.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample))

    def extract(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([features(t).tolist() for t in utf8(batch.column(0))],
                                           pa.list_(pa.int32()))], names=["grade", "buckets"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("text", "grade")
            .mapInArrow(extract, "grade int, buckets array<int>"))

    def fit(batches):
        xs, ys = [], []
        for batch in batches:
            buckets = batch.column(1)
            ends = buckets.offsets.to_numpy()
            flat = buckets.values.to_numpy(zero_copy_only=False)
            xs += [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
            ys += batch.column(0).to_pylist()
        if len(set(ys)) > 1:
            # rows reach this task in any order; the sums of the fit shall not depend on it
            order = sorted(range(len(xs)), key=lambda i: (ys[i], xs[i].tobytes()))
            model = fit_ordinal([xs[i] for i in order], np.array([ys[i] for i in order]), n_grades, screen)
            yield pa.RecordBatch.from_pydict({"weights": [model.weights.astype(np.float32).tobytes()],
                                              "cuts": [model.cuts.tolist()]})

    found = rows.repartition(1).mapInArrow(fit, "weights binary, cuts array<double>").collect()
    if not found:
        return OrdinalModel(np.zeros(BUCKETS, np.float32), np.full(n_grades - 1, -40.0))
    return OrdinalModel(np.frombuffer(found[0]["weights"], np.float32), np.array(found[0]["cuts"]))


#: texts that are held as Python objects at once
TEXTS = 256


def _scored(model: OrdinalModel, texts: pa.Array) -> np.ndarray:
    score = np.fromiter((float(model.weights[features(t)].sum()) for i in range(0, len(texts), TEXTS)
                         for t in utf8(texts.slice(i, TEXTS))), float, len(texts))
    return model.tails(score)


def score(docs: DataFrame, model: OrdinalModel, keep_grade: int = 2, keep_from: float = 0.6) -> DataFrame:
    """doc_id, expected_grade, tail_probability (of ``keep_grade``), kept; one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats: a fixed size

    def run(batches):
        for batch in batches:
            tails = _scored(shared.value, batch.column(1))
            tail = tails[:, keep_grade - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1).round(6)), pa.array(tail.round(6)),
                 pa.array(tail >= keep_from)],
                names=["doc_id", "expected_grade", "tail_probability", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, expected_grade double, tail_probability double, kept boolean")


def select_good(docs: DataFrame, model: OrdinalModel, keep_grade: int = 2, keep_from: float = 0.6) -> DataFrame:
    """The documents that the classifier keeps, with all their columns; the texts alone go to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(_scored(shared.value, texts)[:, keep_grade - 1] >= keep_from)

    return docs.where(F.arrow_udf(run, "boolean")("text"))


def quality_grades(docs: DataFrame, labels: DataFrame, sample: int = 16000) -> DataFrame:
    """Train on ``labels`` and score all of ``docs``."""
    return score(docs, train(docs, labels, sample))
