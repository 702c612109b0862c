"""Quality scores by regularised quadratic discriminant analysis.

Every text becomes a short vector of statistics (lengths, repetition, case, marks, symbols,
lines, compressibility), brought to comparable scale: logarithms of counts, arcsine square
roots of shares.  Each class gets a mean and a covariance shrunk towards the pooled one and
towards a multiple of the identity; the sums behind them are added up on the executors over
all labelled rows.  A score compares the classes' log-densities: Mahalanobis distances come
from the Cholesky factors, computed once and kept with the model.  A logistic curve, fitted on
at most ``CALIBRATION_ROWS`` labelled rows, turns the difference into a probability.

Defined cases: a null text counts as empty and gets a score like any other; labels that are
null, or of unknown documents, are left out, and of several labels of an id the largest
counts; a class without rows gives every document the other class's probability (0.5 without
any label); repeated rows and null ids are scored one by one; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hashed_sample, written

SHRINK_POOLED = 0.2
SHRINK_IDENTITY = 0.02
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.7

_NOISY = re.compile(rb"[!?#*$%&|<>~^=@+]{2,}(?=\s|$)")
_GROUPS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
           "sentence": b".,;:", "loud": b"!?", "symbol": b"#$%&*|<>=~^@\\/{}[]_+`"}
FEATURES = ("log_words", "log_word_bytes", "distinct_words", "same_as_before", "top_word", "upper", "digits",
            "sentence_marks", "loud_marks", "symbols", "noisy_words", "bare_marks", "not_ascii", "log_words_a_line",
            "repeated_lines", "byte_entropy", "compressed", "ended_lines")


def _byte_groups() -> np.ndarray:
    out = np.zeros((256, len(_GROUPS) + 1))
    for k, members in enumerate(_GROUPS.values()):
        out[list(members), k] = 1
    out[128:, -1] = 1
    return out


_MEMBERS = _byte_groups()


def _share(part: float, whole: float) -> float:
    return math.asin(math.sqrt(min(1.0, part / whole))) if whole > 0 else 0.0


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of FEATURES."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    w = raw.split()
    n, size = len(w), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digit, sentence, loud, symbol, high = (counts[:, None] * _MEMBERS).sum(axis=0).tolist()
    used = counts[counts > 0] / size
    seen = Counter(w)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    bare = sum(c for x, c in seen.items() if len(x) <= 3 and not x.isalnum() and not any(b > 127 or chr(b).isalnum() for b in x))
    return [math.log1p(n), math.log1p(sum(map(len, w)) / n), _share(len(seen), n), _share(sum(map(eq, w, w[1:])), n),
            _share(max(seen.values()), n), _share(upper, upper + lower), _share(digit, size), _share(sentence, size),
            _share(loud, size), _share(symbol, size), _share(len(_NOISY.findall(raw)), n), _share(bare, n),
            _share(high, size), math.log(n / len(lines)), _share(len(lines) - len(set(lines)), len(lines)),
            float(-(used * np.log2(used)).sum()), math.log(min(1.5, len(zlib.compress(raw, 1)) / size)),
            _share(sum(x.rstrip()[-1:] in b".!?" for x in lines), len(lines))]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x, the array of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    """Class means, Cholesky factors' inverses, log-determinants and priors; the calibration."""

    means: np.ndarray
    whiten: np.ndarray          # inverse of each Cholesky factor
    log_det: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0."""
        out = []
        for k in range(2):
            z = ((x - self.means[k])[:, None, :] * self.whiten[k][None]).sum(axis=2)
            out.append(-0.5 * (z * z).sum(axis=1) - 0.5 * self.log_det[k])
        return out[1] - out[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.arcsinh(self.difference(x)) + self.offset, -500, 500)))


def class_sums(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Rows, sums and sums of products by class, added up on the executors."""
    p = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + p + p * p))
        for b in batches:
            x = np.array(b.column(0).to_pylist(), float).reshape(-1, p)
            y = b.column(1).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                z = x[y == k]
                total[k] += np.concatenate([[len(z)], z.sum(axis=0), np.einsum("ij,ik->jk", z, z).ravel()])
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "v"])

    sums = np.zeros(2 * (1 + p + p * p))
    for r in labelled.select("x", "y").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        sums[r["at"]] = r["v"]
    sums = sums.reshape(2, -1)
    return {k: (sums[k, 0], sums[k, 1:1 + p], sums[k, 1 + p:].reshape(p, p)) for k in (0, 1)}


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, lightly held to slope 0."""
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((y - p) * z).sum() - 1e-3 * a, (y - p).sum()])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.array([h[1, 1] * g[0] - h[0, 1] * g[1], h[0, 0] * g[1] - h[1, 0] * g[0]]) / (h[0, 0] * h[1, 1] - h[0, 1] ** 2)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -3, 3))
        if abs(step).max() < 1e-6:
            break
    return max(a, 0.0), b


def _cholesky(s: np.ndarray) -> np.ndarray:
    out = np.zeros_like(s)
    for j in range(len(s)):
        out[j, j] = math.sqrt(max(s[j, j] - (out[j, :j] ** 2).sum(), 1e-12))
        out[j + 1:, j] = (s[j + 1:, j] - (out[j + 1:, :j] * out[j, :j]).sum(axis=1)) / out[j, j]
    return out


def _inverse_of_lower(a: np.ndarray) -> np.ndarray:
    out = np.zeros_like(a)
    for i in range(len(a)):
        out[i] = -(a[i, :i, None] * out[:i]).sum(axis=0)
        out[i, i] += 1
        out[i] /= a[i, i]
    return out


def fit(labelled: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """``labelled``: a written table of x and y (0 or 1), with a key ``doc_id``."""
    p = len(FEATURES)
    sums = class_sums(labelled)
    n = np.array([sums[0][0], sums[1][0]])
    if not n.all():
        zero = np.zeros((2, p))
        return Model(zero, np.zeros((2, p, p)), np.zeros(2), constant=0.5 if not n.any() else float(n[1] > 0))
    means = np.stack([sums[k][1] / n[k] for k in (0, 1)])
    scatter = [sums[k][2] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / n.sum()
    scale = np.trace(pooled) / p
    factors, dets = [], []
    for k in (0, 1):
        s = (1 - SHRINK_POOLED) * scatter[k] / n[k] + SHRINK_POOLED * pooled
        s = (1 - SHRINK_IDENTITY) * s + SHRINK_IDENTITY * scale * np.eye(p)
        factor = _cholesky(s)
        factors.append(_inverse_of_lower(factor))
        dets.append(2 * float(np.log(np.diag(factor)).sum()))
    model = Model(means, np.stack(factors), np.array(dets))
    some = hashed_sample(labelled, calibration_rows, "doc_id", "x").select("x", "y").collect()
    x, y = np.array([r["x"] for r in some], float).reshape(-1, p), np.array([r["y"] for r in some], float)
    model.slope, model.offset = _logistic(np.arcsinh(model.difference(x)), y)
    return model


def scores(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score."""
    shipped = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(1).to_pylist(), float).reshape(-1, len(FEATURES))
            parts = [shipped.value.probability(x[s:s + 4096]) for s in range(0, len(x), 4096)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(parts + [np.zeros(0)]))], ["doc_id", "score"])

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality") -> DataFrame:
    """doc_id and score of every document; learns from labels (doc_id, ``label``) where
    ``train`` (a condition on doc_id) holds."""
    stats = written(document_statistics(docs), "statistics")
    y = labels.where(train & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)) \
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    labelled = written(stats.join(y, "doc_id"), "labelled")
    return scores(stats, fit(labelled))
