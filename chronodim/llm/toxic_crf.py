"""Toxic spans by a linear-chain conditional random field.

Labels are given for documents; words get labels first: a word of a toxic document is
toxic if the word or one of its prefixes occurs far more often in toxic documents than in
others; those counts run on the executors over all labelled documents.  The field has two
states; a word's features (itself, prefixes, a suffix) are hashed
to weights, and transitions tie neighbours together.  It is fitted by gradient steps on a
sample of labelled documents, ``MAX_TOXIC`` and ``MAX_CLEAN`` at most, in the order of a
hash, one text an id and ``SAMPLE_BYTES`` of each label at most (documents that no longer
fit are left out of the sample).  Scoring runs forward-backward over every word of every text: the recursions are
fractional linear maps, so many texts are scanned at once in pieces.  A document's score is
the calibrated chance that any word is toxic; words with a marginal of a half or more are the
offending spans.

Defined cases: a null, empty or blank text has no words and gets the score of a text
without toxic words; null labels are left out, of several labels of an id the largest counts;
without toxic labels every score is 0; repeated rows and null ids are scored one by one; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.partitioning import checked_broadcast
from .common import written
from .quality_rqda import _logistic
from .tokens import blocks

MAX_TOXIC, MAX_CLEAN = 2_500, 7_500
FIT_TOXIC, FIT_CLEAN = 1_500, 1_500     # of those, documents for the gradient steps
SAMPLE_BYTES = 64 << 20                 # texts of either label in the sample
TABLE = 1 << 18
PREFIXES = (4, 5, 6)
LEAST_DOCUMENTS = 5                     # labelled toxic documents with a word or prefix
LEAST_RATIO = 20.0                      # of its shares in toxic and other documents
STEPS = 60
PIECE = 256
CACHE_WORDS = 400_000
STEP_WORDS = 300_000                    # words of a gradient's part, of one document at least
THRESHOLD = 0.5
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def core(word: str) -> str:
    """The word in lower case without marks around it."""
    w = word.lower()
    return w if w.isalnum() else _EDGE.sub("", w)


def stems(c: str) -> list[str]:
    """A core and its prefixes, as they are counted in documents."""
    return [c] + [c[:k] + "*" for k in PREFIXES if len(c) > k]


def features(c: str) -> list[int]:
    """Places of a core's weights."""
    names = stems(c) + ["*" + c[-3:], f"#{min(len(c), 12)}"]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % TABLE for x in names]


def scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x[t] = (a[t] x[t-1] + b[t]) / (c[t] x[t-1] + d[t]) for all t, from x[-1] = 1, in pieces:
    the maps of a piece are composed, pieces are chained, then all pieces run side by side."""
    n = len(a)
    rows = -(-n // PIECE)

    def split(v: np.ndarray, fill: float) -> np.ndarray:
        return np.concatenate([v, np.full(rows * PIECE - n, fill)]).reshape(rows, PIECE).T.copy()

    a, b, c, d = split(a, 1.0), split(b, 0.0), split(c, 0.0), split(d, 1.0)
    p, q, r, s = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(PIECE):
        p, q, r, s = a[t] * p + b[t] * r, a[t] * q + b[t] * s, c[t] * p + d[t] * r, c[t] * q + d[t] * s
        if t % 4 == 3:
            top = 1 / np.maximum(np.maximum(p, q), np.maximum(r, s))
            p, q, r, s = p * top, q * top, r * top, s * top
    first, x = np.empty(rows), 1.0
    for k, (w, y, u, v) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        first[k] = x
        x = min(max((w * x + y) / max(u * x + v, 1e-300), 1e-30), 1e30)
    out, x = np.empty((PIECE, rows)), first
    for t in range(PIECE):
        x = np.clip((a[t] * x + b[t]) / (c[t] * x + d[t]), 1e-30, 1e30)
        out[t] = x
    return out.T.ravel()[:n]


@dataclass
class Field:
    """Weights by feature, a bias, transitions (from, to) and the calibration; state 1 is toxic."""

    weights: np.ndarray
    bias: float = -4.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 1.0
    offset: float = 0.0

    def forward_backward(self, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Odds of state 1 from the words up to each word, and from those after it; ``e``: log
        odds by word, ``first``: marks where documents begin."""
        x, m = np.exp(np.clip(e, -30, 30)), np.exp(self.trans)
        zero, one = np.zeros(len(x)), np.ones(len(x))
        alpha = scan(np.where(first, zero, x * m[1, 1]), np.where(first, x, x * m[0, 1]),
                     np.where(first, zero, m[1, 0]), np.where(first, one, m[0, 0]))
        last = np.append(first[1:], True)
        nxt = np.append(x[1:], 1.0)
        beta = scan(*(v[::-1] for v in (np.where(last, zero, m[1, 1] * nxt), np.where(last, one, m[1, 0]),
                                        np.where(last, zero, m[0, 1] * nxt), np.where(last, one, m[0, 0]))))[::-1]
        return alpha, beta

    def marginals(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        alpha, beta = self.forward_backward(e, first)
        odds = alpha * beta
        return odds / (1 + odds)

    def emission(self, c: str) -> float:
        return float(self.weights[features(c)].sum()) + self.bias if c else self.bias

    def score(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -500, 500)))


def any_toxic(p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """By document: log odds that some word is toxic, from the words' marginals; between -10 and 10."""
    total = np.concatenate([[0.0], np.cumsum(-np.log1p(-np.minimum(p, 1 - 1e-9)))])
    none = np.diff(total[offsets])
    return np.clip(np.log(np.expm1(np.clip(none, 1e-12, 30))), -10, 10)


def split_words(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def fit_documents(labels: list[int]) -> list[int]:
    """Places of the sample's documents that the gradient steps use: the first of each label."""
    places = {0: [], 1: []}
    for i, label in enumerate(labels):
        places[label].append(i)
    return sorted(places[1][:FIT_TOXIC] + places[0][:FIT_CLEAN])


class Sample:
    """Documents as places of their words' cores, and their labels; texts are not kept."""

    def __init__(self, texts: Iterable[str | None], labels: list[int]):
        ids: dict[str, int] = {}
        self.docs = [np.array([ids.setdefault(core(w), len(ids)) for w in split_words(t)], dtype=np.int32) for t in texts]
        self.cores, self.labels = list(ids), labels


def candidates(sample: Sample) -> list[str]:
    """Cores and prefixes in the toxic documents of the gradient steps: only they can be marked there."""
    used = {c for i in fit_documents(sample.labels) if sample.labels[i] for c in np.unique(sample.docs[i]).tolist()}
    return sorted({s for c in used if sample.cores[c] for s in stems(sample.cores[c])})


class StemCounter:
    """How many documents hold each candidate, by label; the last place counts the documents."""

    def __init__(self, names: list[str]):
        self.place = {s: i for i, s in enumerate(names)}
        self.counts = np.zeros((2, len(names) + 1), np.int64)
        self.cache: dict[str, list[int]] = {}

    def of_word(self, w: str) -> list[int]:
        found = self.cache.get(w)
        if found is None:
            if len(self.cache) > CACHE_WORDS:
                self.cache = {}
            c = core(w)
            found = self.cache[w] = [self.place[s] for s in stems(c) if s in self.place] if c else []
        return found

    def add(self, texts: pa.Array, y: np.ndarray) -> None:
        n, start = self.counts.shape[1], 0
        self.counts[:, -1] += np.bincount(y, minlength=2)
        for block in blocks(texts):
            offsets, coded = words_of(block)
            label, start = y[start:start + len(block)], start + len(block)
            if not len(coded):
                continue
            lists = [self.of_word(w) for w in coded.dictionary.to_pylist()]
            width = max(len(lists), 1)
            pair = np.unique(np.repeat(np.arange(len(block)), np.diff(offsets)) * width + np.asarray(coded.indices))
            doc, word = pair // width, pair % width
            size = np.array([len(x) for x in lists])
            begin = np.cumsum(size) - size
            flat = np.array([p for x in lists for p in x], dtype=np.int64)
            many = size[word]
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            held = np.unique(np.repeat(doc, many) * n + flat[np.repeat(begin[word], many) + inside])
            for k in (0, 1):
                self.counts[k] += np.bincount(held[label[held // n] == k] % n, minlength=n)

    def rows(self) -> pa.RecordBatch:
        at = np.nonzero(self.counts.any(axis=0))[0]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (at, self.counts[0, at], self.counts[1, at])],
                                          ["place", "clean", "toxic"])


def marked(names: list[str], clean: np.ndarray, toxic: np.ndarray) -> set[str]:
    """Candidates that mark toxic documents; the last place of the counts holds the documents."""
    good = (toxic[:-1] >= LEAST_DOCUMENTS) & \
        (toxic[:-1] / max(toxic[-1], 1) >= LEAST_RATIO * (clean[:-1] + 0.5) / max(clean[-1], 1))
    return {names[i] for i in np.nonzero(good)[0]}


def marked_stems(labelled: DataFrame, names: list[str]) -> set[str]:
    """``marked`` by counts over all rows of ``labelled`` (text, y): tasks add up their documents,
    and at most one row per candidate reaches the driver."""
    shipped = labelled.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = StemCounter(shipped.value)
        for b in batches:
            counter.add(b.column(0), np.asarray(b.column(1)))
        yield counter.rows()

    rows = labelled.select("text", "y").mapInArrow(run, "place long, clean long, toxic long") \
                   .groupBy("place").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    counts = np.zeros((2, len(names) + 1), np.int64)
    counts[:, np.asarray(rows["place"])] = np.asarray(rows["clean"]), np.asarray(rows["toxic"])
    return marked(names, *counts)


def parts(docs: list[np.ndarray], chosen: list[int]) -> Iterator[list[int]]:
    """Neighbouring documents of about ``STEP_WORDS`` words together."""
    part, words = [], 0
    for i in chosen:
        if part and words + len(docs[i]) > STEP_WORDS:
            yield part
            part, words = [], 0
        part.append(i)
        words += len(docs[i])
    if part:
        yield part


def fit(sample: Sample, marks: set[str]) -> Field | None:
    """Fit on the sample; words with a core or prefix in ``marks`` are the toxic ones of a toxic
    document; None if no document is toxic.  A step's gradient is the sum over parts of the documents, so that its
    arrays stay small however many words the sample has."""
    docs, cores, y = sample.docs, sample.cores, np.array(sample.labels, dtype=np.int64)
    if not y.any():
        return None
    hot = np.array([any(s in marks for s in stems(c)) if c else False for c in cores], dtype=bool)
    chosen = [i for i in fit_documents(sample.labels) if len(docs[i])]
    if not chosen:
        return None
    used = np.unique(np.concatenate([np.unique(docs[i]) for i in chosen]))
    lists = [features(cores[i]) if cores[i] else [] for i in used.tolist()]
    of_word = np.repeat(np.arange(len(used)), [len(x) for x in lists])
    flat = np.array([f for x in lists for f in x], dtype=np.int64)
    del lists
    m = Field(np.zeros(TABLE))
    pairs = np.zeros((2, 2))
    split = []
    for part in parts(docs, chosen):
        word = np.concatenate([docs[i] for i in part])
        size = np.array([len(docs[i]) for i in part])
        first = np.zeros(len(word), bool)
        first[np.cumsum(size) - size] = True
        target = hot[word] & np.repeat(y[part] == 1, size)
        inside = np.nonzero(~first)[0]
        np.add.at(pairs, (target[inside - 1].astype(int), target[inside].astype(int)), 1)
        split.append((np.searchsorted(used, word).astype(np.int32), first, target))
    square_w, square_t, square_b = np.full(TABLE, 1e-4), np.full((2, 2), 1e-4), 1e-4
    for _ in range(STEPS):
        by_word = np.bincount(of_word, m.weights[flat], minlength=len(used)) + m.bias
        miss, joined, t = np.zeros(len(used)), np.zeros(4), np.exp(m.trans)
        for word, first, target in split:
            e = by_word[word]
            alpha, beta = m.forward_backward(e, first)
            p = alpha * beta / (1 + alpha * beta)
            miss += np.bincount(word, target - p, minlength=len(used))
            inside = np.nonzero(~first)[0]
            before, after = alpha[inside - 1], np.exp(np.clip(e[inside], -30, 30)) * beta[inside]
            joint = np.stack([np.full(len(inside), t[0, 0]), t[0, 1] * after, t[1, 0] * before, t[1, 1] * before * after])
            joined += (joint / joint.sum(axis=0)).sum(axis=1)
        grad = np.bincount(flat, miss[of_word], minlength=TABLE) - 0.05 * m.weights
        grad_t = pairs - joined.reshape(2, 2) - 0.05 * m.trans
        grad_b = float(miss.sum())
        square_w += grad * grad
        square_t += grad_t * grad_t
        square_b += grad_b * grad_b
        m.weights += 0.5 * grad / np.sqrt(square_w)
        m.trans += 0.1 * grad_t / np.sqrt(square_t)
        m.bias += 0.5 * grad_b / np.sqrt(square_b)
    m.weights[np.bincount(flat, minlength=TABLE) == 0] = 0.0
    raw, truth = [], []
    by_core = np.array([m.emission(c) for c in cores], float)
    for part in parts(docs, list(range(len(docs)))):    # calibration: all documents of the sample
        length = np.array([len(docs[i]) for i in part])
        truth += y[part].tolist()
        if not length.sum():
            raw += [-10.0] * len(part)
            continue
        w = np.concatenate([docs[i] for i in part])
        begin = np.zeros(len(w), bool)
        begin[(np.cumsum(length) - length)[length > 0]] = True
        raw += any_toxic(m.marginals(by_core[w], begin), np.concatenate([[0], np.cumsum(length)])).tolist()
    m.slope, m.offset = _logistic(np.array(raw), np.array(truth, float))
    return m


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The words of one text after the other, coded, and where each text's begin."""
    runs = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    offsets = np.asarray(runs.offsets).astype(np.int64)
    flat = runs.flatten()
    keep = np.asarray(pc.greater(pc.binary_length(flat), 0)) if len(flat) else np.zeros(0, bool)
    return np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]], pc.dictionary_encode(flat.filter(pa.array(keep, pa.bool_())))


class Tagger:
    """Marginals of every word of many texts; emissions are cached per worker task."""

    def __init__(self, model: Field):
        self.model, self.cache = model, {}

    def emissions(self, distinct: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        out = []
        for w in distinct:
            e = self.cache.get(w)
            if e is None:
                e = self.cache[w] = self.model.emission(core(w))
            out.append(e)
        return np.array(out, float)

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each block of texts: marginals of all words, and where each text's begin."""
        for block in blocks(texts):
            offsets, coded = words_of(block)
            if not len(coded):
                yield np.zeros(0), offsets
                continue
            e = self.emissions(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
            first = np.zeros(len(e), bool)
            first[offsets[:-1][np.diff(offsets) > 0]] = True
            yield self.model.marginals(e, first), offsets


def toxic_spans(text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Runs of neighbouring words with marginals of ``least`` or more, in code points."""
    out: list[dict] = []
    before = -2
    for i, m in enumerate(_WORD.finditer(text)):
        if p[i] >= least:
            if before == i - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            before = i
    return out


def within(rows: list, most: int) -> list[int]:
    """Ids, in the order of their hash, of texts that fit into ``most`` bytes together; rows: (hash, id, bytes)."""
    out = []
    for _, i, n in sorted(rows):
        if n <= most:
            out.append(i)
            most -= n
    return out


def labelled_sample(d: DataFrame, y: DataFrame, max_toxic: int, max_clean: int) -> Sample:
    """A bounded sample of ``d`` (id, text), in the order of a hash of the id;
    of rows that repeat an id the least text counts."""
    order = [F.xxhash64("id"), "id"]
    ids = y.where("y = 1").orderBy(*order).limit(max_toxic).unionByName(y.where("y = 0").orderBy(*order).limit(max_clean))
    # max_toxic + max_clean ids at most
    rows = d.join(F.broadcast(ids), "id").groupBy("id", "y").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
    rows = written(rows.select("id", "y", "text", F.octet_length("text").alias("n"), F.xxhash64("id").alias("h")), "toxic_sample")
    sizes = rows.select("h", "id", "n", "y").collect()
    kept = [i for k in (0, 1) for i in within([r[:3] for r in sizes if r[3] == k], SAMPLE_BYTES)]
    got = rows.where(F.col("id").isin(kept)) if len(kept) < len(sizes) else rows
    sample = got.select("id", "y", "text").toArrow()
    order = pc.sort_indices(sample.select(["y", "id"]), [("y", "descending"), ("id", "ascending")])
    at = order.to_pylist()
    return Sample((sample["text"][i].as_py() for i in at), sample["y"].take(order).to_pylist())


def toxicity(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic",
             max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """doc_id, score and spans of every document; learns from labels (doc_id, ``label``)
    where ``train`` (a condition on doc_id) holds."""
    y = labels.where(train & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)) \
              .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).cast("int").alias("y"))
    d = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    y = written(y, "toxic_labels")
    sample, model = labelled_sample(d, y, max_toxic, max_clean), None
    if any(sample.labels):
        # labels are broadcast up to the library's bound of measured bytes; beyond it the texts are shuffled once
        model = fit(sample, marked_stems(d.join(checked_broadcast(y)[0], "id"), candidates(sample)))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shipped.value) if shipped.value is not None else None
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            if tagger is None:
                score, spans = np.zeros(b.num_rows), [[]] * b.num_rows
            else:
                texts, parts, spans = b.column(1), [], []
                for p, offsets in tagger(texts):
                    parts.append(tagger.model.score(any_toxic(p, offsets)))
                    high = np.concatenate([[0], np.cumsum(p >= 0.5)])[offsets]
                    for i in range(len(offsets) - 1):
                        hit = high[i + 1] > high[i]
                        spans.append(toxic_spans(texts[len(spans)].as_py(), p[offsets[i]:offsets[i + 1]]) if hit else [])
                score = np.concatenate(parts + [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array(spans, span)], ["doc_id", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, "doc_id long, score double, spans array<struct<start:int,end:int>>")
