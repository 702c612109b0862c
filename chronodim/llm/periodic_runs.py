"""Periodic runs of words: seed and extend along diagonals.

A run is a stretch of words with a smallest period ``q`` that is at least ``max(least, 2q)``
words long and that no neighbouring word extends.  On the diagonal of lag ``q`` (word ``t``
against word ``t + q``) it is a segment of equal words of at least ``max(least - q, q)``, the
overlap that is guaranteed.

* Lags are taken in classes: ``1..least``, then ``(least, 2 least]``, ``(2 least, 4 least]`` and
  so on.  The k-grams of a class are as long as its smallest guaranteed overlap (the first
  class) or half of it, so that a k-gram at a multiple of k lies in every segment.
* k-grams are indexed by rolling hash; a seed is joined to the occurrences of its k-gram in
  the same document whose lag is in the class.  That makes at most about ``2n`` pairs a class.
* Along each lag seeds go from left to right.  A table holds how far each lag is covered; a
  seed before that is passed over, any other is extended word by word in both directions.
* A seed inside a run of an earlier class whose period divides its lag is passed over as well:
  its segment is that run again.  Segments of a multiple of the period that remain have the
  run's start and end; the smallest lag of each start and end is the period.

Documents are independent: no shuffle.  A document of n words takes O(n log n) pairs.

Defined cases: a null, empty or blank text has no words and no runs; rows are taken one by
one, so null and repeated ids and equal rows change nothing; an empty table gives no rows;
other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

LEAST = 12                  # words of the shortest run
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
PAIRS = 1 << 20             # pairs, and compared words, held at once
RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _power(k: int) -> np.uint64:
    return np.uint64(pow(int(BASE), k, 1 << 64))


def _grams(codes: np.ndarray, k: int) -> np.ndarray:
    """Rolling hash of every k-gram, by doubling."""
    out, done = None, 0
    block, size = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), 1
    n = len(codes) - k + 1
    while True:
        if k >> (size.bit_length() - 1) & 1:
            out = block[:n] if out is None else out * _power(size) + block[done:done + n]
            done += size
        if done == k:
            return out
        block = block[:-size] * _power(size) + block[size:]
        size *= 2


def _extent(padded: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words are equal from ``a`` and ``b`` on, in the direction of ``step``."""
    far = np.zeros(len(a), np.int64)
    left, width, last = np.arange(len(a)), 32, len(padded) - 1
    while len(left):
        width = max(1, min(width, PAIRS // len(left)))
        at = step * (far[left][:, None] + np.arange(width))
        differ = (padded[np.clip(a[left][:, None] + at, 0, last)] != padded[np.clip(b[left][:, None] + at, 0, last)])
        ends = differ.any(axis=1)
        far[left] += np.where(ends, differ.argmax(axis=1), width)
        left, width = left[~ends], min(4096, 2 * width)
    return far


def _segments(padded: np.ndarray, seeds: np.ndarray, lags: np.ndarray, covered: np.ndarray, low: int) -> list[np.ndarray]:
    """Extend the pairs (seed, seed + lag).  ``covered``: for each lag of the class, the place
    up to which its segments are known.  Rows: start, end, lag of a segment."""
    n = len(padded)
    key = np.sort(lags * n + seeds)
    lag, first = np.unique(key // n, return_index=True)
    stop = np.append(first[1:], len(key))
    found = []
    while len(lag):
        # the furthest-covered table passes over the seeds of segments that are known
        at = np.searchsorted(key, lag * n + covered[lag - low - 1])
        go = at < stop
        lag, stop, at = lag[go], stop[go], at[go]
        if not len(lag):
            break
        i = key[at] - lag * n
        right = _extent(padded, i + 1, i + lag + 1, 1)
        left = _extent(padded, i, i + lag, -1)
        covered[lag - low - 1] = np.maximum(i + right, i + 1)
        hit = right > 0
        found.append(np.stack([i - left, i + right, lag])[:, hit])
    return found


def _unexplained(seeds: np.ndarray, lags: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Pairs (seeds ascending) that do not lie in a known run whose period divides their lag."""
    keep = np.ones(len(seeds), bool)
    starts, ends = np.searchsorted(seeds, runs[0]), np.searchsorted(seeds, runs[1])
    for lo, hi, end, period in zip(starts.tolist(), ends.tolist(), runs[1].tolist(), runs[2].tolist()):
        if lo < hi:
            keep[lo:hi] &= (lags[lo:hi] % period != 0) | (seeds[lo:hi] + lags[lo:hi] >= end)
    return keep


def runs_of(codes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Runs of a sequence of codes (>= 0) as rows (start, length, period), by start, then period."""
    n = len(codes)
    runs = np.zeros((3, 0), np.int64)              # start, end, period
    padded = np.concatenate([[-2], codes, [-1]])
    low, high = 0, least
    while n >= least and low < n // 2:
        k = (least + 1) // 2 if low == 0 else (low + 1) // 2
        h = _grams(codes, k)
        order = np.argsort(h, kind="stable")
        new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
        if new.all():
            break                                  # no k-gram twice: no longer one either
        rank = np.empty(len(h), np.int64)
        rank[order] = np.cumsum(new) - 1
        index = rank[order] * (n + 1) + order
        seeds = np.arange(0, len(h), 1 if low == 0 else k)
        seeds = seeds[np.bincount(rank)[rank[seeds]] > 1]
        lo = np.searchsorted(index, rank[seeds] * (n + 1) + np.minimum(seeds + low + 1, n))
        hi = np.searchsorted(index, rank[seeds] * (n + 1) + np.minimum(seeds + high, n), side="right")
        total = np.cumsum(hi - lo)
        covered = np.zeros(high - low, np.int64)
        found, at = [], 0
        while at < len(seeds):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
            count = hi[at:end] - lo[at:end]
            before = np.cumsum(count) - count
            i = np.repeat(seeds[at:end], count)
            j = order[np.repeat(lo[at:end] - before, count) + np.arange(len(i))]
            keep = _unexplained(i, j - i, runs)
            found += _segments(padded, i[keep], (j - i)[keep], covered, low)
            at = end
        if found:
            start, stop, lag = np.concatenate(found, axis=1)
            good = stop - start >= np.maximum(least - lag, lag)
            runs = np.concatenate([runs, np.stack([start, stop + lag, lag])[:, good]], axis=1)
            runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
            same = (runs[0, 1:] == runs[0, :-1]) & (runs[1, 1:] == runs[1, :-1])
            runs = runs[:, np.concatenate([[True], ~same])[:runs.shape[1]]]
        low, high = high, 2 * high
    start, end, period = runs
    out = np.stack([start, end - start, period], axis=1)
    return out[np.lexsort((period, start))]


def collapsed(w: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(w)
    depth = np.zeros(len(w) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(depth[:-1]) == 0
    return b" ".join([x for x, k in zip(w, keep.tolist()) if k])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, the runs of the text's words, and the text with each run cut to one period."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, offsets, parts, texts = [], [0], [], []
            for text in b.column(1):
                w = text.as_buffer().to_pybytes().split() if text.is_valid else []
                code: dict[bytes, int] = {}
                runs = runs_of(np.fromiter((code.setdefault(x, len(code)) for x in w), np.int64, len(w)), least)
                counts.append(len(w))
                offsets.append(offsets[-1] + len(runs))
                parts.append(runs)
                texts.append(collapsed(w, runs))
            rows = np.concatenate([np.zeros((0, 3), np.int64), *parts])
            struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, c])) for c in range(3)],
                                                ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct),
                 pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, RESULT)


def planted(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text in which, for a tenth of the ids, the words from some place on repeat with a
    period; rows without an id stay as they are."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)
    w = words(F.col(text))
    return F.when((h % 10 == 0) & F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.array_join(_repeating(w, g), " ")).otherwise(F.col(text))


def _repeating(w: Column, g: Column) -> Column:
    def edit(x: Column) -> Column:
        n = F.size(x).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.transform(x, lambda word, i: F.when(i < a, word).otherwise(F.get(x, (a + (i - a) % p).cast("int"))))
    return F.element_at(F.transform(F.array(w), edit), 1)      # a one-element array binds the words to a name


def run_digests(rows: DataFrame) -> DataFrame:
    """Per document: the number of runs, its longest run, and digests of its runs and of the collapsed text."""
    # the longest; of these the one that starts first, then the shortest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                               (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    r = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                    F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"),
                           256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return r.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
                    F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
