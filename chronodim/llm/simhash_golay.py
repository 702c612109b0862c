"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints are made text by text; equal ones become one row before anything is joined,
so a group of copies of any size is one row.  A 64-bit fingerprint is cut into three
segments (22, 21 and 21 bits).  With at most 4 differing bits, the two segments with the
fewest differ in at most 2 bits each, so in both they share a Golay key: for each of the
three pairs of segments every combination of the two segments' keys is a bucket.  Rows of
a bucket are compared bit by bit, and links that keep the bucket connected are returned (a
spanning forest, never all pairs).  Buckets beyond ``BUCKET_ROWS`` are dealt out again as
pairs of chunks, each compared in a task of its own.

Defined cases: a null, empty or blank text has fingerprint zero and is linked like any
other; equal rows and ids share the component; a null id is never a component id unless
all its members are null; an empty table gives no rows; other columns aren't read, and
``survivors`` passes them through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import golay
from .common import as_struct, from_struct, in_batches, row_digest, written
from .components import components

SHINGLE = 4
MAX_BITS = 4
HASH_SEED = 42
SEGMENTS = (22, 21, 21)     # from the lowest bit
BUCKET_ROWS = 50_000        # rows of a bucket compared in one task
SMALL = 48                  # buckets up to this size are compared by shifted arrays
BLOCK_SHINGLES = 50_000


def fingerprints(texts: list[str | None], shingle: int = SHINGLE, seed: int = HASH_SEED) -> np.ndarray:
    """SimHash of each text as unsigned 64-bit: A-Z in lower case, words between ASCII
    white space, shingles joined by a space; a bit is set if it is in over half the hashes."""
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    hashes: list[int] = []
    first: list[int] = []
    rows: list[int] = []

    def flush() -> None:
        if not rows:
            return
        h = np.array(hashes, dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        n = np.diff([*first, len(h)])
        over = (2 * ones > n[:, None]).astype(np.uint8)
        packed = np.packbits(over, axis=1, bitorder="little").copy().view("<u8").ravel()
        # a text of more than a block's shingles is a block of its own, so each row is whole here
        out[rows] = packed
        hashes.clear(), first.clear(), rows.clear()

    for i, text in enumerate(texts):
        w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not w:
            continue
        rows.append(i)
        first.append(len(hashes))
        line = b" ".join(w)
        if len(w) <= shingle:
            hashes.append(digest(line, seed))
        else:
            ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            hashes.extend([digest(line[a:b], seed) for a, b in zip(starts[:len(w) - shingle + 1].tolist(),
                                                                   ends[shingle - 1:].tolist())])
        if len(hashes) >= BLOCK_SHINGLES:
            flush()
    flush()
    return out


def fingerprinted(docs: DataFrame, shingle: int = SHINGLE, seed: int = HASH_SEED, digest: Column | None = None) -> DataFrame:
    """doc_id (as long), the fingerprint as a signed long, and ``digest`` (binary) where it is given."""
    names = ["doc_id", "fp"] + ([] if digest is None else ["digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints(b.column(1).to_pylist(), shingle, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *([] if digest is None else [digest.alias("digest")])) \
               .mapInArrow(in_batches(run), "doc_id long, fp long" + ("" if digest is None else ", digest binary"))


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of fingerprints (signed longs): keys, and the row that each belongs to."""
    u = fps.view(np.uint64)
    parts, shift = [], 0
    for width in SEGMENTS:
        seg = ((u >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        parts.append(golay.keys(seg, width))
        shift += width
    keys, rows = [], []
    for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        a, b = parts[i][:, :, None], parts[j][:, None, :]
        k = np.where((a >= 0) & (b >= 0), (p << 24) | (a << 12) | b, -1).reshape(len(fps), -1)
        r, c = np.nonzero(k >= 0)
        keys.append(k[r, c])
        rows.append(r)
    return np.concatenate(keys), np.concatenate(rows)


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of links that join two trees."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    keep = []
    for n, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        if (x := root(x)) != (y := root(y)):
            up[x] = y
            keep.append(n)
    return keep


def _one_bucket(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Breadth first: each reached row is compared with the rows not reached yet."""
    rest = fps.view(np.uint64)
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                got, rest = rest[near], rest[~near]
                yield np.full(len(got), x, np.uint64).view(np.int64), got.view(np.int64)
                queue.extend(got)


def bucket_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole buckets (rows sorted by key, each fingerprint once in a bucket) that
    leave every bucket as connected as all its links would."""
    starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1, [len(keys)]])
    sizes = np.diff(starts)
    out_a, out_b = [], []
    left = np.repeat(starts[1:], sizes) - np.arange(len(keys)) - 1   # later rows of the same bucket
    small = np.repeat(sizes <= SMALL, sizes)
    at = np.nonzero(small & (left >= 1))[0]
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    found_a, found_b, found_in = [], [], []
    for lag in range(1, SMALL):
        at = at[left[at] >= lag]
        if not len(at):
            break
        near = at[np.bitwise_count((fps[at] ^ fps[at + lag]).view(np.uint64)) <= max_bits]
        found_a.append(fps[near])
        found_b.append(fps[near + lag])
        found_in.append(bucket[near])
    if found_a:
        a, b, c = np.concatenate(found_a), np.concatenate(found_b), np.concatenate(found_in)
        many = np.bincount(c, minlength=len(sizes)) >= 3            # links may close a ring
        out_a.append(a[~many[c]])
        out_b.append(b[~many[c]])
        a, b, c = a[many[c]], b[many[c]], c[many[c]]
        order = np.argsort(c, kind="stable")
        a, b, c = a[order], b[order], c[order]
        cuts = np.concatenate([[0], np.nonzero(c[1:] != c[:-1])[0] + 1, [len(c)]]) if len(c) else [0]
        for s, e in zip(cuts[:-1], cuts[1:]):
            keep = _forest(a[s:e], b[s:e])
            out_a.append(a[s:e][keep])
            out_b.append(b[s:e][keep])
    for g in np.nonzero(sizes > SMALL)[0]:
        for a, b in _one_bucket(fps[starts[g]:starts[g + 1]], max_bits):
            out_a.append(a)
            out_b.append(b)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(out_a + none), np.concatenate(out_b + none)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("over", pa.bool_())])


def _linker(n_keys: int, max_bits: int, bucket_rows: int):
    """Reads rows sorted by the key columns and fp; buckets beyond ``bucket_rows`` are passed
    on as (key, fp, over) while they stream by."""

    def batch(a, b, over: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), over))], schema=_LINKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids, held_key, held_fp, over = None, np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for rb in batches:
            cols = [rb.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys + 1)]
            if not len(cols[0]):
                continue
            # the bucket's ordinal replaces composite keys, the first column names it
            new = np.zeros(len(cols[0]), bool)
            for c in cols[:n_keys]:
                new[1:] |= c[1:] != c[:-1]
            last = tuple(int(c[-1]) for c in cols[:n_keys])
            first = tuple(int(c[0]) for c in cols[:n_keys])
            ordinal = np.cumsum(new) + (0 if first == held_ids else 1)
            key, fp, name = ordinal, cols[-1], cols[0]
            if over is not None:
                same = int((ordinal == 0).sum()) if first == held_ids else 0
                if same:
                    yield batch(name[:same], fp[:same], True)
                if same == len(fp):
                    continue
                key, fp, over, held_fp, held_key = key[same:], fp[same:], None, held_fp[:0], held_key[:0]
            key = np.concatenate([np.zeros(len(held_fp), np.int64), key])
            fp = np.concatenate([held_fp, fp])
            end = int(np.searchsorted(key, key[-1]))          # the last bucket may go on
            if end:
                a, b = bucket_links(key[:end], fp[:end], max_bits)
                if len(a):
                    yield batch(a, b, False)
            held_ids, held_fp = last, fp[end:]
            held_key = np.zeros(len(held_fp), np.int64)
            if len(held_fp) > bucket_rows:
                yield batch(np.full(len(held_fp), last[0], np.int64), held_fp, True)
                over, held_fp, held_key = last, held_fp[:0], held_key[:0]
        if len(held_fp):
            a, b = bucket_links(held_key, held_fp, max_bits)
            if len(a):
                yield batch(a, b, False)

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at most ``max_bits`` apart."""
    if max_bits > 4:
        raise ValueError("three segments with keys for 2 bits each reach 4 differing bits")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            key, row = bucket_keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], ["key", "fp"])

    rows = fps.select("fp").mapInArrow(in_batches(spread), "key long, fp long")
    sorted_rows = rows.repartition("key").sortWithinPartitions("key", "fp")
    found = written(sorted_rows.mapInArrow(_linker(1, max_bits, bucket_rows), "a long, b long, over boolean"), "links")
    links = found.where("not over").select("a", "b")
    hot = found.where("over").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if hot.isEmpty():
        return links.distinct()
    # the exact way for large buckets: every pair of chunks of a bucket meets in one task
    half = max(1, bucket_rows // 2)
    n = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / half).cast("int").alias("n"))
    chunk = hot.join(n, "key").withColumn("c", F.pmod(F.xxhash64("fp"), "n").cast("int"))
    meet = chunk.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1))) \
        .select("key", F.least("c", "o").alias("lo"), F.greatest("c", "o").alias("hi"), "fp")
    meet = meet.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "fp")
    more = meet.mapInArrow(_linker(3, max_bits, 1 << 62), "a long, b long, over boolean").select("a", "b")
    return written(links.unionByName(more).distinct(), "all-links")


def component_roots(distinct: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """``distinct`` (one row per ``fp``) with ``root``, one fingerprint of each component."""
    roots = components(fingerprint_links(distinct, max_bits, bucket_rows))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id that links reach)."""
    d = written(fingerprinted(docs, shingle), "fingerprints")
    distinct = d.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    distinct = written(distinct, "distinct-fingerprints")
    named = component_roots(distinct, max_bits, bucket_rows)
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(named.join(least, "root").select("fp", "component_id"), "components")
    return d.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
              bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with one row of each component: smallest doc_id (null last), then row digest.

    Rows are told apart by their digest and not by the id, so ids may be null or repeated."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    distinct = fingerprinted(docs, shingle, digest=row_digest(docs)).groupBy("fp").agg(F.min(order).alias("first"))
    distinct = written(distinct, "distinct-fingerprints")
    keep = component_roots(distinct, max_bits, bucket_rows).groupBy("root").agg(F.min("first").alias("first")) \
        .select("first.doc_id", "first.digest").alias("k")
    d = docs.select(F.col("doc_id").cast("long").alias("id"), row_digest(docs).alias("digest"), as_struct(docs.columns))
    d = d.join(keep, F.col("id").eqNullSafe(F.col("k.doc_id")) & d["digest"].eqNullSafe(F.col("k.digest")), "left_semi")
    return d.dropDuplicates(["id", "digest"]).select(*from_struct(docs.columns, {}))
