"""Packing documents into training sequences by cutting-stock column generation.

A document's ids (with the end id) are cut into pieces of the sequence length and one
rest.  Rests are counted by length class (rounded up to ``UNIT`` ids; shorter than ``SHORT``:
exact lengths, taken in bundles): that histogram goes to the driver, whose size is bounded
by the sequence length.  There column generation finds patterns of classes, used a whole
number of times.  Rests are ranked within their class (cells of a hash are counted and
numbered, so that a class with a third of all rows is many cells) and the k-th rest of a
class takes the k-th place that the patterns have for it.

Rounding the patterns down leaves less than one use of each over.  Those rests, bounded like
the patterns, are laid out on the driver: first-fit by decreasing length while sequences
come out nearly full, the others one after the other and cut where a sequence is full.
Their documents are tokenized again for the ids of the cut pieces.

Defined cases: a null or empty text is one piece that holds only the end id; repeated rows
and null ids are documents like others; an empty table gives no rows; other columns aren't
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, written
from .cutting_stock import cutting_plan
from .sharding import numbered
from .tokens import cache_for, encoded

SEQUENCE = 2048
END_ID = 1
UNIT = 8
SHORT = 64
BUNDLE = 256                # ids of a bundle of short rests, at most
NEARLY_FULL = 0.99
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, whole long, piece_hash long"


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """The pieces of every document; with ``keep_ids`` also their ids."""
    end = np.array([end_id], "<u4")
    kinds = [pa.int64()] * 7 + ([pa.list_(pa.int64())] if keep_ids else [])
    names = [x.split()[0] for x in PIECES.split(", ")] + (["ids"] if keep_ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cache_for(tokenizer_path)
        for b in batches:
            doc_ids, at = b.column(0).to_pylist(), 0
            for ids, offsets in encoded(b.column(1), cache):
                out: list[tuple] = []
                for i in range(len(offsets) - 1):
                    own = np.concatenate([ids[offsets[i]:offsets[i + 1]], end])
                    raw, n = memoryview(own.tobytes()), len(own)
                    whole = zlib.crc32(raw)
                    for s in range(0, n, sequence):
                        e = min(n, s + sequence)
                        crc = zlib.crc32(raw[4 * s:4 * e]) if e - s < n else whole
                        row = (doc_ids[at + i], s, e - s, crc, n, whole, crc << 31 ^ whole)
                        out.append(row + (own[s:e].tolist(),) if keep_ids else row)
                at += len(offsets) - 1
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(in_batches(run), PIECES + (", ids array<long>" if keep_ids else ""))


def places(plan: list[tuple[dict[int, int], int]], bundles: list[int]) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int], int]:
    """(class, first rank, ranks, pieces per sequence, first sequence) of every use of a class;
    the ranks placed by class; the number of sequences."""
    placed: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in plan:
        for c, n in pattern.items():
            n *= bundles[c]
            out.append((c, placed.get(c, 0), n * times, n, sequence))
            placed[c] = placed.get(c, 0) + n * times
        sequence += times
    return out, placed, sequence


def laid_out(lengths: list[int], sequence: int) -> list[list[tuple[int, int, int, int]]]:
    """For each rest its parts: (start in the rest, length, sequence from 0, offset)."""
    room: list[int] = []
    inside: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fit = min((r for r, at in by_room.items() if r >= n and at), default=None)    # best fit: at most ``sequence`` rooms
        if fit is None:
            at = len(room)
            room.append(sequence)
            inside.append([])
        else:
            at = by_room[fit].pop()
        inside[at].append(i)
        room[at] -= n
        by_room.setdefault(room[at], []).append(at)
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in lengths]
    full = [x for x, r in zip(inside, room) if sequence - r >= NEARLY_FULL * sequence]
    for k, members in enumerate(full):
        at = 0
        for i in members:
            out[i].append((0, lengths[i], k, at))
            at += lengths[i]
    k, at = len(full), 0
    for i in (i for x, r in zip(inside, room) if sequence - r < NEARLY_FULL * sequence for i in x):
        done = 0
        while done < lengths[i]:
            if at == sequence:
                k, at = k + 1, 0
            n = min(lengths[i] - done, sequence - at)
            out[i].append((done, n, k, at))
            done, at = done + n, at + n
    return out


def packed(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """The pieces of every document with their ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    p = written(pieces(docs, tokenizer_path, sequence, end_id, keep_ids), "pieces")
    size = F.when(F.col("length") < SHORT, F.col("length")).otherwise(F.ceil(F.col("length") / UNIT) * UNIT).cast("int")
    p = p.withColumn("size", size)
    # one count per class: sequence / UNIT + SHORT at most
    counts = sorted((r["size"], r["n"]) for r in p.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect())
    bundles = [BUNDLE // s if s < SHORT else 1 for s, _ in counts]
    plan = cutting_plan([(-(-s * b // UNIT), n // b) for (s, n), b in zip(counts, bundles)], sequence // UNIT)
    uses, placed, first_left = places(plan, bundles)
    names = [s for s, _ in counts]
    # bounded by classes times patterns, that is by the sequence length alone
    table = F.broadcast(spark.createDataFrame([(names[c], *x) for c, *x in uses],
                                              "size_ int, first_rank long, ranks long, per long, first_sequence long"))
    starts = F.broadcast(spark.createDataFrame([(names[c], n) for c, n in placed.items()], "size_ int, placed long"))
    order = ["doc_id", "start", "piece_hash"]
    ranked = written(numbered(p, "size", F.struct(*order), order).withColumnRenamed("slot", "rank"), "ranked")

    left = ranked.join(starts, F.col("size") == F.col("size_"), "left").where(
        F.col("placed").isNull() | (F.col("rank") >= F.col("placed")))
    left = left.select("doc_id", "start", "length", "doc_tokens", "whole").orderBy("length", *order[:2], "whole").collect()
    layout = laid_out([r["length"] for r in left], sequence)
    cut = [(r["doc_id"], r["doc_tokens"], r["whole"], r["start"] + s, n, first_left + k, at)
           for r, parts in zip(left, layout) for s, n, k, at in parts]
    rest = _cut_pieces(docs, tokenizer_path, cut, end_id, keep_ids)

    inside = F.col("rank") - F.col("first_rank")
    ranked = ranked.join(table, (F.col("size") == F.col("size_")) & (inside >= 0) & (inside < F.col("ranks")))
    ranked = ranked.withColumn("sequence_id", F.col("first_sequence") + F.expr("(rank - first_rank) div per"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order, "rank") \
                   .rowsBetween(Window.unboundedPreceding, -1)       # a sequence has ``sequence`` pieces at most
    ranked = ranked.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return ranked.select(*names).unionByName(rest.select(*names))


def _cut_pieces(docs: DataFrame, tokenizer_path: str, cut: list[tuple], end_id: int, keep_ids: bool) -> DataFrame:
    """The given pieces (doc_id, doc_tokens, whole, start, length, sequence_id, offset) with their
    crc32, from their documents' ids.  Equal documents have equal pieces: each is given once."""
    spark = docs.sparkSession
    wanted: dict[tuple, list[tuple]] = {}
    for doc_id, n, whole, *piece in cut:
        wanted.setdefault((doc_id, n, whole), []).append(tuple(piece))
    shipped = spark.sparkContext.broadcast(wanted)
    end = np.array([end_id], "<u4")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    kinds = [pa.int64()] * 7 + ([pa.list_(pa.int64())] if keep_ids else [])
    names = [x.split()[0] for x in schema.split(", ")] + (["ids"] if keep_ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cache_for(tokenizer_path)
        for b in batches:
            doc_ids, at = b.column(0).to_pylist(), 0
            for ids, offsets in encoded(b.column(1), cache):
                out = []
                for i in range(len(offsets) - 1):
                    own = np.concatenate([ids[offsets[i]:offsets[i + 1]], end])
                    raw = memoryview(own.tobytes())
                    for s, n, k, o in shipped.value.get((doc_ids[at + i], len(own), zlib.crc32(raw)), ()):
                        row = (doc_ids[at + i], s, n, zlib.crc32(raw[4 * s:4 * (s + n)]), len(own), k, o)
                        out.append(row + (own[s:s + n].tolist(),) if keep_ids else row)
                at += len(offsets) - 1
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    ids = spark.createDataFrame([(x,) for x in {c[0] for c in cut}], "left_id long")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("left_id")), "left_semi")
    found = d.mapInArrow(in_batches(run), schema + (", ids array<long>" if keep_ids else ""))
    return found.dropDuplicates(["sequence_id", "offset"])


def sequences(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """sequence_id and its ids, in order."""
    p = packed(docs, tokenizer_path, keep_ids=True, **options)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))      # ``sequence`` ids at most
    return p.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
