"""Ranked lexical search by branch and bound over trees of documents.

Query items are a stated set; every document is ranked for each of them.

1. Each document becomes a restricted vector: its length and the frequencies of the terms
   that some item holds.  The vectors are a written table; document frequencies, their number
   and their total length come from aggregates over it.
2. A task reads its share of the vectors in blocks.  In a block, terms are ordered by document
   frequency, so that documents share the paths of a prefix tree (unary paths are one edge;
   small subtrees under a node are joined to leaves of a few documents).  Every node knows the
   largest tf of each term and the smallest m in its subtree: with these no document below can
   score more than the node's bound.
3. The tree is searched depth first, the child with the highest bounds first.  An item leaves
   a subtree whose bound is below its k-th score so far (which it keeps from block to block);
   in leaves the remaining documents are scored exactly, in integers.
4. Each task gives at most k rows per item; a window with a partial limit merges them.

Items go through in blocks of at most ``ITEM_BYTES`` of text (or one text), which bounds the
vocabulary that tasks and driver hold; equal texts are searched once.

Defined cases: null texts, and texts without terms, have no terms: such documents are in no
result, such items have none; rows with equal or null ids are documents (items) of their
own, ids ascending, null last; empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K = 10
ITEM_BYTES = 1 << 18        # texts of the items searched together
BLOCK_DOCS = 4096           # documents in a tree
BLOCK_ENTRIES = 2_000_000   # and vector entries
LEAF = 16                   # documents scored together
NEVER = np.iinfo(np.int64).max
VECTOR = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, score long"

#: Terms are runs of these bytes; A-Z in lower case, any other ASCII byte is a separator.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).replace(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def terms(raw: bytes) -> list[bytes]:
    return raw.translate(TERM_BYTES).split()


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms, and the distinct vocabulary terms (by number) with their tf."""
    size = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, counts, ids = [], [], []
            for text in b.column(1):
                w = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                known = [vocabulary[t] for t in w if t in vocabulary]
                lengths.append(len(w))
                counts.append(len(known))
                ids.extend(known)
            key, tf = np.unique(np.repeat(np.arange(len(lengths)), counts) * size + np.array(ids, np.int64), return_counts=True)
            at = pa.array(np.searchsorted(key, np.arange(len(lengths) + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(at, pa.array((key % size).astype(np.int32))),
                 pa.ListArray.from_arrays(at, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, VECTOR)


@dataclass
class Items:
    """The terms of all items end to end, and where each item starts."""
    terms: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, lists: list[list[int]]) -> Items:
        ends = np.cumsum([len(x) for x in lists])
        return cls(np.array([t for x in lists for t in x], np.int64), np.concatenate([[0], ends]).astype(np.int64))

    def chosen(self, which: np.ndarray) -> Items:
        n = np.diff(self.starts)[which]
        starts = np.concatenate([[0], np.cumsum(n)])
        return Items(self.terms[np.repeat(self.starts[which] - starts[:-1], n) + np.arange(starts[-1])], starts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per item the sum of ``values`` (last axis: terms) over its terms; items hold one term at least."""
        return np.add.reduceat(values[..., self.terms], self.starts[:-1], axis=-1)


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass
class Node:
    first: int
    end: int
    children: list["Node"]
    most: np.ndarray            # largest tf of each term in the subtree
    least_m: int


class DocumentTree:
    """Documents in the order of their term sequences; ``split[i]`` is the depth at which
    document i's path leaves that of document i - 1."""

    def __init__(self, ids: np.ndarray, no_id: np.ndarray, m: np.ndarray, at: np.ndarray, ranks: np.ndarray, tfs: np.ndarray,
                 n_terms: int):
        doc = np.repeat(np.arange(len(ids)), np.diff(at))
        by = np.lexsort((ranks, doc))                       # each path from the most frequent term on
        ranks, tfs = ranks[by], tfs[by]
        label, split = self._order(at, ranks, n_terms)
        order = np.argsort(label, kind="stable")
        self.split = split
        self.ids, self.no_id, self.m = ids[order], no_id[order], m[order]
        lengths = np.diff(at)[order]
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(at[:-1][order] - self.at[:-1], lengths) + np.arange(self.at[-1])
        self.ranks, self.tfs, self.n_terms = ranks[take], tfs[take], n_terms
        self.root = self._node(0, len(ids))

    @staticmethod
    def _order(at: np.ndarray, ranks: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents by their sequences, and the depth where neighbours part."""
        n = len(at) - 1
        label = np.zeros(n, np.int64)
        split = np.full(n, NEVER)                           # as documents of one leaf, or with equal paths
        depth = 0
        while True:
            here = at[:-1] + depth
            going = (here < at[1:]) & (np.bincount(label, minlength=n)[label] > LEAF)
            if not going.any():
                return label, split
            step = np.where(going, ranks[np.minimum(here, len(ranks) - 1)] + 1, 0)
            key = label * (n_terms + 1) + step
            sorted_keys = np.sort(key)
            first = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
            # a label is the place of its first document, so labels of later depths stay in order
            place = np.nonzero(first)[0]
            split[place] = np.minimum(split[place], depth)
            label = place[np.searchsorted(sorted_keys[place], key)]
            depth += 1

    def _cuts(self, first: int, end: int) -> list[int]:
        """Where paths part, from the least depth on at which no part holds over half of the documents
        (so that chains of small side branches are one node); none if all paths are equal."""
        inside = self.split[first + 1:end]
        depths = np.unique(inside[inside < NEVER])
        if not len(depths):
            return []
        def cuts(d: int) -> np.ndarray:
            return np.concatenate([[first], np.nonzero(inside <= depths[d])[0] + first + 1, [end]])
        low, high = 0, len(depths) - 1
        while low < high:
            middle = (low + high) // 2
            if np.diff(cuts(middle)).max() <= max(LEAF, (end - first) // 2):
                high = middle
            else:
                low = middle + 1
        return cuts(low).tolist()

    def _node(self, first: int, end: int) -> Node:
        children: list[Node] = []
        cuts = self._cuts(first, end) if end - first > LEAF else []
        pending = first
        for a, b in zip(cuts, cuts[1:]):                     # small siblings next to each other are one leaf
            if b - pending > LEAF:
                if a > pending:
                    children.append(self._node(pending, a))
                pending = a
                if b - a > LEAF:
                    children.append(self._node(a, b))
                    pending = b
        if children and pending < end:
            children.append(self._node(pending, end))
        if children:
            most = np.maximum.reduce([c.most for c in children])
        else:
            most = np.zeros(self.n_terms, np.int32)
            entries = slice(self.at[first], self.at[end])
            np.maximum.at(most, self.ranks[entries], self.tfs[entries].astype(np.int32))
        return Node(first, end, children, most, int(self.m[first:end].min()))

    def scores(self, first: int, end: int, weights: np.ndarray, items: Items) -> np.ndarray:
        """Exact scores of documents first..end (rows) for the items (columns)."""
        entries = slice(self.at[first], self.at[end])
        doc = np.repeat(np.arange(end - first), np.diff(self.at[first:end + 1]))
        rank, tf = self.ranks[entries], self.tfs[entries]
        part = np.zeros((end - first, self.n_terms), np.int64)
        part[doc, rank] = weights[rank] * saturated(tf, self.m[first:end][doc])
        return items.sums(part)


class Search:
    """The k best documents of each item so far: score, null id, id."""

    def __init__(self, items: Items, weights: np.ndarray, k: int):
        n = len(items.starts) - 1
        self.items, self.weights, self.k = items, weights, k
        self.score = np.zeros((n, k), np.int64)             # 0: no document yet
        self.no_id = np.ones((n, k), bool)
        self.id = np.zeros((n, k), np.int64)
        self.scored = 0

    def bounds(self, node: Node, items: Items) -> np.ndarray:
        return items.sums(self.weights * saturated(node.most.astype(np.int64), np.int64(node.least_m)))

    def down(self, tree: DocumentTree, node: Node, which: np.ndarray, bound: np.ndarray) -> None:
        live = (bound >= self.score[which, -1]) & (bound > 0)    # equal scores may have a smaller id
        which = which[live]
        if not len(which):
            return
        if not node.children:
            for first in range(node.first, node.end, LEAF):
                self._verify(tree, first, min(first + LEAF, node.end), which)
            return
        items = self.items.chosen(which)
        below = [(c, self.bounds(c, items)) for c in node.children]
        for child, b in sorted(below, key=lambda x: -int(x[1].sum())):
            self.down(tree, child, which, b)

    def _verify(self, tree: DocumentTree, first: int, end: int, which: np.ndarray) -> None:
        got = tree.scores(first, end, self.weights, self.items.chosen(which)).T
        self.scored += got.size
        hit = ((got > 0) & (got >= self.score[which, -1:])).any(axis=1)
        which, got = which[hit], got[hit]
        if not len(which):
            return
        score = np.concatenate([self.score[which], got], axis=1)
        no_id = np.concatenate([self.no_id[which], np.broadcast_to(tree.no_id[first:end], got.shape)], axis=1)
        ids = np.concatenate([self.id[which], np.broadcast_to(tree.ids[first:end], got.shape)], axis=1)
        best = np.lexsort((ids, no_id, -score), axis=1)[:, :self.k]
        self.score[which] = np.take_along_axis(score, best, 1)
        self.no_id[which] = np.take_along_axis(no_id, best, 1)
        self.id[which] = np.take_along_axis(ids, best, 1)

    def run(self, tree: DocumentTree) -> None:
        self.down(tree, tree.root, np.arange(len(self.items.starts) - 1), self.bounds(tree.root, self.items))

    def rows(self) -> pa.RecordBatch:
        item, place = np.nonzero(self.score > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(self.id[item, place], mask=self.no_id[item, place]),
             pa.array(self.score[item, place])], ["item", "doc_id", "score"])


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of a block's size at most; a single row may hold more entries."""
    held, docs, entries = [], 0, 0
    for b in batches:
        ends = b.column(2).offsets.to_numpy().astype(np.int64)
        at = 0
        while at < b.num_rows:
            fits = int(np.searchsorted(ends, ends[at] + BLOCK_ENTRIES - entries, side="right")) - 1 - at
            n = max(0 if held else 1, min(b.num_rows - at, BLOCK_DOCS - docs, fits))
            if n:
                held.append(b.slice(at, n))
                docs, entries, at = docs + n, entries + int(ends[at + n] - ends[at]), at + n
            if n == 0 or docs >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
                yield _joined(held)
                held, docs, entries = [], 0, 0
    if held:
        yield _joined(held)


def best_documents(vectors: DataFrame, item_terms: list[list[int]], n_terms: int, k: int = K) -> DataFrame:
    """item (place in ``item_terms``), doc_id, score: the k best documents of each task's share."""
    n_docs, length = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect()    # at most the vocabulary
    df = np.zeros(n_terms, np.int64)
    for t, c in counts:
        df[t] = c
    order = np.argsort(-df, kind="stable")
    rank = np.empty(n_terms, np.int64)
    rank[order] = np.arange(n_terms)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df[t]) + 1))) for t in order], np.int64)
    items = Items.of([sorted(int(rank[t]) for t in x) for x in item_terms])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items, weights, k)
        for b in _blocks(batches):
            ids, at = b.column(0), b.column(2).offsets.to_numpy().astype(np.int64)
            m = 100 - 90 + (90 * b.column(1).to_numpy().astype(np.int64) * n_docs) // length
            entries = slice(int(at[0]), int(at[-1]))
            ranks = rank[b.column(2).values.to_numpy()[entries]]
            tfs = b.column(3).values.to_numpy()[entries].astype(np.int64)
            search.run(DocumentTree(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), m, at - at[0],
                                    ranks, tfs, n_terms))
        yield search.rows()

    return vectors.where(F.size("terms") > 0).mapInArrow(run, FOUND)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of every item."""
    spark = docs.sparkSession
    queries = items.select("item_id", F.col("text").cast("string").alias("text"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    texts = written(queries.where(F.col("text").isNotNull()).select(digest.alias("digest"), "text").distinct(), "item-texts")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(size) // item_bytes))
    found = None
    for block in range(n_blocks):
        mine = texts.where(F.pmod(F.xxhash64("digest"), F.lit(n_blocks)) == block).orderBy("digest").collect()
        vocabulary: dict[bytes, int] = {}
        lists, digests = [], []
        for r in mine:
            own = {vocabulary.setdefault(t, len(vocabulary)) for t in terms(r["text"].encode("utf-8", "surrogatepass"))}
            if own:
                lists.append(sorted(own))
                digests.append((len(digests), r["digest"]))
        if not lists:
            continue
        vectors = written(restricted_vectors(docs, vocabulary), "restricted-vectors")
        best = best_documents(vectors, lists, len(vocabulary), k)
        named = spark.createDataFrame(digests, "item int, digest string")
        best = best.join(named, "item").select("digest", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "digest string, doc_id long, score long")
    order = Window.partitionBy("digest").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return queries.select("item_id", digest.alias("digest")).join(written(top, "best-documents"), "digest") \
                  .select("item_id", "rank", "doc_id", "score")
