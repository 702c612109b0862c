"""The document tree against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from chronodim.llm import lexical_tree, queries
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k):
    bags = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    n_docs, length = sum(bool(b) for b in bags), sum(b.total() for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, _), b in zip(docs, bags):
            m = 10 + 90 * b.total() * n_docs // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m))
                    for t in set(TERM.findall((text or "").translate(LOWER))) if t in b)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id))
        for rank, (s, _, doc_id) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item_id, rank, doc_id, -s))
    return sorted(out, key=repr)


def test_terms_are_the_pattern():
    rng = random.Random(1)
    for _ in range(2000):
        t = "".join(rng.choice("aZ09 _-/:@[`{\x00\x7f\x80éÄß\U0001f600\n\x1c") for _ in range(30))
        assert [x.decode() for x in lexical_tree.terms(t.encode())] == TERM.findall(t.translate(LOWER))


@pytest.mark.parametrize("item_bytes,block", [(1 << 18, 4096), (150, 40)])
def test_odd_tables(spark, monkeypatch, item_bytes, block):
    """Nulls, blanks, long texts, ties, repeated rows and ids, copies beyond a leaf, clashing columns."""
    monkeypatch.setattr(lexical_tree, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical_tree, "BLOCK_ENTRIES", 20 * block)
    queries.on_workers(spark)
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "naïve", "MiXed", "x_y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(n):
        return " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(rng.choice([None, i, i, i, 7]), text(rng.randrange(0, 60))) for i in range(400)]
    docs += [(None, None), (1, ""), (2, " .,-"), (3, text(20_000))] + [(1000 + i % 9, docs[5][1]) for i in range(90)]
    rng.shuffle(docs)
    items = [(i, text(rng.randrange(1, 15))) for i in range(25)] + [(3, "w0"), (None, "w3 w3 W3"), (50, None), (51, "..."), (52, "unseen")]
    items += [items[0], items[0]]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("n", F.lit("clash")).withColumn("terms", F.lit(1))
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1)).withColumn("digest", F.lit("clash"))
    got = lexical_tree.ranked(d, q, 7, item_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, items, 7)
    for docs_, items_ in ((d.limit(0), q), (d, q.limit(0))):
        none = lexical_tree.ranked(docs_, items_)
        assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold_and_prune():
    """Every node's bound is at least its documents' scores; the search skips documents and finds the best."""
    rng = np.random.default_rng(3)
    n, n_terms = 3000, 200
    lists = [np.unique(rng.zipf(1.3, rng.integers(1, 60)).clip(max=n_terms) - 1) for _ in range(n)]
    lists[100:180] = [lists[100]] * 80
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    tfs = rng.integers(1, 30, at[-1])
    m = rng.integers(10, 400, n)
    tree = lexical_tree.DocumentTree(np.arange(n), np.zeros(n, bool), m, at, np.concatenate(lists), tfs, n_terms)
    weights = rng.integers(0, 9000, n_terms)
    items = lexical_tree.Items.of([sorted(rng.choice(n_terms, 12, replace=False).tolist()) for _ in range(20)])
    exact = tree.scores(0, n, weights, items)
    search = lexical_tree.Search(items, weights, 10)
    seen = []

    def walk(node):
        assert (search.bounds(node, items) >= exact[node.first:node.end].max(axis=0)).all()
        seen.append(node)
        for c in node.children:
            walk(c)
        if node.children:
            assert [c.first for c in node.children] + [node.end] == [node.first] + [c.end for c in node.children]
    walk(tree.root)
    search.run(tree)
    assert (search.score == -np.sort(-exact, axis=0)[:10].T).all()
    assert search.scored < 0.8 * exact.size and len(seen) < n / 4
