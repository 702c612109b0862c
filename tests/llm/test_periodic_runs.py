"""Periodic runs against the definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from chronodim.llm import periodic_runs, queries
from chronodim.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_runs(c, least=12):
    """Every maximal stretch of each period, smallest period first."""
    n, found = len(c), {}
    for q in range(1, n // 2 + 1):
        t = 0
        while t < n - q:
            a = t
            while t < n - q and c[t] == c[t + q]:
                t += 1
            if t - a >= max(least - q, q):
                found.setdefault((a, t + q - a), q)
            t += 1 if t == a else 0
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {t for s, m, q in runs for t in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for t, x in enumerate(w) if t not in gone)).hexdigest())


def test_runs_of_random_sequences():
    rng = random.Random(1)
    for _ in range(1500):
        n, letters = rng.randrange(0, 160), rng.choice([1, 2, 3, 5, 40])
        c = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(3) if n else 0):
            a = rng.randrange(n)
            p = rng.randrange(1, 1 + max(1, (n - a) // 2))
            for i in range(a, rng.randrange(a, n + 1)):
                c[i] = c[a + (i - a) % p]
        got = [tuple(r) for r in periodic_runs.runs_of(np.array(c, np.int64)).tolist()]
        assert sorted(got) == plain_runs(c) and got == sorted(got, key=lambda r: (r[0], r[2])), c


@pytest.mark.parametrize("least", [4, 7])
def test_other_least_lengths(least):
    rng = random.Random(2)
    for _ in range(300):
        c = [rng.randrange(3) for _ in range(rng.randrange(60))]
        assert sorted(map(tuple, periodic_runs.runs_of(np.array(c, np.int64), least).tolist())) == plain_runs(c, least), c


def test_few_pairs_held_at_once(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PAIRS", 50)
    rng = random.Random(3)
    for _ in range(200):
        c = [rng.randrange(2) for _ in range(150)]
        c[40:110] = [c[40 + i % 9] for i in range(70)]
        assert sorted(map(tuple, periodic_runs.runs_of(np.array(c, np.int64)).tolist())) == plain_runs(c)


def test_query(spark):
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d["doc_id"]] == plain_row(d["doc_id"], d["text"])


def test_odd_documents(spark):
    """Nulls, blanks, one word over and over, repeated rows and ids, clashing columns, no rows."""
    queries.on_workers(spark)
    rows = [(1, None), (2, ""), (3, " \t\n"), (71, "a " * 30_000), (71, "a " * 30_000), (None, "x y " * 9), (None, None),
            (5, "é \x1c q\x85 " * 20), (72, " ".join(f"w{i % 977}" for i in range(30_000))), (7, "one two three")]
    rows += [(i, " ".join(f"w{j}" for j in range(40))) for i in range(8, 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("n_words", "runs", "collapsed", "start", "best"):
        d = d.withColumn(c, F.lit("clash"))
    edited = d.select("doc_id", periodic_runs.planted().alias("text"))
    got = sorted(map(tuple, periodic_runs.run_digests(periodic_runs.periodic_runs(edited)).collect()), key=repr)
    plain = {(i, t): plain_row(i, t) for i, t in set(rows) if len(t or "") < 1000}
    digest = [hashlib.sha256(x).hexdigest() for x in (b"0,30000,1\n", b"a", b"0,30000,977\n", " ".join(f"w{i}" for i in range(977)).encode())]
    plain[rows[3]] = (71, 1, 0, 30000, 1, 30_000_000, digest[0], digest[1])
    plain[rows[8]] = (72, 1, 0, 30000, 977, 30706, digest[2], digest[3])
    assert all(zlib.crc32(str(i).encode()) % 10 for i in (71, 72))
    assert got == sorted((plain[r] for r in rows), key=repr)
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(d.limit(0))).collect() == []
