"""The multiset hash against a plain version, and its sums as a group."""

import hashlib
import random

import pytest
import xxhash
from chronodim.llm import multiset_hash, queries
from chronodim.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_sums(text):
    lanes = [0] * (8 * multiset_hash.GROUPS)
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            seed = xxhash.xxh64_intdigest(hashlib.sha256(line.encode()).hexdigest(), 42)
            for g in range(multiset_hash.GROUPS):
                h = xxhash.xxh64_intdigest(g.to_bytes(4, "little"), seed)
                for shift in range(4):          # a long holds bytes shift and shift + 4, the upper one first in print
                    for place, at in ((0, shift + 4), (1, shift)):
                        k = 8 * g + 2 * shift + place
                        lanes[k] = (lanes[k] + (h >> 8 * at & 255) - 128) % 65536
    return lanes


def plain_likeness(a, b):
    def squared(v):
        return sum(((x + 32768) % 65536 - 32768) ** 2 for x in v)
    apart = squared([(x - y) % 65536 for x, y in zip(a, b)])
    return 1.0 if apart == 0 else max(0.0, 1 - apart / (squared(a) + squared(b)))


def printed(lanes):
    return "".join(f"{x:04x}" for x in lanes)


def plain_report(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()), reverse=True)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, e, f = plain_sums(text), plain_sums(edited), plain_sums(following)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(e),
                    plain_likeness(a, e), plain_likeness(a, f)))
    return sorted(out, key=repr)


def test_query(spark):
    got = sorted(map(tuple, queries.op12_multiset_hash(spark, SF).collect()), key=repr)
    assert got == plain_report([(d["doc_id"], d["text"]) for d in table(spark, SF, "documents").collect()])


@pytest.mark.parametrize("slice_rows,repeated", [(1000, 1000), (3, 4), (1, 1)])
def test_odd_documents(spark, monkeypatch, slice_rows, repeated):
    """Nulls, blanks, long texts, repeated ids and rows (whole slices of them), clashing columns."""
    monkeypatch.setattr(multiset_hash, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(multiset_hash, "REPEATED", repeated)
    monkeypatch.setattr(multiset_hash, "SAMPLE", 2)
    rng = random.Random(4)
    texts = [None, "", " \n\t\n", "one line", "a\nb\nc\n", "c\nb\na", "a\n\nb\nc", "é\U0001f600\nx\r\ny\n", "long line\n" * 700 + "end"]
    rows = [(rng.choice([None, None, 1, 2, -5, 2**62]), rng.choice(texts)) for _ in range(60)]
    rows += [(None, "same\nrow")] * 30 + [(9, None)] * 12 + [(2**63 - 1, "top\nof all")] * 7 + [(-2**63, "")] * 6
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for c in ("key", "n", "slice", "guest", "sums", "before", "to", "edited"):
        d = d.withColumn(c, F.lit("clash"))
    got = sorted(map(tuple, multiset_hash.edited_report(d).collect()), key=repr)
    assert got == plain_report(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(3, "a\nb\nc\nd")], [(3, "a"), (3, "a")]])
def test_few_documents(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, multiset_hash.edited_report(d).collect()), key=repr) == plain_report(rows)


def test_insert_delete_and_order(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(60):
        a, b = ([rng.choice("abcdefgh") * 3 for _ in range(rng.randrange(8))] for _ in "ab")
        both = a + b
        rng.shuffle(both)
        rows.append((a, b, both))
    d = spark.createDataFrame(rows, "a array<string>, b array<string>, c array<string>")
    d = d.select(*[multiset_hash.multiset_sums(F.col(x)).alias(x) for x in "abc"])
    whole = d.select((multiset_hash.inserted(F.col("a"), F.col("b")) == F.col("c")).alias("added"),
                     (multiset_hash.deleted(F.col("c"), F.col("b")) == F.col("a")).alias("taken")).collect()
    assert all(r["added"] and r["taken"] for r in whole)


def test_likeness_is_about_the_common_share(spark):
    rng = random.Random(6)
    rows = []
    for common in (0, 5, 10, 15, 20):
        for _ in range(40):
            lines = [str(rng.random()) for _ in range(40 - common)]
            rows.append((common / 20, lines[:20], lines[20 - common:]))
    d = spark.createDataFrame(rows, "share double, a array<string>, b array<string>")
    near = multiset_hash.likeness(multiset_hash.multiset_sums(F.col("a")), multiset_hash.multiset_sums(F.col("b")))
    for share, mean, worst in d.groupBy("share").agg(F.avg(near), F.max(F.abs(near - F.col("share")))).collect():
        assert abs(mean - share) < 0.06 and worst < 0.45
