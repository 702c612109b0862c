"""Homomorphic multiset hash of a document's paragraphs, with DataFrame functions only.

A paragraph is a line that holds more than white space.  Each is hashed (SHA-256) and spread
into a wide vector: 128 lanes, each a byte of XXH64(digest, lane group) less 128.  The
fingerprint is the sum of the vectors, lane by lane modulo 2^16.  So it depends on the
multiset of the paragraphs and not on their order; a paragraph is inserted by adding its
vector and deleted by subtracting it, without the rest of the text.

Lanes are random with mean 0, so the squared length of a difference of fingerprints is in
expectation proportional to the number of paragraphs that one multiset has and the other
lacks (squared, where one is repeated).  ``likeness`` is ``1 - |a - b|^2 / (|a|^2 + |b|^2)``, not below
0: 1 for equal fingerprints, about the share of common paragraphs for others (standard
error about 0.09 at 128 lanes).  Differences of more than about 10,000 paragraphs wrap
around in their lanes and look unlike.

Two lanes are kept in one long, 32 bits apart, so that no sum carries into the other lane.

Defined cases: a null text counts as empty; a text without paragraphs has the zero
fingerprint, and two such are alike (1.0); equal rows, repeated and null ids are documents
of their own (order: id, null last, then SHA-256 of the text); an empty table gives no rows;
other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text, written

GROUPS = 16                         # XXH64 values per paragraph, 8 lanes each
BYTES = 0x000000FF000000FF          # one byte of each lane
LANES = 0x0000FFFF0000FFFF          # the lanes of a long
MINUS_128 = 0x0000FF800000FF80      # -128 in both lanes
WRAP = 0x0001000000010000           # 2^16 in both lanes

SLICE_ROWS = 1000                   # documents in a slice of the order
MAX_SLICES = 16_384                 # beyond, slices grow with the table
SAMPLE = 8                          # sampled keys for each slice
REPEATED = 1000                     # copies of one row from which they become one row
BROADCAST_KEYS = 100_000            # keys of 84 characters that are broadcast


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once: a one-element array binds it to a name."""
    return F.element_at(F.transform(F.array(value), f), 1)


def paragraphs(text: Column) -> Column:
    """The lines of a text that hold more than white space."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def multiset_sums(items: Column) -> Column:
    """Sum of the vectors of an array of strings: array of longs, two lanes each."""
    def lanes(hashes: Column, shift: int) -> Column:
        return F.aggregate(hashes, _long(0), lambda a, x: (
            a + F.shiftrightunsigned(x, shift).bitwiseAND(_long(BYTES)) + _long(MINUS_128)).bitwiseAND(_long(LANES)))

    def group(digests: Column, g: Column) -> Column:
        return _bound(F.transform(digests, lambda d: F.xxhash64(d, g)),
                      lambda h: F.array(*[lanes(h, shift) for shift in (0, 8, 16, 24)]))

    digests = F.transform(items, lambda p: F.sha2(p.cast("binary"), 256))
    return _bound(digests, lambda d: F.flatten(F.transform(F.array(*[F.lit(g) for g in range(GROUPS)]), lambda g: group(d, g))))


def inserted(a: Column, b: Column) -> Column:
    """The fingerprint of the union of both multisets."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(_long(LANES)))


def deleted(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the members of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x + (_long(WRAP) - y)).bitwiseAND(_long(LANES)))


def _squared(a: Column) -> Column:
    def signed(x: Column) -> Column:
        return (x + 0x8000).bitwiseAND(_long(0xFFFF)) - 0x8000

    def both(x: Column) -> Column:
        return _bound(signed(x.bitwiseAND(_long(0xFFFF))), lambda v: v * v) + _bound(signed(F.shiftrightunsigned(x, 32)), lambda v: v * v)
    return F.aggregate(a, _long(0), lambda total, x: total + both(x))


def likeness(a: Column, b: Column) -> Column:
    """From 0 (nothing in common) to 1 (equal)."""
    apart = _squared(deleted(a, b))
    return _bound(apart, lambda d: F.when(d == 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), 1 - d.cast("double") / (_squared(a) + _squared(b)))))


def fingerprint(sums: Column) -> Column:
    """The lanes as 512 hex digits."""
    one = F.transform(sums, lambda x: F.lower(F.lpad(F.hex(
        F.shiftleft(F.shiftrightunsigned(x, 32), 16).bitwiseOR(x.bitwiseAND(_long(0xFFFF)))), 8, "0")))
    return F.array_join(one, "")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, the sums (to insert into and delete from) and the fingerprint of every document."""
    d = docs.select("doc_id", multiset_sums(paragraphs(whole_text("text"))).alias("sums"))
    return d.select("doc_id", "sums", fingerprint(F.col("sums")).alias("fingerprint"))


def order_key(doc_id: Column, text: Column) -> Column:
    """A string that sorts as (id, null first; SHA-256 of the text)."""
    number = F.lpad((doc_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat(F.coalesce(number, F.lit("!")), F.sha2(text.cast("binary"), 256))


def _slice(key: Column, bounds: Column, n: int) -> Column:
    """The last bound that is not above ``key`` (0 if all are): a binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
    after = F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= n) & (F.get(bounds, F.least(at + s, F.lit(n)) - 1) <= key), at + s).otherwise(at))
    return F.greatest(after - 1, F.lit(0))


def _listed(values: list[str]) -> Column:
    return F.split(F.lit(",".join(values)), ",")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, its sums, and those of the next document by descending id (after the
    last: the first) as ``next_text``, ``next_sums``.

    The order is cut into slices by bounds from a hash sample of the keys; each slice also
    gets the row before its first one, so that windows run inside slices.  Rows repeated
    more than ``REPEATED`` times are counted first and given out again at the end.
    """
    text = whole_text("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       order_key(F.col("doc_id").cast("long"), text).alias("key"))
    keys = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "order-keys")
    total, repeated = keys.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > REPEATED).cast("int")), F.lit(0))).first()
    n = max(1, min(MAX_SLICES, -(-int(total) // SLICE_ROWS)))
    h = F.xxhash64("key")
    last = keys.select(h.alias("h")).orderBy("h").limit(n * SAMPLE).agg(F.max("h")).first()[0]
    sample = sorted(r[0] for r in keys.where(h <= F.lit(last)).orderBy(h).limit(n * SAMPLE).select("key").collect())
    values = sample[::SAMPLE] or [""]
    n = len(values)
    at = _slice(F.col("key"), _listed(values), n)
    ends = dict(keys.groupBy(at.alias("s")).agg(F.max("key")).collect())
    ends = _listed([ends.get(s, "") for s in range(n)])          # slice 0 is empty only if there are no rows

    counted = rows.withColumn("n", _long(1))
    if repeated:
        hot = keys.where(F.col("n") > REPEATED).select("key")
        hot = F.broadcast(hot) if repeated <= BROADCAST_KEYS else hot
        many = rows.join(hot, "key", "left_semi").groupBy("key").agg(
            F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
        counted = counted.join(hot, "key", "left_anti").unionByName(many)
    placed = counted.withColumn("slice", at)
    own = F.struct(F.col("slice").alias("slice"), F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("slice") + 1, F.lit(n)).alias("slice"), F.lit(True).alias("guest"))
    is_end = F.col("key") == F.get(ends, F.col("slice"))
    placed = placed.select("doc_id", "text", "key", "n", F.explode(F.when(is_end, F.array(own, guest)).otherwise(F.array(own))).alias("to")) \
                   .select("doc_id", "text", "key", "n", "to.*")
    # the row before in this order is the next by descending id
    w = Window.partitionBy("slice").orderBy(F.col("guest").desc(), "key")
    summed = placed.repartition("slice").withColumn("sums", multiset_sums(paragraphs(F.col("text"))))
    d = summed.select("*", F.lag(F.struct("text", "sums")).over(w).alias("before")).where(~F.col("guest"))
    if not repeated:
        return d.select("doc_id", "text", "sums", F.col("before.text").alias("next_text"), F.col("before.sums").alias("next_sums"))
    # of equal rows one comes before another document, the others before each other
    itself = F.struct("text", "sums")
    d = d.select("doc_id", "text", "sums", F.explode(F.when(F.col("n") > 1, F.array(
        F.struct(_long(1).alias("n"), F.col("before").alias("next")), F.struct((F.col("n") - 1).alias("n"), itself.alias("next"))))
        .otherwise(F.array(F.struct(_long(1).alias("n"), F.col("before").alias("next"))))).alias("to"))
    block = 10_000
    times = F.explode(F.sequence(_long(0), F.floor((F.col("to.n") - 1) / block)))
    d = d.select("doc_id", "text", "sums", "to", times.alias("block"))
    inside = F.sequence(_long(1), F.least(_long(block), F.col("to.n") - F.col("block") * block))
    return d.select("doc_id", "text", "sums", F.col("to.next.text").alias("next_text"), F.col("to.next.sums").alias("next_sums"),
                    F.explode(inside).alias("copy")).drop("copy")


def edited_report(docs: DataFrame) -> DataFrame:
    """Each document against its edited text (its last half replaced by as much of the next
    document's beginning) and against the next document."""
    d = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.withColumn("edited", F.concat(F.substr(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
                                        F.substr(F.col("next_text"), F.lit(1), half)))
    edited = _bound(multiset_sums(paragraphs(F.col("edited"))), lambda e: F.struct(
        fingerprint(e).alias("fingerprint"), likeness(F.col("sums"), e).alias("near")))
    # exploding one row keeps the struct from being computed once for each of its fields
    d = d.select("doc_id", "n_chars", "sums", "next_sums", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                 F.explode(F.array(edited)).alias("e"))
    return d.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sums")).alias("fingerprint"),
                    F.col("e.fingerprint").alias("edited_fingerprint"), F.col("e.near").alias("near_edited"),
                    likeness(F.col("sums"), F.col("next_sums")).alias("near_next"))
