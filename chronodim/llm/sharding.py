"""Minimax contiguous sharding of documents by size.

Rows of equal text stay together: texts are the atomic groups, in the order of a 64-bit hash.
The smallest feasible shard capacity over them is found by binary search with a greedy check,
on the driver, without bringing every text's size there.  The order begins as ``2 ** ATOM_BITS``
ranges.  A capacity with cuts between ranges only is an upper bound, one with cuts anywhere
in a range of several texts a lower bound; between them each cut stays within a short span.
Ranges in these spans are divided, ``ROUND`` at most at a time, until they are single texts
(or the bounds meet): then the upper bound is the smallest capacity over all texts, and the
order is cut by it.  A text larger than that has forced the capacity (one with very many
copies) gets a shard of its own and the others are cut again, so that the remaining shards
are near equal too.

Slots are counted without gathering a shard: rows of a shard fall into cells by a hash of
their id, cells are counted and numbered, and only inside a cell a window numbers rows.

Defined cases: a null text has no bytes and is grouped with empty texts; repeated rows are
counted as often as they occur; null ids share a cell per text; an empty table gives no
rows; with fewer groups than shards the last shards are empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text, written

ATOM_BITS = 16
STEP_BITS = 8               # a range is divided into 2 ** STEP_BITS at once
ROUND = 4096                # ranges divided by one job
LARGE = 64                  # ranges of several texts are divided beyond this part of a shard
CELLS = 1024                # per shard, for numbering its rows
ROW_BYTES = 8               # besides a text's bytes


def fits(sums: list[int], start: int, shards: int, capacity: int) -> list[int] | None:
    """Greedy check: the ends of at most ``shards`` runs from ``start`` on, each of
    ``capacity`` at most; None if they don't reach the end.  ``sums``: running totals from 0."""
    ends, at, last = [], start, len(sums) - 1
    while at < last and len(ends) < shards:
        nxt = bisect_right(sums, sums[at] + capacity) - 1
        if nxt == at:
            return None
        ends.append(at := nxt)
    return ends if at == last else None


def minimax_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity with which ``shards`` contiguous runs hold all sizes."""
    sums = [0, *accumulate(sizes)]
    low, high = max([*sizes, -(-sums[-1] // shards), 0]), sums[-1]
    while low < high:
        mid = (low + high) // 2
        if fits(sums, 0, shards, mid) is not None:
            high = mid
        else:
            low = mid + 1
    return low


class Range(NamedTuple):
    """Texts whose hashes begin with the same ``bits`` bits as ``start``."""

    start: int
    bits: int
    size: int
    whole: bool             # one text, or copies of it


def reached(sums: list[int], whole: list[bool], shards: int, capacity: int) -> list[int]:
    """Sums where runs of ``capacity`` end when ranges that are not ``whole`` may be cut anywhere."""
    ends, at = [], 0
    for _ in range(shards):
        to = min(at + capacity, sums[-1])
        i = bisect_right(sums, to) - 1
        at = sums[i] if i == len(whole) or whole[i] else to
        ends.append(at)
    return ends


def undecided(ranges: list[Range], shards: int) -> list[Range]:
    """Ranges that must be divided before the smallest capacity over texts is known; ``ROUND`` at most."""
    sums, whole = [0, *accumulate(r.size for r in ranges)], [r.whole for r in ranges]
    most = minimax_capacity([r.size for r in ranges], shards)
    low, high = -(-sums[-1] // shards), most
    while low < high:
        mid = (low + high) // 2
        if reached(sums, whole, shards, mid)[-1] == sums[-1]:
            high = mid
        else:
            low = mid + 1
    todo = [r for r in ranges if not r.whole and r.size * LARGE > low]
    if not todo and low < most:
        spans = zip(reached(sums, [True] * len(whole), shards - 1, low), reached(sums, whole, shards - 1, most))
        near = {i for a, b in spans for i in range(bisect_right(sums, a) - 1, bisect_left(sums, b))}
        todo = [ranges[i] for i in near if not whole[i]]
    return sorted(todo, key=lambda r: (-r.size, r.start))[:ROUND]


def partition(ranges: list[Range], shards: int) -> tuple[dict[int, int], list[Range]]:
    """Shard of each range by its start, or the ranges to be divided first."""
    rest, out, done = sorted(ranges), {}, 0
    while rest and shards - done > 1:
        if todo := undecided(rest, shards - done):
            return {}, todo
        capacity = minimax_capacity([r.size for r in rest], shards - done)
        top = max(rest, key=lambda r: r.size)
        # the capacity is one text's size, and the others would need less: it stands alone
        if top.size < capacity or sum(r.size for r in rest) - top.size > (shards - done - 1) * top.size:
            break
        out[top.start] = done
        done += 1
        rest.remove(top)
    if rest:
        sizes = [r.size for r in rest]
        ends = fits([0, *accumulate(sizes)], 0, shards - done, minimax_capacity(sizes, shards - done))
        start = 0
        for k, end in enumerate(ends):
            out.update((r.start, done + k) for r in rest[start:end])
            start = end
    return out, []


def text_group(text: str | Column) -> Column:
    """Hash of a text; equal texts are one atomic group."""
    return F.xxhash64(whole_text(text))


def ranges_of(rows: DataFrame, bits: int) -> list[Range]:
    """The ranges of ``bits`` bits that hold ``rows``, at most 2 ** bits."""
    found = rows.groupBy(F.shiftright("group_hash", 64 - bits).alias("prefix")).agg(
        F.sum("size").alias("s"), (F.min("group_hash") == F.max("group_hash")).alias("whole")).collect()
    return [Range(r["prefix"] << (64 - bits), bits, r["s"], r["whole"]) for r in found]


def divided(rows: DataFrame, chosen: list[Range]) -> list[Range]:
    """Parts of ``chosen``; at most ``ROUND * 2 ** STEP_BITS`` ranges."""
    out = []
    for bits in sorted({r.bits for r in chosen}):
        prefixes = rows.sparkSession.createDataFrame([(r.start >> (64 - bits),) for r in chosen if r.bits == bits], "prefix long")
        inside = rows.withColumn("prefix", F.shiftright("group_hash", 64 - bits)) \
                     .join(F.broadcast(prefixes), "prefix", "left_semi")            # ROUND at most
        out += ranges_of(inside, min(bits + STEP_BITS, 64))
    return out


def shards_of(rows: DataFrame, n_shards: int, atom_bits: int = ATOM_BITS) -> DataFrame:
    """``rows`` (with ``group_hash`` and ``size``) with their ``shard``; read several times, so
    give a written table."""
    sizes = rows.select("group_hash", "size")
    ranges = {r.start: r for r in ranges_of(sizes, atom_bits)}
    shard, todo = partition(list(ranges.values()), n_shards)
    while todo:
        for r in todo:
            del ranges[r.start]
        ranges |= {r.start: r for r in divided(sizes, todo)}
        shard, todo = partition(list(ranges.values()), n_shards)
    # by the first bits: where runs of one shard start, and which
    runs: dict[int, tuple[list[int], list[int]]] = {}
    for start in sorted(shard):
        starts, held = runs.setdefault(start >> (64 - atom_bits), ([], []))
        if not held or held[-1] != shard[start]:
            starts.append(start)
            held.append(shard[start])
    table = rows.sparkSession.createDataFrame([(atom, *x) for atom, x in runs.items()],
                                              "atom long, starts array<long>, held array<int>")
    # 2 ** atom_bits rows at most, with three cuts for each shard
    place = F.size(F.filter("starts", lambda s: s <= F.col("group_hash")))
    return rows.withColumn("atom", F.shiftright("group_hash", 64 - atom_bits)).join(F.broadcast(table), "atom") \
               .withColumn("shard", F.element_at("held", place)).drop("atom", "starts", "held")


def numbered(rows: DataFrame, by: str, key: Column, order: list[str], cells: int = CELLS) -> DataFrame:
    """``slot``: gapless numbers from 0 within ``by``; read twice, so give a written table."""
    rows = rows.withColumn("cell", F.pmod(F.xxhash64(key), F.lit(cells)).cast("int"))
    counts = rows.groupBy(by, "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(by, "cell", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first"))
    place = F.row_number().over(Window.partitionBy(by, "cell").orderBy(*order))
    return rows.withColumn("place", place).join(starts, [by, "cell"]) \
        .withColumn("slot", (F.col("first") + F.col("place") - 1).cast("long")).drop("cell", "place", "first")


def sharded(docs: DataFrame, n_shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document."""
    text = whole_text("text")
    rows = written(docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                               F.crc32(text.cast("binary")).alias("text_crc32"),
                               text_group("text").alias("group_hash")), "shard-rows")
    rows = written(shards_of(rows, n_shards), "shards")
    return numbered(rows, "shard", F.struct("doc_id", "group_hash"),
                    ["doc_id", "group_hash"]).drop("group_hash")


def write_shards(docs: DataFrame, n_shards: int, path: str) -> None:
    """The documents themselves as Parquet, one folder per shard."""
    rows = docs.withColumn("group_hash", text_group("text")) \
               .withColumn("size", (F.octet_length(whole_text("text")) + ROW_BYTES).cast("long"))
    shards_of(rows, n_shards).drop("group_hash", "size").write.partitionBy("shard").parquet(path)
