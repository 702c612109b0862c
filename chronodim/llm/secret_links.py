"""Secret scan with multipart credential linking.

Base findings are fixed patterns: assignments of passwords and keys, access identifiers,
long hex strings.  Besides, a text is searched for weak parts that are common in clean
text by themselves: bare high-entropy tokens, names of users or clients, and endpoints.
A credential is useless without its other parts, so a weak part is reported only where a
complementary part lies in the same scope (of identifier, secret and endpoint any two
complete each other): a block of lines without a blank line between, however long.  Parts have no upper length;
of a weak part that overlaps base findings, what lies outside them is reported.
Parts are intervals of one text, so the interval join runs inside the row: complements are
sorted by position and looked up by bisection; nothing is shuffled.

Defined cases: a null text counts as empty; rows are scanned one by one, so repeated rows,
ties and null ids change nothing; an empty table gives no rows; other columns are kept only
by ``redacted``.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches

REACH = math.inf            # code points between linked parts: the whole block
MASK = "[REDACTED]"
ENTROPY = 3.5               # bits per character of a bare token

#: Fixed patterns of the base findings (kind, pattern); group 2 of the first has 6 or more characters.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: Runs of fewer characters never count, and a shorter run can't hide a longer one in it.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")

#: Weak parts.
BARE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/=_-])")
IDENTIFIER = re.compile(r"""\b(?:user(?:_?name|_?id)?|login|client_?id|account(?:_?id)?|access_?key_?id)["']?\x20?[:=]\x20?["']?([A-Za-z0-9@._-]{3,})""", re.I | re.A)
ENDPOINT = re.compile(r"\b(?:https?|ftp|ssh|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>|]{4,}", re.A)
#: What completes a weak part.
COMPLEMENT = {"weak_secret": ("identifier", "endpoint"), "weak_id": ("secret", "endpoint"), "endpoint": ("identifier", "secret")}
#: What the kinds are; all others are secrets.
ROLE = {"access": "identifier", "weak_id": "identifier", "endpoint": "endpoint"}


def entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, in the order of KINDS and start."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def _scope_of(text: str):
    """Number of the block that a position lies in."""
    cuts = [m.end() for m in re.finditer(r"\n[\x20\t\r]*\n", text)]
    return lambda at: bisect_left(cuts, at + 1)


class Intervals:
    """Intervals (block, start, end) of one text, sorted, with the two furthest ends of different
    intervals up to each place of a block: a lookup is one bisection, whatever the lengths."""

    def __init__(self, found: list[tuple[int, int, int]]):
        self.found = sorted(set(found))
        self.furthest: list[tuple[tuple[int, int], tuple[int, int]]] = []
        block, best, second = None, (-1, -1), (-1, -1)
        for b, s, e in self.found:
            if b != block:
                block, best, second = b, (-1, -1), (-1, -1)
            if (e, s) > best:
                best, second = (e, s), best
            elif (e, s) > second:
                second = (e, s)
            self.furthest.append((best, second))

    def meets(self, block: int, low: int, high: int, but: tuple[int, int] | None = None) -> bool:
        """Whether an interval of the block, other than ``but``, starts at ``high`` or before
        and ends at ``low`` or after."""
        at = bisect_right(self.found, (block, high, math.inf)) - 1
        if at < 0 or self.found[at][0] != block:
            return False
        return any(e >= max(low, 0) and (s, e) != but for e, s in self.furthest[at])


def outside(spans: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[list[tuple[str, int, int]]]:
    """For each span, the pieces of it that lie outside all base spans."""
    taken: list[list[int]] = []             # unions of overlapping base spans
    for _, s, e in sorted(base, key=lambda x: x[1:]):
        if taken and s <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    ends = [e for _, e in taken]
    out = []
    for kind, s, e in spans:
        pieces, at = [], bisect_right(ends, s)
        while at < len(taken) and taken[at][0] < e:
            if s < taken[at][0]:
                pieces.append((kind, s, taken[at][0]))
            s = taken[at][1]
            at += 1
        out.append(pieces + [(kind, s, e)] if s < e else pieces)
    return out


def linked_spans(text: str, base: list[tuple[str, int, int]], reach: float = REACH) -> list[tuple[str, int, int]]:
    """Weak parts with a complementary part in their scope; what overlaps base spans is left out."""
    weak = []
    if "://" in text:
        weak += [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    weak += [("weak_id", m.start(1), m.end(1)) for m in IDENTIFIER.finditer(text)]
    weak += [("weak_secret", m.start(), m.end()) for m in BARE.finditer(text)
             if re.search(r"[0-9]", m[0]) and re.search(r"[A-Za-z]", m[0]) and entropy(m[0]) >= ENTROPY]
    left = {x: pieces for x, pieces in zip(weak, outside(weak, base)) if pieces}
    if not left:
        return []
    scope = _scope_of(text)
    parts: dict[str, list[tuple[int, int, int]]] = {"identifier": [], "secret": [], "endpoint": []}
    for kind, s, e in [*base, *left]:
        parts[ROLE.get(kind, "secret")].append((scope(s), s, e))
    places = {role: Intervals(found) for role, found in parts.items()}

    def completed(kind: str, s: int, e: int) -> bool:
        block = scope(s)
        return any(places[role].meets(block, s - reach, e + reach, (s, e)) for role in COMPLEMENT[kind])

    return [piece for x, pieces in left.items() if completed(*x) for piece in pieces]


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then the kinds in their order, comma-joined."""
    order = {k: i for i, k in enumerate((*KINDS, "endpoint", "weak_id", "weak_secret"))}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], order[x[0]], x[2])))


def scan(text: str | None) -> tuple[int, int, int, str, str]:
    """n_assign, n_access, n_hex, base_sha256 and spans of one text."""
    text = text or ""
    base = base_spans(text)
    n = Counter(k for k, _, _ in base)
    mine = joined(base)
    every = joined(base + linked_spans(text, base))
    return n["assign"], n["access"], n["hex"], hashlib.sha256(mine.encode()).hexdigest(), every


FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id and the findings of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        for b in batches:
            rows = [scan(t) for t in b.column(1).to_pylist()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(in_batches(run), f"doc_id {kind}, {FOUND}")


def mask(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with each union of overlapping spans replaced."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every finding masked in the text; ``n_chars`` follows where it changed."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = names.index("text")
            texts = b.column(i).to_pylist()
            new = []
            for t in texts:
                base = base_spans(t) if t else []
                spans = base + linked_spans(t, base) if t else []
                new.append(mask(t, [x[1:] for x in spans]) if spans else t)
            cols = list(b.columns)
            cols[i] = pa.array(new, pa.string())
            if "n_chars" in names:
                j = names.index("n_chars")
                cols[j] = pa.array([n if a is b_ or a == b_ else len(b_) for n, a, b_ in zip(cols[j].to_pylist(), texts, new)], cols[j].type)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    by_place = docs.toDF(*[f"c{i}" for i in range(len(names))])     # names may need quotes
    return by_place.mapInArrow(in_batches(run), by_place.schema).toDF(*names)
