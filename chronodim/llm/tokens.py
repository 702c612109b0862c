"""Token ids of many texts by a public tokenizer file, with a bounded cache per worker.

For tokenizers that drop white space, a text's ids are the ids of its runs between ASCII white
space, one after the other.  Distinct runs of a batch are looked up once and their ids
are gathered by position; runs of Latin-1 letters with marks at their end are looked up as their
lower-case letters and their marks, so that they share those.  A new run goes through the tokenizer
itself or, if it is letters (perhaps with marks at its end) of the Latin blocks, straight to the
tokenizer's model, many words at once where the model marks the end of a word.
"""

from __future__ import annotations

import os
import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_RUNS = 250_000        # per generation; two generations are kept
BLOCK_BYTES = 4 << 20
JOINED_WORDS = 2_000        # words given to the model at once
MARKS = string.punctuation
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())      # of Latin-1: one code point each in lower case

_WORKERS: dict[str, "RunCache"] = {}


def _byte_letters() -> dict[int, str]:
    """The printable letters that stand for bytes in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(other)}


class RunCache:
    """Ids (packed little-endian 32-bit) of runs without ASCII white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.many, self.last = None, np.zeros(0, bool)
        suffix = getattr(self.model, "end_of_word_suffix", None) or ""
        if set(suffix) & set(MARKS) and set(suffix) - set(MARKS):       # is in no word of letters only or marks only
            self.many = Tokenizer(self.model)
            self.many.pre_tokenizer = CharDelimiterSplit(" ")
            vocab = self.many.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        # the short way is taken only where it agrees with the tokenizer
        probe = "Straße élan, Ünder. don't x1! <|endoftext|> ñandú?! " + " ".join(f"Ab{m} é{m}{m}" for m in MARKS) + " y" + MARKS
        full = list(map(self._full, probe.split()))
        self.short = all(w is None or b"".join(self._words(w)) == f for w, f in zip(map(self._short, probe.split()), full)) and \
            b"".join(full) == self._full(probe)

    def _full(self, run: str) -> bytes:
        return np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        return np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that are byte letters only or marks only."""
        if self.many is None:
            return list(map(self._word, words))
        out: list[bytes] = []
        for s in range(0, len(words), JOINED_WORDS):
            some = words[s:s + JOINED_WORDS]
            ids = np.array(self.many.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(ends) == len(some):          # a word has one such id at most, its last
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip([0, *ends], ends)]
            else:
                out += map(self._word, some)
        return out

    def _short(self, run: str) -> tuple[str, ...] | None:
        """The words (in byte letters) of a run of letters, or letters and marks."""
        if not run.isascii():
            if max(run) >= "ɐ":
                return None
            run = unicodedata.normalize("NFC", run)
            run = "".join([c.lower() for c in run])
        else:
            run = run.lower()
        word = run.rstrip(MARKS)
        if not word.isalpha():
            return None
        marks = run[len(word):]
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return (word, marks) if marks else (word,)

    def _new(self, runs: list[str]) -> list[bytes]:
        words = [self._short(r) if r and self.short else None for r in runs]
        ids = iter(self._words([w for x in words if x for w in x]))
        return [self._full(r) if x is None else b"".join([next(ids) for _ in x]) for r, x in zip(runs, words)]

    def __call__(self, runs: list[str]) -> list[bytes]:
        old = self.old
        out = [self.young.get(r) for r in runs]
        away = [i for i, ids in enumerate(out) if ids is None]
        new = [r for r in [runs[i] for i in away] if r not in old]
        made = dict(zip(new, self._new(new)))
        for i in away:
            r = runs[i]
            out[i] = self.young[r] = made[r] if r in made else old[r]
            if len(self.young) >= CACHE_RUNS:
                self.old, self.young = self.young, {}
        return out

    def parts(self, runs: pa.Array) -> tuple[pa.Array, pa.Array]:
        """For each run two texts whose ids follow each other (the second may be empty)."""
        word = pc.ascii_rtrim(runs, characters=MARKS)
        cut = pc.and_(pc.match_substring_regex(word, f"^[{LETTERS}]+$"), self.short)
        marks = pc.utf8_ltrim(runs, characters=LETTERS)
        return pc.if_else(cut, pc.utf8_lower(word), runs), pc.if_else(cut, marks, "")


def cache_for(path: str) -> RunCache:
    if path not in _WORKERS:
        _WORKERS[path] = RunCache(path)
    return _WORKERS[path]


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``most`` bytes, of one text at least."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    start, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if total and total + n > most:
            yield texts.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(texts) > start:
        yield texts.slice(start)


def _gathered(pool: np.ndarray, n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries ``at`` of a pool (``n`` ids each), and where each ends."""
    first = np.cumsum(n) - n
    length = n[at]
    ends = np.cumsum(length)
    where = np.repeat(first[at] - (ends - length), length)
    where += np.arange(len(where))
    return pool[where], ends


def _runs(block: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The runs of all texts, and where each text begins and the last ends."""
    runs = pc.ascii_split_whitespace(pc.fill_null(block, "").cast(pa.large_string()))
    offsets = np.asarray(runs.offsets).astype(np.int64)
    flat = runs.flatten()
    keep = np.asarray(pc.greater(pc.binary_length(flat), 0)) if len(flat) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(keep)])
    return pc.dictionary_encode(flat.filter(pa.array(keep))), before[offsets - offsets[0]]


def encoded(texts: pa.Array, cache: RunCache) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each block of texts: all ids (uint32), and where each text begins and the last ends."""
    for block in blocks(texts):
        coded, offsets = _runs(block)
        if not len(coded):
            yield np.zeros(0, np.uint32), np.zeros(len(block) + 1, np.int64)
            continue
        words = pc.dictionary_encode(pa.concat_arrays(cache.parts(coded.dictionary)))
        ids = cache(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pairs = np.asarray(words.indices).reshape(2, -1).T.ravel()
        pool, ends = _gathered(np.frombuffer(b"".join(ids), "<u4"), n, pairs)
        found, ends = _gathered(pool, np.diff(ends[1::2], prepend=0), np.asarray(coded.indices))
        yield found, np.concatenate([[0], ends])[offsets]
