"""Pre-tokens of many texts at once.

The byte-level tokenizers split a text at changes of character class before they merge anything; contractions
and the space before a word are the exceptions.  Here the classes of all characters of a block of texts are
compared as arrays, so no text is walked through in Python.  The class of a character is asked from the
tokenizer itself the first time it is met, so that both agree on every character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from palimpsest.llm.bytewords import slices

OTHER, LETTER, NUMBER, SPACE = range(4)
#: The contractions that are pre-tokens of their own.  Fixed values of the tokenizer.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


@dataclass
class Block:
    """Pre-tokens of a block: token ``k`` is ``text[starts[k]:ends[k]]`` and belongs to text ``owner[k]``."""

    text: str
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    keys: np.ndarray
    checks: np.ndarray

    def word(self, k: int) -> str:
        return self.text[self.starts[k] : self.ends[k]]


class PreTokenizer:
    """Splits as ``tokenizer.pre_tokenizer`` does, special tokens apart."""

    def __init__(self, tokenizer):
        self._probe = tokenizer.pre_tokenizer.pre_tokenize_str
        self._classes = np.full(0x110000, 255, np.uint8)

    def _class_of(self, code: int) -> int:
        char = chr(code)
        for kind, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self._probe(before + char)) == 1:
                return kind
        return SPACE

    def classes(self, codes: np.ndarray) -> np.ndarray:
        found = self._classes[codes]
        if (found == 255).any():
            for code in np.unique(codes[found == 255]):
                self._classes[code] = self._class_of(int(code))
            found = self._classes[codes]
        return found

    def split(self, texts: list[str]) -> Block:
        text = "".join(texts)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(codes)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        edge = np.zeros(n + 1, bool)  # a text starts here, or ends just before
        edge[ends - lengths] = True
        edge[n] = True
        if n == 0:
            empty = np.zeros(0, np.int64)
            return Block(text, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64))
        kind = self.classes(codes)
        run = edge[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = run.copy()
        # The last of several spaces, or a lone one, before anything else in the same text.
        last = np.flatnonzero((kind[:-1] == SPACE) & run[1:] & ~edge[1:n])
        start[last] = True
        plain = last[codes[last] == 0x20]
        start[plain + 1] = False
        self._contractions(codes, kind, run, start, edge)
        starts = np.flatnonzero(start)
        stops = np.append(starts[1:], n)
        owner = np.searchsorted(ends, starts, side="right")
        return Block(text, starts, stops, owner, *fingerprints(codes, starts, stops))

    @staticmethod
    def _contractions(codes, kind, run, start, edge) -> None:
        n = len(codes)
        at = np.flatnonzero((codes[:-1] == 0x27) & run[:-1] & start[:-1] & (kind[1:] == LETTER) & ~edge[1:n])
        if not len(at):
            return
        one = np.isin(codes[at + 1], [ord(c) for c in ONE_LETTER])
        second = np.minimum(at + 2, n - 1)
        inside = (at + 2 < n) & ~edge[second]
        two = np.zeros(len(at), bool)
        for a, b in TWO_LETTERS:
            two |= inside & (codes[at + 1] == ord(a)) & (codes[second] == ord(b))
        start[at[one | two] + 1] = False
        for chosen, length in ((one, 2), (two, 3)):
            after = at[chosen] + length
            start[after[after < n]] = True


#: Odd multipliers of the fingerprints.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


#: Characters that are hashed at a time, so that no array of 64-bit values is as long as a block.
STRIDE = 1 << 17


def fingerprints(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit polynomial hashes of every slice; the slices cover ``codes`` in order."""
    found = [np.empty(len(starts), np.uint64) for _ in BASES]
    cuts = np.unique(np.r_[0, np.searchsorted(starts, np.arange(STRIDE, len(codes), STRIDE)), len(starts)]).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        begin, lengths = starts[a], ends[a:b] - starts[a:b]
        value = codes[begin : ends[b - 1]].astype(np.uint64) + np.uint64(1)
        value = (value * np.uint64(0xD6E8FEB86659FD93)) ^ (value << np.uint64(29))
        place = np.arange(len(value), dtype=np.int32) - np.repeat((starts[a:b] - begin).astype(np.int32), lengths)
        for base, hashes in zip(BASES, found, strict=True):
            powers = np.full(int(lengths.max(initial=1)), base, np.uint64)
            powers[0] = 1
            weight = np.multiply.accumulate(powers)[place]
            weight *= value
            hashed = np.add.reduceat(weight, starts[a:b] - begin)
            hashed ^= hashed >> np.uint64(32)
            hashes[a:b] = hashed * np.uint64(0xFF51AFD7ED558CCD) + lengths.astype(np.uint64)
    return found


def distinct(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Of the pre-tokens, one place of each distinct one, and for every pre-token the number of its like.

    Equal first hashes with unequal second ones are told apart, so both must collide to go wrong.
    """
    order = np.argsort(block.keys, kind="stable")
    a, b = block.keys[order], block.checks[order]
    change = np.ones(len(order), bool)
    change[1:] = a[1:] != a[:-1]
    if (~change[1:] & (b[1:] != b[:-1])).any():
        order = np.lexsort((block.checks, block.keys))
        a, b = block.keys[order], block.checks[order]
        change[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(change) - 1
    return order[change], number


def blocks(batches, size: int, columns: tuple[str, ...] = ("doc_id", "text")) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of record batches, regrouped so that a block has about ``size`` characters (one text at least)."""
    ids: list = []
    texts: list[str] = []
    length = 0
    for batch in batches:
        for part in slices(batch, columns[1], size):
            names = part.schema.names
            ids += part.column(names.index(columns[0])).to_pylist()
            more = [t or "" for t in part.column(names.index(columns[1])).to_pylist()]
            texts += more
            length += sum(map(len, more))
            if length >= size:
                yield ids, texts
                ids, texts, length = [], [], 0
    if ids:
        yield ids, texts
