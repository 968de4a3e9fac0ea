"""Runs of repeated words: stretches of a text in which the same words come again and again, four times or more.

A run is a stretch with smallest period ``q`` and a length of ``max(6, 4 q)`` words or more that neither neighbour
extends.  Shifted by its period it overlaps itself in ``max(6, 4 q) - q`` words at least, so among the lags from
``Q`` to ``2 Q - 1`` every run shows a gram of ``k(Q) = max(6, 4 Q) - Q`` words at both ends of its lag.

1. *Seeds.*  For ``Q = 1, 2, 4, ...`` the grams of ``k(Q)`` words that a text repeats are indexed, and every
   occurrence is paired with the next one of the same text; pairs whose lag lies in the octave are seeds.  As a gram
   is not shorter than its lag, two occurrences inside a run that are nearer than its period would give it a
   smaller one; the next occurrence is therefore the one a period on, and there are never more seeds than words.
2. *Extension.*  Seeds are taken by lag and place.  For every lag the furthest covered word is kept: a seed before it
   lies in a stretch that is known already, any other is extended along its diagonal in both directions, word by
   word against the words a lag on.  Stretches that are long enough are the runs.

Grams are told apart exactly: words are numbered per text, and the numbers of longer grams are those of pairs of
shorter ones.  Only places whose gram occurs twice in their text stay in the index, so that it shrinks with ``Q``.

Defined cases: a null or empty text has no words and no run; a null id and repeated rows come out as they came, row
for row; an empty table gives an empty result; other columns are ignored.  A text is looked at whole in one task;
memory grows with the longest text and a slice of ``SLICE_BYTES``, never with the table.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from palimpsest.llm.bytewords import slices
from palimpsest.llm.common import documents_of, thrifty

SLICE_BYTES = 1 << 20
LEAST_LENGTH, LEAST_POWER = 6, 4
RUN = "struct<start: bigint, length: bigint, period: bigint>"
FOUND = f"doc_id bigint, n_words bigint, runs array<{RUN}>, longest {RUN}, collapsed string"


def seed_gram(lag: int) -> int:
    """The words that a run of this period, shifted by it, shares with itself at least."""
    return max(LEAST_LENGTH, LEAST_POWER * lag) - lag


def _pair_names(left: np.ndarray, right: np.ndarray, at: np.ndarray, apart: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``at`` whose gram, ``left`` there and ``right`` ``apart`` words on, occurs more than once; and its number."""
    at = at[at + apart < n]
    at = at[right[at + apart] >= 0]
    if not len(at):
        return at, at
    _, number, times = np.unique((left[at] << np.int64(32)) | right[at + apart], return_inverse=True, return_counts=True)
    again = times[number] > 1
    return at[again], number[again]


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lags, places and gram lengths of all seeds; ``words`` are numbers that no two texts share."""
    n = len(words)
    empty = np.zeros(0, np.int64)
    if not n:
        return empty, empty, empty
    times = np.bincount(words)
    at = np.flatnonzero(times[words] > 1)
    names = {1: np.full(n, -1, np.int64)}
    names[1][at] = words[at]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    places, known, lag = at, 1, 1
    while len(places):
        gram = seed_gram(lag)
        base = 1 << (gram.bit_length() - 1)
        while known < base and len(places):
            places, number = _pair_names(names[known], names[known], places, known, n)
            known *= 2
            names[known] = np.full(n, -1, np.int64)
            names[known][places] = number
        if not len(places):
            break
        at, number = places, names[base][places]
        if gram > base:
            rest = gram - base  # a power of two, for both 5, 6 and 3 Q
            at, number = _pair_names(names[base], names[rest], places, base, n)
        order = np.argsort(number, kind="stable")
        at, number = at[order], number[order]
        apart = at[1:] - at[:-1]
        good = (number[1:] == number[:-1]) & (apart >= lag) & (apart < 2 * lag)
        found.append((apart[good], at[:-1][good], np.full(int(good.sum()), gram)))
        lag *= 2
        for size in [s for s in names if s < min(lag, known)]:
            del names[size]
    if not found:
        return empty, empty, empty
    lags, starts, grams = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((starts, lags))
    return lags[order], starts[order], grams[order]


def _equal_on(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How far the words from ``a`` and from ``b`` agree, going up (``step`` 1) or down (-1)."""
    total, width = 0, 16
    while True:
        room = min(width, len(words) - max(a, b)) if step > 0 else min(width, min(a, b) + 1)
        if room <= 0:
            return total
        x = words[a : a + room] if step > 0 else words[a - room + 1 : a + 1][::-1]
        y = words[b : b + room] if step > 0 else words[b - room + 1 : b + 1][::-1]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return total + int(differ[0])
        total, a, b, width = total + room, a + step * room, b + step * room, width * 2


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every run, by start and period."""
    lags, starts, grams = seeds(words)
    if not len(lags):
        return []
    # A seed right after another on its diagonal is covered by it: only the first of such a row is extended.
    head = np.ones(len(lags), bool)
    head[1:] = (lags[1:] != lags[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(head)
    last = np.r_[first[1:], len(lags)] - 1
    covered: dict[int, int] = {}
    found = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        lag, start = int(lags[a]), int(starts[a])
        if start < covered.get(lag, -1):
            continue
        end = int(starts[b] + grams[b])  # equal to the words a lag on, up to here
        end += _equal_on(words, end, end + lag, 1)
        start -= _equal_on(words, start - 1, start - 1 + lag, -1)
        covered[lag] = end
        if end - start + lag >= max(LEAST_LENGTH, LEAST_POWER * lag):
            found.append((start, end - start + lag, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most repeats; of equal ones that with the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words are left when every run is reduced to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _find(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            texts = [(t or "").encode().split() for t in part.column(1).to_pylist()]  # bytes split at ASCII white space
            numbers, base = [], 0
            for text in texts:
                number = {word: base + k for k, word in enumerate(dict.fromkeys(text))}
                numbers.append(np.fromiter(map(number.__getitem__, text), np.int64, len(text)))
                base += len(number)
            sizes = [len(t) for t in texts]
            ends = np.cumsum(sizes)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for start, length, period in runs_of(np.concatenate(numbers)):
                k = int(np.searchsorted(ends, start, side="right"))
                runs[k].append((start - int(ends[k]) + sizes[k], length, period))
            collapsed = []
            for text, of_text in zip(texts, runs, strict=True):
                if of_text:
                    text = [text[k] for k in np.flatnonzero(kept_words(len(text), of_text)).tolist()]
                collapsed.append(b" ".join(text).decode())
            names = ("start", "length", "period")
            as_rows = [[dict(zip(names, r, strict=True)) for r in of_text] for of_text in runs]
            best = [None if (r := strongest(x)) is None else dict(zip(names, r, strict=True)) for x in runs]
            run = pa.struct([(c, pa.int64()) for c in names])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(as_rows, pa.list_(run)), pa.array(best, run), pa.array(collapsed, pa.string())],
                ["doc_id", "n_words", "runs", "longest", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, longest, collapsed`` for every row of ``docs``.

    ``runs`` are sorted by start and period, ``longest`` is the one with the greatest length in periods, and
    ``collapsed`` is the text with every run reduced to its first period, its words joined by one space.
    """
    return documents_of(docs, id_col, text_col).mapInArrow(thrifty(_find), FOUND)
