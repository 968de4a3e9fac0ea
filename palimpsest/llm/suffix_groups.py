"""Suffix arrays of many short texts at once, by linear grouping.

Suffixes start in groups by first symbol.  Groups are processed from the highest to the lowest: every suffix of
the group points to the nearest suffix before it that lies in a lower group, and the suffixes pointed at move to
new groups right behind their old one, those with more pointers higher.  In the end every group holds the
suffixes with one Lyndon prefix.  A second walk through the order being made emits each group's suffixes by
following the pointers.  Nothing is renamed and there is no recursion.

One text has many small groups, too small for array operations, so all texts of a batch take their steps
together: step ``k`` handles the ``k``-th highest group of every text.
"""

from __future__ import annotations

import numpy as np


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix arrays of all texts, as places in ``symbols``; text ``k`` is ``bounds[k]`` to ``bounds[k + 1]``.

    Every text ends with a symbol that is smaller than its others.
    """
    n, begin, end = len(symbols), bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
    text = np.repeat(np.arange(len(begin)), end - begin)
    order = np.lexsort((symbols, text))
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    first = np.ones(n, bool)
    first[1:] = (symbols[order][1:] != symbols[order][:-1]) | (text[order][1:] != text[order][:-1])
    starts = np.flatnonzero(first)
    group = np.empty(n, np.int64)  # first slot of a suffix's group
    group[order] = np.repeat(starts, np.diff(np.r_[starts, n]))
    group_end = np.zeros(n, np.int64)
    group_end[starts] = np.r_[starts[1:], n]
    low = begin[text]
    pointer = np.full(n, -1, np.int64)
    moved = np.zeros(n, bool)
    top, base = end.copy(), begin.copy()
    while len(top):
        start = group[order[top - 1]]
        members = order[ranges(start, top - start)]
        _point(members, np.repeat(start, top - start), group, pointer, low)
        _regroup(pointer[members], order, slot, group, group_end, moved)
        alive = start > base
        top, base = start[alive], base[alive]
    return _emit(begin, end, low, group, pointer)


def _point(members, level, group, pointer, low) -> None:
    """The nearest suffix before each member in a group below ``level``; -1 if there is none."""
    pointer[members] = members - 1
    open_ = np.arange(len(members))
    while len(open_):
        at = pointer[members[open_]]
        out = at < low[members[open_]]
        pointer[members[open_[out]]] = -1
        inside = ~out
        inside[inside] = group[at[inside]] >= level[open_[inside]]
        open_, at = open_[inside], at[inside]
        # The pointers of the group itself are on their way, those of higher groups have arrived: both may be followed.
        pointer[members[open_]] = pointer[at]


def _regroup(targets, order, slot, group, group_end, moved) -> None:
    targets, times = np.unique(targets[targets >= 0], return_counts=True)
    if not len(targets):
        return
    old = group[targets]
    rank = np.lexsort((times, old))
    targets, times, old = targets[rank], times[rank], old[rank]
    head = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
    sizes = np.diff(np.r_[head, len(old)])
    owner, tail = old[head], group_end[old[head]] - sizes
    places = ranges(tail, sizes)
    moved[targets] = True
    stay = order[places]
    stay = stay[~moved[stay]]
    holes = slot[targets]
    holes = holes[holes < np.repeat(tail, sizes)]
    order[holes] = stay
    slot[stay] = holes
    order[places] = targets
    slot[targets] = places
    moved[targets] = False
    run = np.r_[True, (old[1:] != old[:-1]) | (times[1:] != times[:-1])]
    at = np.flatnonzero(run)
    lengths = np.diff(np.r_[at, len(old)])
    group[targets] = np.repeat(places[at], lengths)
    group_end[owner] = tail
    group_end[places[at]] = places[at] + lengths


def _emit(begin, end, low, group, pointer) -> np.ndarray:
    n = len(group)
    result = np.full(n, -1, np.int64)
    placed = np.zeros(n, bool)
    free = np.arange(n)
    result[begin] = end - 1
    placed[end - 1] = True
    free[begin] += 1
    at = begin.copy()  # the slot being walked through, by text
    now = end - 2
    base, stop = begin, end
    while len(at):
        go = now >= base
        go[go] = ~placed[now[go]]
        suffix = now[go]
        place = free[group[suffix]]
        free[group[suffix]] += 1
        result[place] = suffix
        placed[suffix] = True
        now[go] = pointer[suffix]
        done = ~go
        at[done] += 1
        left = at < stop
        if not left.all():
            at, now, base, stop, done = at[left], now[left], base[left], stop[left], done[left]
        now[done] = result[at[done]] - 1
    return result
