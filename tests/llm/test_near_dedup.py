"""The n-gram Jaccard join under null ids, shared ids, hot groups and repeated rows, against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from palimpsest.llm import near_dedup
from palimpsest.operators import ordered


def shingles_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def components_of(texts):
    """The number of the component of each text; texts without words are alone."""
    sets = [shingles_of(t) for t in texts]
    name = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((name[i], name[j]))
                name = [a if x == b else x for x in name]
    return [len(s) for s in sets], name


def copies(seed, n, words, edits):
    rng = random.Random(seed)
    base = [f"w{seed}x{rng.randrange(400)}" for _ in range(words)]
    found = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"edit{rng.randrange(9)}"
        found.append(" ".join(copy))
    return found


def corpus():
    """A group of near copies, guests that share half of its text, a third of all rows equal, and awkward texts."""
    group = copies(1, 60, 100, 4)
    guests = [" ".join(t.split()[:k] + copies(50 + k, 1, 100 - k, 0)[0].split()) for k, t in zip(range(40, 95, 3), group, strict=False)]
    passage = " ".join(f"p{i}" for i in range(30))
    sharing = [copies(90 + k, 1, 30 + 4 * k, 0)[0] + " " + passage for k in range(25)]
    same = [group[0]] * 60
    return [*group, *guests, *sharing, *same, None, "", " \n", "one", "One", "two words", *copies(7, 2, 6000, 40)]


@pytest.mark.parametrize("hot_rows, tile_rows", [(1 << 20, 512), (8, 4)])
def test_groups(documents, monkeypatch, hot_rows, tile_rows):
    monkeypatch.setattr(near_dedup, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(ordered, "HOT_ROWS", hot_rows)
    split = ordered.split_hot
    monkeypatch.setattr(ordered, "split_hot", lambda df, keys, order, among=None: split(df, keys, order, hot_rows, among))
    texts = corpus()
    random.Random(2).shuffle(texts)
    # Every fifth row has no id, and some rows share one.
    ids = [None if k % 5 == 0 else k // 2 * 2 if k % 7 == 0 else k for k in range(len(texts))]
    got = near_dedup.near_duplicates(documents(texts, ids)).collect()
    sizes, name = components_of(texts)
    smallest = {}
    for doc, part in zip(ids, name, strict=True):
        if doc is not None:
            smallest[part] = min(doc, smallest.get(part, doc))
    expected = [(i, n, i if n == 0 else smallest.get(part)) for i, n, part in zip(ids, sizes, name, strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_a_row_without_id_links_others(documents):
    words = [f"w{i}" for i in range(60)]
    left, middle, right = (" ".join(words[a:b]) for a, b in ((0, 46), (4, 52), (9, 56)))
    texts = [left, middle, right]
    assert components_of(texts)[1] == [0, 0, 0] and components_of([left, right])[1] == [0, 1]
    got = near_dedup.near_duplicates(documents(texts, [9, None, 5])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(9, 5), (None, 5), (5, 5)}
    kept = near_dedup.keep(documents(texts, [9, None, 5])).collect()
    assert [r.doc_id for r in kept] == [5]


def test_keep_goes_by_row(documents):
    near = copies(3, 6, 80, 1)
    clean = copies(4, 1, 80, 0)[0]
    # The clean text shares an id with a near copy; one row is there twice; a near copy has no id.
    texts = [near[0], near[1], clean, near[2], near[0], None]
    docs = documents(texts, [1, 2, 2, None, 1, 7])
    kept = sorted(((r.doc_id, r.text) for r in near_dedup.keep(docs).collect()), key=str)
    assert kept == sorted([(1, near[0]), (1, near[0]), (2, clean), (7, None)], key=str)
    assert near_dedup.keep(docs).columns == docs.columns


def test_signatures_bound_the_overlap():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (3, 40, 700, 9000, 40_000)]
    sets += [np.unique(np.r_[s[: len(s) // 2], rng.integers(0, 2**63, len(s) // 2, dtype=np.uint64)]) for s in sets]
    tile = near_dedup.Signatures(pa.array([near_dedup.bits_of(s) for s in sets], pa.binary()))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    lacks_b, lacks_a = tile.lacking(a, b)
    for i, j, x, y in zip(a, b, lacks_b, lacks_a, strict=True):
        shared = len(np.intersect1d(sets[i], sets[j]))
        assert shared <= min(len(sets[i]) - x, len(sets[j]) - y)
