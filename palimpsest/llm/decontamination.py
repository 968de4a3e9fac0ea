"""Benchmark decontamination by a prefix-filtered join of word windows.

A window is ``size`` consecutive words of a benchmark item (a shorter item is one window).  A document word
inside any occurrence of a window is hit.

A window must be contained whole, so the necessary prefix of its set of shingles is a single shingle: the rarest
in the corpus, which keeps the candidates few even for windows of common words.  Shingle frequencies are counted
over all documents first.  Documents are then joined with the prefixes by shingle; a candidate must have room for
the window on both sides (length and position bounds), agree in every word's hash, and finally in every byte.

The windows are sent to the executors in blocks of at most ``block_windows``, a bounded size, and each block is
run against all rows; which items a window stands in is joined afterwards by window.  Documents are not shuffled.

Defined cases: a null or empty text has no words and no hits; an item without words has no window; windows that
several items share count for all of them; repeated rows come out as often as they occur; no items: no hits;
other columns are ignored, or kept by :func:`keep`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from palimpsest.llm.bytewords import ALNUM, Words, shingles, slices, words_of
from palimpsest.llm.common import documents_of, spare_name, words
from palimpsest.session import stored

WINDOW, SHINGLE, BLOCK_WINDOWS = 10, 3, 100_000
SLICE_BYTES = 2 << 20
RESULT = StructType(
    [
        StructField("n_words", LongType()),
        StructField("starts", ArrayType(LongType())),
        StructField("ends", ArrayType(LongType())),
        StructField("windows", ArrayType(StringType())),
    ]
)


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, window, n``: the distinct windows of every item, words joined by blanks."""
    split = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    n = F.least(F.size("w"), F.lit(size))
    places = F.sequence(F.lit(1), F.size("w") - n + 1)
    rows = split.filter(F.size("w") > 0).select(
        "item_id", n.alias("n"), F.explode(F.transform(places, lambda i: F.array_join(F.slice("w", i, n), " "))).alias("window")
    )
    return rows.distinct()


@dataclass
class Windows:
    """A bounded block of distinct windows and the hashes of their words and shingles."""

    text: list[bytes]
    lengths: np.ndarray
    keys: np.ndarray  # one row per window, ``size`` columns
    shingle_of: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by width: hash, window, offset

    @staticmethod
    def of(texts: list[str], size: int) -> Windows:
        found = words_of(pa.array(texts, pa.string()), ALNUM)
        hashes, lengths = found.keys(), found.counts
        keys = np.zeros((len(texts), size), np.uint64)
        keys[found.owner, np.arange(len(hashes)) - found.bounds[found.owner]] = hashes
        groups = {}
        for width in range(1, SHINGLE + 1):
            chosen = np.flatnonzero(np.minimum(lengths, SHINGLE) == width)
            rows, at, value = [], [], []
            for offset in range(size - width + 1):
                fits = chosen[lengths[chosen] >= offset + width]
                if len(fits):
                    rows.append(fits)
                    at.append(np.full(len(fits), offset))
                    value.append(shingles(keys[fits, offset : offset + width].ravel(), width)[::width])
            if rows:
                groups[width] = tuple(np.concatenate(x) for x in (value, rows, at))
        return Windows([t.encode() for t in texts], lengths, keys, groups)

    def counted(self) -> np.ndarray:
        """All distinct shingles, sorted."""
        return np.unique(np.concatenate([g[0] for g in self.shingle_of.values()]))

    def prefixes(self, frequency: dict[int, int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By width the rarest shingle of every window, sorted by hash; ties go to the smaller hash."""
        chosen = {}
        for width, (value, row, at) in self.shingle_of.items():
            counts = np.array([frequency.get(v, 0) for v in value.tolist()])
            order = np.lexsort((at, value, counts, row))
            first = order[np.r_[True, row[order][1:] != row[order][:-1]]]
            first = first[np.argsort(value[first], kind="stable")]
            chosen[width] = (value[first], row[first], at[first])
        return chosen


class Sieve:
    """Which of many hashes are in a sorted list: a bit table first, the list for what passes."""

    def __init__(self, listed: np.ndarray):
        self.listed = listed
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(listed & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes found, and the first place of each in the list."""
        some = np.flatnonzero(self.bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.listed, hashes[some]), max(len(self.listed) - 1, 0))
        exact = self.listed[at] == hashes[some] if len(self.listed) else np.zeros(0, bool)
        return some[exact], at[exact]


def inside_texts(found: Words, width: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the shingles that do not run over the end of a text."""
    hashes = shingles(keys, width)
    owner = found.owner
    whole = np.flatnonzero(owner[: len(hashes)] == owner[width - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    return whole, hashes[whole]


def shingle_counts(docs: DataFrame, block: Windows) -> dict[int, int]:
    """Occurrences in all documents of the block's shingles; as many numbers as the bounded block has shingles."""
    listed = block.counted()
    sent = docs.sparkSession.sparkContext.broadcast((listed, sorted(block.shingle_of)))

    def run(batches):
        listed, widths = sent.value
        sieve, total = Sieve(listed), np.zeros(len(listed), np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = words_of(part.column(0), ALNUM)
                keys = found.keys()
                for width in widths:
                    _, at = sieve.places(inside_texts(found, width, keys)[1])
                    total += np.bincount(at, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["k", "n"])

    counted = docs.select("text").mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
    return {int(listed[r["k"]]): r["n"] for r in counted.toLocalIterator()}


def matches(found: Words, block: Windows, prefixes, sieves) -> tuple[np.ndarray, np.ndarray]:
    """Places (word numbers) and windows of all occurrences."""
    keys, owner = found.keys(), found.owner
    starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for width, (value, row, at) in prefixes.items():
        place, hashes = inside_texts(found, width, keys)
        hit, first = sieves[width].places(hashes)
        place = place[hit]
        many = np.searchsorted(value, value[first], side="right") - first
        entry = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        place = np.repeat(place, many)
        window = row[entry]
        start, length = place - at[entry], block.lengths[window]
        text = owner[place] if len(place) else place
        room = (start >= found.bounds[text]) & (start + length <= found.bounds[text + 1])
        start, window, length = start[room], window[room], length[room]
        for k in range(block.keys.shape[1]):
            same = (k >= length) | (keys[np.minimum(start + k, len(keys) - 1)] == block.keys[window, k])
            start, window, length = start[same], window[same], length[same]
        starts.append(start)
        windows.append(window)
    start, window = np.concatenate(starts), np.concatenate(windows)
    exact = [
        b" ".join(found.data[found.starts[j] : found.ends[j]].tobytes() for j in range(s, s + block.lengths[w])) == block.text[w]
        for s, w in zip(start.tolist(), window.tolist(), strict=True)
    ]
    exact = np.array(exact, bool)
    return start[exact], window[exact]


def hits(found: Words, block: Windows, prefixes, sieves) -> pa.StructArray:
    """Per text the number of words, the hit runs and the windows that occur."""
    start, window = matches(found, block, prefixes, sieves)
    n = len(found.bounds) - 1
    change = np.zeros(len(found.starts) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + block.lengths[window], -1)
    inside = np.cumsum(change)[:-1] > 0
    owner = found.owner
    edge = np.ones(len(inside), bool)
    edge[1:] = owner[1:] != owner[:-1]
    first = np.flatnonzero(inside & (edge | ~np.r_[False, inside[:-1]]))
    last = np.flatnonzero(inside & (np.r_[edge[1:], True] | ~np.r_[inside[1:], False]))
    bounds = np.searchsorted(first, found.bounds)
    base = np.repeat(found.bounds[:-1], np.diff(bounds))
    pair = np.unique(owner[start] * np.int64(len(block.text)) + window)
    texts = pa.array([block.text[w].decode() for w in (pair % len(block.text)).tolist()], pa.string())
    held = np.searchsorted(pair // len(block.text), np.arange(n + 1))
    lists = [
        pa.array(found.counts),
        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(first - base)),
        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(last + 1 - base)),
        pa.ListArray.from_arrays(pa.array(held, pa.int32()), texts),
    ]
    return pa.StructArray.from_arrays(lists, [f.name for f in RESULT.fields])


def annotate(docs: DataFrame, items: DataFrame, name: str, text_col: str = "text", size: int = WINDOW,
             block_windows: int = BLOCK_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a list of ``RESULT`` structs as column ``name``, one per block, and the windows of the items."""
    spark = docs.sparkSession
    table = stored(item_windows(items, size), "windows")
    distinct = table.select("window").distinct()
    blocks = max(1, -(-distinct.count() // block_windows))
    number = F.pmod(F.xxhash64("window"), F.lit(blocks))
    prepared = []
    for k in range(blocks):
        texts = [r["window"] for r in distinct.filter(number == k).orderBy("window").toLocalIterator()]
        if not texts:
            continue
        block = Windows.of(texts, size)
        frequency = shingle_counts(docs.select(F.col(text_col).cast("string").alias("text")), block)
        prepared.append(spark.sparkContext.broadcast((block, block.prefixes(frequency))))

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                found = words_of(part.column(part.schema.get_field_index(text_col)), ALNUM)
                results = []
                for sent in prepared:
                    block, prefixes = sent.value
                    results.append(hits(found, block, prefixes, {w: Sieve(p[0]) for w, p in prefixes.items()}))
                if not results:
                    results = [_without(found)]
                n, m = part.num_rows, len(results)
                order = np.arange(n * m).reshape(m, n).T.ravel()
                values = pa.concat_arrays(results).take(pa.array(order))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*part.columns, listed], [*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, ArrayType(RESULT))])), table


def _without(found: Words) -> pa.StructArray:
    n = len(found.bounds) - 1
    empty = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1), pa.int32()), pa.array([], pa.int64()))
    names = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1), pa.int32()), pa.array([], pa.string()))
    return pa.StructArray.from_arrays([pa.array(found.counts), empty, empty, names], [f.name for f in RESULT.fields])


def hit_words(found: str) -> F.Column:
    """Number of words in the union of the runs of all blocks."""
    runs = F.array_sort(
        F.flatten(F.transform(F.col(found), lambda r: F.arrays_zip(r["starts"].alias("s"), r["ends"].alias("e"))))
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    return F.aggregate(
        runs,
        zero,
        lambda a, r: F.struct(
            (a["n"] + F.greatest(r["e"] - F.greatest(r["s"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], r["e"]).alias("to")
        ),
        lambda a: a["n"],
    )


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and the hit runs of every row of ``docs``."""
    found, table = annotate(documents_of(docs, id_col, text_col), items, "found", block_windows=block_windows)
    windows = F.array_sort(F.array_distinct(F.flatten("found.windows")))
    rows = found.select(
        "doc_id",
        F.coalesce(F.element_at("found.n_words", 1), F.lit(0)).cast("long").alias("n_words"),
        hit_words("found").alias("n_hit"),
        F.flatten("found.starts").alias("starts"),
        F.flatten("found.ends").alias("ends"),
        windows.alias("windows"),
    )
    rows = stored(rows.withColumn("set", F.when(F.size("windows") > 0, F.sha2(F.array_join("windows", "\n"), 256))), "hits")
    # Items by distinct set of windows: copies of a passage cost one row here.
    sets = rows.filter(F.col("set").isNotNull()).groupBy("set").agg(F.first("windows").alias("windows"))
    named = (
        sets.select("set", F.explode("windows").alias("window"))
        .join(table.select("window", "item_id"), "window")
        .groupBy("set")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    named = stored(named.select("set", F.size("items").cast("long").alias("n"), F.array_join("items", ",").alias("list")), "sets")
    return rows.join(named, "set", "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce("n", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("list", F.lit("")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "starts",
        "ends",
    )


def keep(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any hit, all columns as they were; one pass, no shuffle."""
    name = spare_name(docs, "contamination")
    found, _ = annotate(docs, items, name, text_col)
    return found.filter(~F.exists(name, lambda r: F.size(r["starts"]) > 0)).drop(name)
