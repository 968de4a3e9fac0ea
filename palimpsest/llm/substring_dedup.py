"""Suffix-array dedup: removes every byte covered by a ``length``-byte string that also starts elsewhere.

A suffix array of the whole corpus would have to be built in one place, so the starts of strings are dealt out
by content: every string of ``length`` bytes has an anchor, the ``GRAM``-byte gram inside it with the smallest
hash, and equal strings have equal anchors at equal places.  The starts with one anchor are consecutive; with the
bytes that their strings cover they make a context.

1. All contexts are counted by hash, copies being merged map-side.  A context whose anchor occurs once has no
   repeats.  A context that occurs twice or more repeats in all its starts.
2. Different contexts with one anchor meet in one task, where a suffix array of them (linear grouping, see
   :mod:`palimpsest.llm.suffix_groups`) brings equal strings side by side, and neighbours are compared byte by
   byte.
3. Anchors with more different contexts than ``MAX_BYTES`` (a passage in very many documents) are resolved by
   counting the hashes of their strings instead, so no group is collected.

The starts found become spans, the spans of a document are merged, and the bytes are cut.  Texts are read three
times; only texts with something to remove are shuffled, by a filter of bounded size.

Defined cases: a null text is empty; overlaps count; repeated rows count as documents of their own and come out
as often as they occur; texts shorter than ``length`` lose nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from palimpsest.llm.bytewords import mixed, slices
from palimpsest.llm.common import documents_of, thrifty
from palimpsest.llm.suffix_groups import ranges, suffix_arrays
from palimpsest.llm.url_filter import bloom
from palimpsest.session import stored

LENGTH, GRAM, MAX_BYTES = 200, 64, 8192
SLICE_BYTES, BATCH_BYTES, BUNDLE = 1 << 20, 1 << 20, 700
BLOOM_BYTES = 16 << 20
TURN = 0x5851F42D4C957F2D
MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def window_hashes(data: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from every place on."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value = mixed(data.astype(np.uint64) + np.uint64(1 + (salt << 9)))
    base = (MULTIPLIER * (2 * salt + 1)) % 2**64
    # Doubling: the hash of 2k bytes from those of k, so a width takes a dozen passes.
    total, power, have, result, taken = value, base, 1, None, 0
    while True:
        if width & have:
            if result is None:
                result, taken = total, have
            else:  # append ``have`` bytes behind the ``taken`` ones
                result = result[: len(total) - taken] * np.uint64(power) + total[taken:]
                taken += have
        if have * 2 > width:
            return mixed(result[:n])
        total = total[:-have] * np.uint64(power) + total[have:]
        power = power * power % 2**64
        have *= 2


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n - 1)`` modulo 2**64; those of one slice are kept."""
    if len(_POWERS.get(base, ())) < n:
        found = np.full(max(n, SLICE_BYTES + (1 << 18)), base, np.uint64)
        found[0] = 1
        found = np.multiply.accumulate(found)
        _POWERS[base] = found
    return _POWERS[base][:n]


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    size = -(-len(x) // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    right = np.minimum.accumulate(blocks, 1).ravel()
    return np.minimum(left[:n], right[width - 1 : width - 1 + n])


def contexts(texts: pa.Array, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``owner, start, count, anchor, mark`` of all contexts, and the bytes and edges of the texts."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    edges = offsets - offsets[0]
    sizes = np.diff(edges)
    if len(data) < length or not (sizes >= length).any():
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), data, edges
    grams = window_hashes(data, gram)
    smallest = sliding_minimum(grams, length - gram + 1)
    long_ = np.flatnonzero(sizes >= length)
    starts = ranges(edges[long_], sizes[long_] - length + 1)
    owner = np.repeat(long_, sizes[long_] - length + 1)
    anchor = smallest[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    # In periodic text the next start has an equal gram further on: the first one in a string is its anchor.
    new[1:] |= grams[starts[:-1]] == anchor[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(starts)])
    place = starts[first]
    # A context is named by the hashes of its grams in their order.
    forth, back = powers(MULTIPLIER, len(grams)), powers(pow(MULTIPLIER, -1, 2**64), len(grams))
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(grams * forth, out=total[1:])
    mark = mixed((total[place + count + length - gram] - total[place]) * back[place] + count.astype(np.uint64))
    return owner[first], place - edges[owner[first]], count, anchor[first], mark, data, edges


CONTEXT = "anchor bigint, mark bigint, n int, key bigint, start bigint"


def _contexts(length: int, gram: int, known=None):
    """Contexts of all texts; or of those whose anchor the first filter has, with their bytes if the second has it."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                owner, start, count, anchor, mark, data, edges = contexts(part.column(part.schema.get_field_index("text")), length, gram)
                key = part.column(part.schema.get_field_index("key")).to_numpy()
                columns = [anchor.view(np.int64), mark.view(np.int64), count.astype(np.int32), key[owner], start]
                names = ["anchor", "mark", "n", "key", "start"]
                if known is None:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                    continue
                a = anchor.view(np.int64)
                repeated, several = known.value
                kept = np.flatnonzero(repeated.has(a, a ^ np.int64(TURN)))
                at = edges[owner[kept]] + start[kept]
                needed = several.has(a[kept], a[kept] ^ np.int64(TURN))
                body = [
                    data[x : x + c + length - 1].tobytes() if wanted else None
                    for x, c, wanted in zip(at.tolist(), count[kept].tolist(), needed.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*(pa.array(c[kept]) for c in columns), pa.array(body, pa.binary())], [*names, "body"])

    return run


def resolve(anchors: np.ndarray, bodies: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For every context the starts whose string also starts in another context with its anchor."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    # Texts for the suffix arrays: whole anchors, about BUNDLE bytes.
    new = np.r_[True, anchors[1:] != anchors[:-1]]
    group = np.cumsum(new) - 1
    total = np.cumsum(np.bincount(group, sizes).astype(np.int64))
    bundle = (total // BUNDLE)[group]
    last = np.r_[bundle[1:] != bundle[:-1], True]
    flat = np.frombuffer(b"".join(body + b"\0" for body in bodies), np.uint8)
    place = np.cumsum(sizes + 1) - (sizes + 1)
    symbols = flat.astype(np.int64) + 2
    symbols[place + sizes] = 1  # between contexts
    symbols[(place + sizes)[last]] = 0  # at the end of a text
    bounds = np.r_[0, (place + sizes + 1)[last]]
    order = suffix_arrays(symbols, bounds)
    starting = np.zeros(len(flat), bool)
    starting[ranges(place, counts)] = True
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = order[starting[order]]
    x, y = order[:-1], order[1:]
    same = text[x] == text[y]
    x, y = x[same], y[same]
    for k in range(0, length - 7, 8):
        equal = np.ones(len(x), bool)
        for i in range(8):
            equal &= flat[x + k + i] == flat[y + k + i]
        x, y = x[equal], y[equal]
    for i in range(length - length % 8, length):
        equal = flat[x + i] == flat[y + i]
        x, y = x[equal], y[equal]
    found = np.zeros(len(flat), bool)
    found[x] = found[y] = True
    return [np.flatnonzero(found[a : a + c]) for a, c in zip(place.tolist(), counts.tolist(), strict=True)]


def _runs(starts: np.ndarray) -> tuple[list[int], list[int]]:
    if not len(starts):
        return [], []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + 1).tolist()


SPANS = "anchor bigint, mark bigint, n int, a array<bigint>, b array<bigint>"


def _suffix_sorted(length: int):
    """Over contexts sorted by anchor: the runs of repeated starts of each context."""

    def solve(rows):
        anchors = np.array([r[0] for r in rows])
        found = resolve(anchors, [r[3] for r in rows], np.array([r[2] for r in rows]), length)
        spans = [_runs(x) for x in found]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchors), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()),
                pa.array([s[0] for s in spans], pa.list_(pa.int64())), pa.array([s[1] for s in spans], pa.list_(pa.int64())),
            ],
            ["anchor", "mark", "n", "a", "b"],
        )

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for part in slices(batch, "body", BATCH_BYTES):
                columns = [part.column(part.schema.get_field_index(c)).to_pylist() for c in ("anchor", "mark", "n", "body")]
                for row in zip(*columns, strict=True):
                    if held > BATCH_BYTES and row[0] != rows[-1][0]:
                        yield solve(rows)
                        rows, held = [], 0
                    rows.append(row)
                    held += len(row[3])
        if rows:
            yield solve(rows)

    return run


def _strings(length: int):
    """The hashes of all strings of crowded contexts."""

    def run(batches):
        for batch in batches:
            for anchor, mark, n, body in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                data = np.frombuffer(body, np.uint8)
                h1, h2 = (window_hashes(data, length, s)[:n].view(np.int64) for s in (1, 2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, anchor)), pa.array(np.full(n, mark)), pa.array(np.full(n, n), pa.int32()), pa.array(np.arange(n)), pa.array(h1), pa.array(h2)],
                    ["anchor", "mark", "n", "at", "h1", "h2"],
                )

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``key, spans``: by row key the byte ranges ``(start, end)`` covered by repeats.  ``docs`` has ``key, text``."""
    names = ["anchor", "mark", "n"]
    counted = docs.mapInArrow(thrifty(_contexts(length, gram)), CONTEXT).groupBy(*names).agg(F.count(F.lit(1)).alias("times"))
    same_anchor = Window.partitionBy("anchor")
    judged = counted.withColumns(
        {"kinds": F.count(F.lit(1)).over(same_anchor), "bytes": F.sum(F.col("n") + length).over(same_anchor)}
    )
    judged = stored(judged.filter((F.col("times") > 1) | (F.col("kinds") > 1)), "repeated-contexts")
    several = judged.filter(F.col("kinds") > 1)
    filters = tuple(
        bloom(
            stored(x.select("anchor").distinct(), "anchors").select(
                F.col("anchor").alias("h1"), F.col("anchor").bitwiseXOR(F.lit(TURN)).alias("h2")
            ),
            BLOOM_BYTES,
        )
        for x in (judged, several)
    )
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    rows = stored(docs.mapInArrow(thrifty(_contexts(length, gram, sent)), f"{CONTEXT}, body binary"), "context-rows")
    bodies = rows.filter(F.col("body").isNotNull()).groupBy(*names).agg(F.first("body").alias("body"))
    small = bodies.join(several.filter(F.col("bytes") <= max_bytes).select(*names), names, "left_semi")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = small.select(*names, "body").repartition(parts, "anchor").sortWithinPartitions("anchor", "mark")
    by_suffix = sorted_.mapInArrow(thrifty(_suffix_sorted(length)), SPANS)
    crowded = bodies.join(several.filter(F.col("bytes") > max_bytes).select(*names), names, "left_semi").select(*names, "body")
    strings = crowded.mapInArrow(thrifty(_strings(length)), "anchor bigint, mark bigint, n int, at bigint, h1 bigint, h2 bigint")
    strings = stored(strings, "crowded-strings")
    twice = strings.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2")
    by_hash = strings.join(twice, ["h1", "h2"]).select(*names, F.array("at").alias("a"), F.array(F.col("at") + 1).alias("b"))
    whole = judged.filter(F.col("times") > 1).select(*names, F.array(F.lit(0).cast("bigint")).alias("a"), F.array(F.col("n").cast("bigint")).alias("b"))
    # A context can be found whole and in parts; the union is what counts.
    found = by_suffix.filter(F.size("a") > 0).unionByName(by_hash).unionByName(whole)
    found = stored(found.groupBy(*names).agg(F.flatten(F.collect_list(F.arrays_zip("a", "b"))).alias("s")), "repeats")
    spans = rows.select(*names, "key", "start").join(found, names).select(
        "key", F.explode("s").alias("s"), "start"
    )
    merged = spans.select("key", F.struct((F.col("start") + F.col("s.a")).alias("a"), (F.col("start") + F.col("s.b") + length - 1).alias("b")).alias("s"))
    return merged.groupBy("key").agg(F.array_sort(F.collect_set("s")).alias("spans"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row of ``docs``."""
    docs = documents_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    spans = stored(repeated_spans(docs.select("key", "text"), length, gram, max_bytes), "spans")
    level = bloom(spans.select(F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2")), BLOOM_BYTES)
    sent = docs.sparkSession.sparkContext.broadcast(level)

    def perhaps(wanted: bool):
        def run(batches):
            for batch in batches:
                h1, h2 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("h1", "h2"))
                some = batch.filter(pa.array(sent.value.has(h1, h2) == wanted))
                yield some.select(["doc_id", "text", "key"])

        return run

    hashed = docs.select("doc_id", "text", "key", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"))
    kinds = "doc_id bigint, text string, key bigint"
    some = hashed.mapInArrow(perhaps(True), kinds).join(spans, "key", "left").select("doc_id", "text", "spans")
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    rest = hashed.mapInArrow(perhaps(False), kinds).select("doc_id", "text", none.alias("spans"))
    return some.unionByName(rest).mapInArrow(thrifty(_cut), RESULT)


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _cut(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            rows = []
            for doc, text, spans in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                data, kept, at, removed, runs = text.encode(), [], 0, 0, 0
                for span in spans or ():
                    a, b = span["a"], span["b"]
                    if a > at or not runs:
                        kept.append(data[at:a])
                        runs += 1
                        removed += b - a
                        at = b
                    elif b > at:
                        removed += b - at
                        at = b
                kept = b"".join([*kept, data[at:]])
                rows.append((doc, len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )
