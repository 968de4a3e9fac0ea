"""N-gram Jaccard join: documents whose sets of word shingles have a similarity of ``threshold`` or more.

Documents with equal sets are one node from the start; all later work is on nodes, so copies cost nothing.  Two sets
of that similarity share one of the first ``n - ceil(t n) + 1`` shingles of each in any common order.  The order puts
frequent shingles last, by a corpus-wide table of counts in which every task enters the shingles it has met often, so
passages that many documents share make few candidates; any table gives the same result.  Nodes that share such a
shingle are compared in three rounds:

1. with the smallest set that has the shingle and with the next smaller one, which joins groups of near copies
   in linear time;
2. where a shingle still has nodes of several components, with a few neighbours in an order by hash that is
   another one for every shingle, so nodes left beside a large group meet members from all over it in linear time;
3. where a shingle has nodes of several components even then, all pairs of different components, in tiles: a tile
   holds the nodes of one shingle in one band of sizes and the band above, as only those can be similar, cut
   into parts of bounded size.  Every node brings its bitmap into the tile, and only pairs whose bitmaps leave room
   for the overlap they need come out of it.  This loses no link between components.

The bits of one set that the other lacks are shingles the other lacks, which bounds the overlap from above.  What
remains is intersected exactly, as sorted arrays of 64-bit shingle hashes, made from the texts of just these documents.

Defined cases: a document without words has an empty set and links to nothing; one with fewer words than a
shingle has one shingle, the whole sequence; repeated rows come out as often as they occur; an empty table gives
an empty result; other columns are ignored.  A row without an id links like any other, but names a component only
if none of its rows has an id.  Rows are told apart by a hash of id and text, so rows that share an id may differ.
A very long text is cut into shingles in one piece.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from palimpsest.llm.bytewords import SOLID, mixed, shingles, slices, words_of
from palimpsest.llm.common import documents_of, spare_name
from palimpsest.llm.components import components
from palimpsest.llm.url_filter import Level, bloom
from palimpsest.operators import ordered
from palimpsest.session import discard, stored

SHINGLE, THRESHOLD = 5, Fraction(3, 4)
#: Cells of the table of frequent shingles (one byte each), how often a task must meet a cell to enter it, and
#: after how many shingles it enters what it has met.
CELL_BITS, OFTEN, MET = 24, 3, 1 << 22
TILE_ROWS = 512
#: Pairs whose bitmaps are compared at a time.
PAIRS = 4096
#: Distances in the order by hash at which neighbours are compared in the second round.
STEPS = (1, 2, 4)
SLICE_BYTES = 2 << 20
#: Bytes of the filter that finds the documents whose texts are needed; a fuller filter only lets more through.
BLOOM_BYTES = 16 << 20


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of distinct shingles per text, and owner and hash of each, sorted by both."""
    found = words_of(texts, SOLID)
    keys, owner, counts = found.keys(), found.owner, found.counts
    hashes = shingles(keys, size)
    whole = np.flatnonzero(owner[: len(hashes)] == owner[size - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    owners, values = [owner[whole]], [hashes[whole]]
    for width in range(1, size):  # texts of fewer words
        short = np.flatnonzero(counts == width)
        if len(short):
            at = found.bounds[short][:, None] + np.arange(width)
            values.append(mixed(shingles(keys[at].ravel(), width)[::width] + np.uint64(width)))
            owners.append(short)
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return np.bincount(owner, minlength=len(texts)), owner, value


def node_of(counts: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One 64-bit name per set, equal for equal sets; that of an empty set is 0."""
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(mixed(value + np.uint64(0x5851F42D4C957F2D)))]
    ends = np.cumsum(counts)
    named = mixed(total[ends] - total[ends - counts] + counts.astype(np.uint64))
    return np.where(counts > 0, named.view(np.int64), 0)


def summaries(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, key, n, node`` per document, and rows ``cell, count`` of a count table of all shingles."""

    def frequent(met: list[np.ndarray]) -> pa.RecordBatch:
        cells, counts = np.unique(np.concatenate(met) >> np.uint64(64 - CELL_BITS), return_counts=True)
        seen = counts >= OFTEN
        none = pa.nulls(int(seen.sum()), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(cells[seen].astype(np.int64)), pa.array(counts[seen])], names
        )

    def run(batches):
        met, held = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                counts, _, value = shingle_sets(part.column(1), size)
                met.append(value)
                held += len(value)
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(counts), pa.array(node_of(counts, value)), none, none], names
                )
                if held > MET:
                    yield frequent(met)
                    met, held = [], 0
        if met:
            yield frequent(met)

    names = ["doc_id", "key", "n", "node", "cell", "count"]
    return docs.select("doc_id", "text", "key").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def crowding(summary: DataFrame) -> np.ndarray:
    """By cell the logarithm of its count; one byte per cell whatever the data."""
    counted = summary.filter(F.col("cell").isNotNull()).groupBy("cell").agg(F.sum("count").alias("count"))
    level = counted.select("cell", F.log2(F.col("count").cast("double")).cast("int").alias("level"))
    cells = np.zeros(1 << CELL_BITS, np.uint8)
    # Rows of one level come as bitmaps, so at most one bit per cell and level reaches the driver.
    words = level.groupBy("level", (F.col("cell") / 64).cast("long").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(cell % 64 as int)))").alias("bits")
    )
    for row in words.toLocalIterator():
        bits = np.unpackbits(np.array([row["bits"]], np.int64).view(np.uint8), bitorder="little")
        cells[row["word"] * 64 + np.flatnonzero(bits)] = row["level"]
    return cells


def bits_of(value: np.ndarray) -> bytes:
    """A bitmap of two bits per shingle or more, up to a limit."""
    width = 1 << min(15, max(6, int(2 * len(value) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(value & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def frequent_level() -> int:
    """The level in the table from which on a shingle may have a hot group."""
    return int(np.log2(ordered.HOT_ROWS)) - 1


def prefixes(docs: DataFrame, classes: np.ndarray, size: int, threshold: Fraction) -> DataFrame:
    """``node, n, bits, calm, prefix`` of every document with shingles; rows of equal sets are equal.

    The shingles of the prefix from place ``calm`` on may be frequent: the table counts enough for a hot group.
    """
    frequent = frequent_level()
    sent = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        up, down = threshold.numerator, threshold.denominator
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                counts, owner, value = shingle_sets(part.column(1), size)
                level = sent.value[(value >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                order = np.lexsort((value, level, owner))
                ranked = value[order].view(np.int64)
                calm = np.bincount(owner[level < frequent], minlength=len(counts))
                ends = np.cumsum(counts)
                take = np.where(counts > 0, counts - -(-counts * up // down) + 1, 0)
                full = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node_of(counts, value)[full]), pa.array(counts[full]),
                        pa.array([bits_of(value[ends[k] - counts[k] : ends[k]]) for k in full], pa.binary()),
                        pa.array(calm[full]),
                        pa.array([ranked[ends[k] - counts[k] : ends[k] - counts[k] + take[k]] for k in full], pa.list_(pa.int64())),
                    ],
                    ["node", "n", "bits", "calm", "prefix"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "node bigint, n bigint, bits binary, calm bigint, prefix array<bigint>")


def shared_prefixes(nodes: DataFrame, crowd: bool) -> DataFrame:
    """``h, at, node, n``: prefix shingles that several nodes have, with the smallest such set and the next smaller.

    ``crowd`` tells whether any shingle is frequent enough for a hot group.
    """
    places = nodes.select("node", "n", "calm", F.posexplode("prefix").alias("at", "h"))
    # What is null everywhere costs the shuffle nothing.
    rows, split = places.withColumns({ordered.CELL: F.lit(0), "calm": F.lit(None).cast("bigint")}), False
    if crowd:
        rows, split = ordered.split_hot(places, ["h"], ["n", "node"], among=F.col("at") >= F.col("calm"))
    by_shingle = Window.partitionBy("h", ordered.CELL).orderBy("n", "node")
    found = rows.withColumns(
        {
            "before": F.lag("node").over(by_shingle),
            "before_n": F.lag("n").over(by_shingle),
            "after": F.lead("node").over(by_shingle),
            "leader": F.first("node").over(by_shingle),
            "leader_n": F.first("n").over(by_shingle),
        }
    )
    if split:
        # The first of a cell follows the last of the cell before; every cell has a leader of its own.
        ends = rows.filter(F.col(ordered.CELL).isNotNull()).groupBy("h", ordered.CELL)
        ends = ends.agg(F.max(F.struct("n", "node")).alias("end"))
        ends = ends.withColumn("end", F.lag("end").over(Window.partitionBy("h").orderBy(ordered.CELL)))
        found = found.join(ends, ["h", ordered.CELL], "left").withColumns(
            {"before": F.coalesce("before", "end.node"), "before_n": F.coalesce("before_n", "end.n")}
        )
    alone = F.col("before").isNull() & F.col("after").isNull()
    return found.filter(~alone).select("h", "at", "node", "n", "calm", "before", "before_n", "leader", "leader_n")


def sizes_fit(a: str, b: str, threshold: Fraction) -> F.Column:
    small, large = F.least(a, b), F.greatest(a, b)
    return small * threshold.denominator >= large * threshold.numerator


def open_rows(shared: DataFrame, component_of: DataFrame) -> DataFrame:
    """``h, at, crowded, node, n, component`` of the shingles whose nodes lie in several components.

    Shingles with the same nodes, as those of one shared passage, are taken together under the hash of their nodes;
    a node's place is then the first it has any of them at.  Equal hashes of other sets only add pairs to compare.
    """
    rows = shared.select("h", "at", "node", "n", "calm").join(component_of, "node", "left")
    rows = stored(rows.withColumn("component", F.coalesce("component", "node")), "shingle-nodes")
    sets = rows.groupBy("h").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.bit_xor(F.xxhash64("node")).alias("same")
    )
    open_ = rows.join(sets.filter(F.col("x") != F.col("y")).select("h", "same"), "h")
    found = open_.groupBy(F.col("same").alias("h"), "node").agg(
        F.min("at").alias("at"), F.bool_or(F.coalesce(F.col("at") >= F.col("calm"), F.lit(False))).alias("crowded"),
        F.first("n").alias("n"), F.first("component").alias("component"),
    )
    found = stored(found, "open-rows")
    discard(rows)
    return found


def neighbour_pairs(rows: DataFrame, threshold: Fraction, crowd: bool) -> DataFrame:
    """Pairs of nodes of different components that stand ``STEPS`` apart among the nodes of a shingle."""
    cells = rows.withColumn("drawn", F.xxhash64("node", "h"))
    if crowd:
        # Across the bounds of a hot shingle's cells neighbours are not sought; the next round finds what they would.
        cells, _ = ordered.split_hot(cells, ["h"], ["drawn", "node"], among=F.col("crowded"))
    else:
        cells = cells.withColumn(ordered.CELL, F.lit(0))
    by_hash = Window.partitionBy("h", ordered.CELL).orderBy("drawn", "node")
    mine = F.struct("node", "n", "component", "at")
    near = cells.withColumns({f"before_{k}": F.lag(mine, k).over(by_hash) for k in STEPS})
    met = near.select("node", "n", "component", "at", F.explode(F.array(*(f"before_{k}" for k in STEPS))).alias("o"))
    # A pair that needs this overlap shares a shingle this early in both.
    total = (F.col("n") + F.col("o.n")) * threshold.numerator
    need = F.ceil(total / (threshold.numerator + threshold.denominator))
    return (
        met.filter(F.col("component") != F.col("o.component"))
        .filter(sizes_fit("n", "o.n", threshold))
        .filter((F.col("at") <= F.col("n") - need) & (F.col("o.at") <= F.col("o.n") - need))
        .select(
            F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b"),
            F.when(F.col("node") < F.col("o.node"), F.col("n")).otherwise(F.col("o.n")).alias("a_n"),
            F.when(F.col("node") < F.col("o.node"), F.col("o.n")).otherwise(F.col("n")).alias("b_n"),
        )
        .distinct()
    )


def cross_pairs(rows: DataFrame, nodes: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs of nodes that share a prefix shingle, lie in different components and may be similar by their bitmaps."""
    ratio = float(np.log(threshold.denominator / threshold.numerator))
    band = F.floor(F.log(F.col("n").cast("double")) / ratio + 1e-9).cast("int")
    rows = rows.join(nodes.select("node", "bits"), "node")
    banded = rows.select("h", "at", "node", "n", "component", "bits", band.alias("band"))
    banded = banded.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("guest")).withColumn("tile", F.col("band") - F.col("guest"))
    # Only tiles with two components, and with someone who is not a guest, can hold a pair.
    size = banded.drop("bits").groupBy("h", "tile").agg(
        F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("parts"),
        F.min("component").alias("x"), F.max("component").alias("y"), F.min("guest").alias("host"),
    )
    size = size.filter((F.col("x") != F.col("y")) & (F.col("host") == 0)).select("h", "tile", "parts")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    parted = banded.join(size, ["h", "tile"]).withColumn("part", part)
    # Parts of a large tile meet in pairs: row of part i goes to (i, k) and (k, i) for every part k.
    met = parted.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select(
        "h", "tile", F.least("part", "k").alias("i"), F.greatest("part", "k").alias("j"), "part", "node", "n", "component", "guest", "at", "bits"
    )
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(count, "h", "tile", "i", "j").sortWithinPartitions("h", "tile", "i", "j", "part", "node")
    return dealt.mapInArrow(_tile_pairs(threshold), "a bigint, b bigint, a_n bigint, b_n bigint").distinct()


class Signatures:
    """Bitmaps of a tile's rows, by width, so that many pairs are compared at once."""

    def __init__(self, bits: pa.Array):
        sizes = pa.compute.binary_length(bits).to_numpy(zero_copy_only=False).astype(np.int64)
        self.width, self.place, self.rows = sizes, np.zeros(len(sizes), np.int64), {}
        for width in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == width)
            self.place[at] = np.arange(len(at))
            whole = b"".join(bits.take(pa.array(at)).to_pylist())
            self.rows[width] = np.frombuffer(whole, np.uint64).reshape(len(at), width // 8)

    def lacking(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits of the rows ``a`` that the rows ``b`` lack, and the other way round; the wider ones are folded."""
        found = np.zeros((2, len(a)), np.int64)
        kind = self.width[a] * (1 << 20) + self.width[b]
        for pair in np.unique(kind).tolist():
            at = np.flatnonzero(kind == pair)
            for cut in range(0, len(at), PAIRS):
                some = at[cut : cut + PAIRS]
                x, y = (self.rows[w][self.place[rows[some]]] for w, rows in ((pair >> 20, a), (pair % (1 << 20), b)))
                words = min(x.shape[1], y.shape[1])
                x, y = (np.bitwise_or.reduce(z.reshape(len(some), -1, words), 1) for z in (x, y))
                found[0, some] = np.bitwise_count(x & ~y).sum(1)
                found[1, some] = np.bitwise_count(y & ~x).sum(1)
        return found[0], found[1]


def _tile_pairs(threshold: Fraction):
    columns = ("h", "tile", "i", "j", "part", "node", "n", "component", "guest", "at")
    up, down = threshold.numerator, threshold.denominator

    def pairs(rows, bits):
        h, tile, i, j, part, node, n, component, guest, at = rows
        signatures = Signatures(bits)
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (tile[1:] != tile[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        first = np.flatnonzero(new)
        end = np.repeat(np.r_[first[1:], len(h)], np.diff(np.r_[first, len(h)]))
        found = []
        alive = np.arange(len(h))
        step = 1
        while len(alive := alive[alive + step < end[alive]]):
            a, b = alive, alive + step
            good = (component[a] != component[b]) & ((guest[a] == 0) | (guest[b] == 0))
            good &= (i[a] == j[a]) | (part[a] != part[b])
            good &= np.minimum(n[a], n[b]) * down >= np.maximum(n[a], n[b]) * up
            a, b = a[good], b[good]
            # A pair that needs this overlap shares a shingle this early in both.
            need = least_overlap(n[a], n[b], threshold)
            good = (at[a] <= n[a] - need) & (at[b] <= n[b] - need)
            a, b, need = a[good], b[good], need[good]
            lacks_b, lacks_a = signatures.lacking(a, b)
            good = np.minimum(n[a] - lacks_b, n[b] - lacks_a) >= need
            a, b = a[good], b[good]
            swap = node[a] > node[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            found.append(np.stack([node[a], node[b], n[a], n[b]]))
            step += 1
        whole = np.concatenate(found, 1) if found else np.zeros((4, 0), np.int64)
        return np.unique(whole, axis=1)

    def run(batches):
        held, waiting = None, []
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            rows = [table.column(c).to_numpy().astype(np.int64) for c in columns]
            same = np.ones(len(rows[0]), bool)
            for c in range(4):
                same &= rows[c] == rows[c][-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = table.slice(cut)
            if cut:
                waiting.append(pairs([x[:cut] for x in rows], table.column("bits").slice(0, cut).combine_chunks()))
            if sum(x.shape[1] for x in waiting) > 1 << 19:
                yield _pair_batch(np.unique(np.concatenate(waiting, 1), axis=1))
                waiting = []
        if held is not None and held.num_rows:
            waiting.append(pairs([held.column(c).to_numpy().astype(np.int64) for c in columns], held.column("bits").combine_chunks()))
        if waiting:
            yield _pair_batch(np.unique(np.concatenate(waiting, 1), axis=1))

    return run


def _pair_batch(found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b", "a_n", "b_n"])


def least_overlap(a: np.ndarray, b: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Shared shingles that two sets of these sizes need: ``t / (1 + t)`` of both sizes, rounded up."""
    up, down = threshold.numerator, threshold.denominator
    return -(-(a + b) * up // (up + down))


def folded(bits: bytes, size: int) -> np.ndarray:
    found = np.frombuffer(bits, np.uint8)
    return np.bitwise_or.reduce(found.reshape(-1, size), 0) if len(found) > size else found


def _bounded(threshold: Fraction):
    """Keeps pairs whose bitmaps leave room for the overlap they need."""

    def run(batches):
        for batch in batches:
            column = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            a_n, b_n = column["a_n"].to_numpy(), column["b_n"].to_numpy()
            need = least_overlap(a_n, b_n, threshold)
            good = np.zeros(batch.num_rows, bool)
            both = zip(column["a_bits"].to_pylist(), column["b_bits"].to_pylist(), strict=True)
            for k, (x, y) in enumerate(both):
                size = min(len(x), len(y))
                x, y = folded(x, size), folded(y, size)
                lacks_y = int(np.bitwise_count(x & ~y).sum())
                lacks_x = int(np.bitwise_count(y & ~x).sum())
                good[k] = min(a_n[k] - lacks_y, b_n[k] - lacks_x) >= need[k]
            yield pa.RecordBatch.from_arrays([column[c] for c in ("a", "b", "a_n", "b_n")], ["a", "b", "a_n", "b_n"]).filter(
                pa.array(good)
            )

    return run


def _exact(threshold: Fraction):
    def run(batches):
        for batch in batches:
            column = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            need = least_overlap(column["a_n"].to_numpy(), column["b_n"].to_numpy(), threshold)
            good = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(column[c][k].as_buffer(), np.uint64) for c in ("a_set", "b_set"))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                good[k] = int((y[at] == x).sum()) >= need[k]
            yield pa.RecordBatch.from_arrays([column["a"], column["b"]], ["a", "b"]).filter(pa.array(good))

    return run


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, items``: the sorted hashes of the wanted sets; ``wanted`` has ``node`` and the ``key`` of a row with it.

    Rows are found by a filter of bounded size while the table is read, then by their key, so only texts of wanted
    nodes move, one for each.
    """
    hashes = [F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2")]
    level = bloom(wanted.select(*hashes), BLOOM_BYTES)
    parts = level.words, level.size, level.salt
    sent = docs.sparkSession.sparkContext.broadcast(parts)

    def near(batches):
        level = Level(*sent.value)
        for batch in batches:
            h1, h2 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("h1", "h2"))
            yield batch.select(["key", "text"]).filter(pa.array(level.has(h1, h2)))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                counts, _, value = shingle_sets(part.column(part.schema.get_field_index("text")), size)
                ends = np.cumsum(counts)
                sets = [value[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "items"])

    some = docs.select("key", "text", *hashes).mapInArrow(near, "key bigint, text string")
    # Rows equal in id and text have one key.
    texts = some.join(wanted, "key").groupBy("node").agg(F.first("text").alias("text"))
    return texts.mapInArrow(run, "node bigint, items binary")


def exact(pairs: DataFrame, members: DataFrame, docs: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """The pairs ``a, b`` (with ``a_n, b_n``) that are similar, by intersection."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(members.join(nodes, "node", "left_semi"), "wanted-nodes")
    sets = stored(sets_of(docs, wanted, size), "shingle-sets")
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("items").alias(f"{side}_set")), side)
    return pairs.select("a", "b", "a_n", "b_n", "a_set", "b_set").mapInArrow(_exact(threshold), "a bigint, b bigint")


def bounded(pairs: DataFrame, nodes: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs whose bitmaps leave room for the overlap they need."""
    for side in ("a", "b"):
        bits = nodes.select(F.col("node").alias(side), F.col("bits").alias(f"{side}_bits"))
        pairs = pairs.join(bits, side)
    left = pairs.select("a", "b", "a_n", "b_n", "a_bits", "b_bits").mapInArrow(
        _bounded(threshold), "a bigint, b bigint, a_n bigint, b_n bigint"
    )
    return stored(left, "bounded-pairs")


def _with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "key") -> DataFrame:
    """``docs`` with a hash of id and text, by which rows are told apart."""
    return docs.withColumn(name, F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string")))


def _placed(docs: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """``doc_id, key, n, part`` of every row (``doc_id, text, key``): rows with the same part are one component."""
    summary = stored(summaries(docs, size), "summaries")
    classes = crowding(summary)
    members = summary.filter(F.col("cell").isNull()).select("doc_id", "key", "n", "node")
    # One row stands for all with its set.
    first = stored(members.filter(F.col("n") > 0).groupBy("node").agg(F.min("key").alias("key")), "representatives")
    rows = prefixes(docs, classes, size, threshold)
    columns = ("n", "bits", "calm", "prefix")
    nodes = stored(rows.groupBy("node").agg(*(F.first(c).alias(c) for c in columns)), "nodes")
    crowd = bool((classes >= frequent_level()).any())
    shared = stored(shared_prefixes(nodes, crowd), "shared-shingles")
    met = F.explode(
        F.array(*(F.struct(F.col(c).alias("node"), F.col(f"{c}_n").alias("n")) for c in ("leader", "before")))
    )
    stars = (
        shared.select("node", "n", met.alias("other"))
        .select(F.col("other.node").alias("a"), F.col("node").alias("b"), F.col("other.n").alias("a_n"), F.col("n").alias("b_n"))
        .filter(F.col("a") != F.col("b"))
        .filter(sizes_fit("a_n", "b_n", threshold))
        .distinct()
    )
    links = exact(bounded(stars, nodes, threshold), first, docs, size, threshold)
    whole = stored(components(stored(links, "star-links")), "star-components")
    for tiles in (False, True):
        rows = open_rows(shared, whole)
        if tiles:
            pairs = stored(cross_pairs(rows, nodes, threshold), "tile-pairs")
        else:
            pairs = bounded(neighbour_pairs(rows, threshold, crowd), nodes, threshold)
        more = exact(pairs, first, docs, size, threshold)
        tree = whole.select(F.col("node").alias("a"), F.col("component").alias("b"))
        whole = stored(components(tree.unionByName(more)), "components")
    placed = members.join(whole, "node", "left").withColumn("part", F.coalesce("component", "node"))
    return stored(placed.select("doc_id", "key", "n", "part"), "placed")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: Fraction = THRESHOLD
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``, the component's smallest id being its name."""
    placed = _placed(_with_key(documents_of(docs, id_col, text_col)), size, threshold)
    smallest = placed.filter(F.col("n") > 0).groupBy("part").agg(F.min("doc_id").alias("smallest"))
    named = placed.filter(F.col("n") > 0).join(stored(smallest, "names"), "part").select("doc_id", "n", "smallest")
    alone = placed.filter(F.col("n") == 0).select("doc_id", "n", F.col("doc_id").alias("smallest"))
    return named.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), F.col("smallest").alias("component_id"))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are not the first of their component, all columns as they were.

    The first has the smallest id, a null one coming last; of rows with that id and different texts one stays.  Rows
    equal in id and text share their fate.  Documents without words stay.
    """
    placed = _placed(_with_key(documents_of(docs, id_col, text_col)), SHINGLE, THRESHOLD).filter(F.col("n") > 0)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("key").alias("key"))
    first = placed.groupBy("part").agg(F.min(rank).alias("first"))
    name = spare_name(docs, "gone_key")
    gone = placed.join(first, "part").filter(F.col("key") != F.col("first.key")).select(F.col("key").alias(name)).distinct()
    own = spare_name(docs, "row_key")
    return _with_key(docs, id_col, text_col, own).join(gone, F.col(own) == F.col(name), "left_anti").drop(own)
