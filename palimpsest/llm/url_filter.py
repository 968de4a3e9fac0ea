"""URL filters by a cascade of Bloom filters.

Level 0 holds the listed keys.  Level 1 holds the keys of the corpus that level 0 lets through although they are
not listed, level 2 the listed keys that level 1 lets through, and so on until a level lets nothing wrong
through.  As the corpus's complete set of keys was asked while building, membership is exact for every key of
the corpus, and judging a URL needs no join.

A key is a host suffix at a dot followed by a prefix of the path.  Only shapes (number of labels, length of the
path prefix) that occur in the lists are tried.  Keys are hashed in the JVM; the filters are read as numpy bits.

The filters are sent to all executors; their size is known from the number of keys before they are built.
Beyond ``max_bytes`` the lists are joined by key instead, with the same result.

Defined cases: a null URL or one without ``://`` has an empty host and path, no key, no rule, and verdict
``allow``; repeated rows come out as often as they occur; an empty table or empty lists give no rule; other
columns are ignored.  Of rules of one length that fit one URL (equal ones, or a longer host with a shorter path)
``block`` wins, then the key that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palimpsest.llm.common import lower_ascii
from palimpsest.session import stored

BITS_PER_KEY, HASHES, MAX_LEVELS = 12, 4, 60


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def shapes(rules: Iterable[str]) -> list[tuple[int, int]]:
    """(labels, path length) of every rule, the rule being ``host/path``."""
    found = set()
    for rule in rules:
        host, slash, path = rule.partition("/")
        found.add((host.count(".") + 1, len(slash + path)))
    return sorted(found)


def candidate_keys(host: Column, path: Column, tried: list[tuple[int, int]]) -> Column:
    """The keys of one URL in the given shapes, the longest first."""
    labels = F.split(host, r"\.")
    keys = [
        F.when(
            (F.length(host) > 0) & (F.size(labels) >= n) & (F.length(path) >= length),
            F.concat(F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), "."), F.substring(path, 1, length)),
        )
        for n, length in tried
    ]
    found = F.filter(F.array(*keys), lambda k: k.isNotNull()) if keys else F.array().cast("array<string>")
    lengths_first = F.array_sort(F.transform(found, lambda k: F.struct((-F.length(k)).alias("l"), k.alias("k"))))
    return F.transform(lengths_first, lambda s: s["k"])


class Level:
    """One Bloom filter; ``salt`` makes the levels differ."""

    def __init__(self, words: np.ndarray, size: int, salt: int):
        self.words, self.size, self.salt = words, size, salt

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        inside = np.ones(len(h1), bool)
        for at in positions(h1, h2, self.salt, self.size):
            inside &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return inside


def positions(h1: np.ndarray, h2: np.ndarray, salt: int, size: int) -> Iterator[np.ndarray]:
    a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    turn = np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % 2**64)
    a = (a ^ (b >> np.uint64(29))) * (turn | np.uint64(1))
    for i in range(HASHES):
        yield ((a + np.uint64(i) * b) >> np.uint64(17)) % np.uint64(size)


class Cascade:
    def __init__(self, levels: list[Level]):
        self.levels = levels

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for the keys of the universe the cascade was built over."""
        answer = np.zeros(len(h1), bool)
        open_ = np.arange(len(h1))
        for depth, level in enumerate(self.levels):
            through = level.has(h1[open_], h2[open_])
            # A key that even levels refuse is not listed, one that odd levels refuse is.
            answer[open_[~through]] = depth % 2 == 1
            open_ = open_[through]
        answer[open_] = len(self.levels) % 2 == 1
        return answer


def hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit("second")).alias("h2"))


def bloom(keys: DataFrame, max_bytes: int) -> Level:
    """A filter of the keys ``h1, h2`` of at most ``max_bytes``; when full it only lets more through."""
    return _level(keys, keys.count(), 0, max_bytes)


def _level(keys: DataFrame, count: int, salt: int, max_bytes: int = 1 << 40) -> Level:
    """Set the bits of all keys: each task gives the words it has touched, the words are merged by ``bit_or``."""
    size = max(64, min(max_bytes * 8, -(-count * BITS_PER_KEY // 64) * 64))

    def bits(batches):
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            at = np.concatenate(list(positions(h1, h2, salt, size)))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            order = np.argsort(word, kind="stable")
            word, bit = word[order], bit[order]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][: len(word)])
            merged = np.bitwise_or.reduceat(bit, first) if len(word) else bit
            yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(merged.view(np.int64))], ["word", "bits"])

    merged = keys.select("h1", "h2").mapInArrow(bits, "word long, bits long").groupBy("word").agg(
        F.expr("bit_or(bits)").alias("bits")
    )
    words = np.zeros(size // 64, np.uint64)
    for row in merged.toLocalIterator():
        words[row["word"]] = np.int64(row["bits"]).view(np.uint64)
    return Level(words, size, salt)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """``listed`` and ``universe`` have one row per distinct key (column ``key``)."""
    inside = stored(hashed(listed), "listed-keys")
    outside = stored(hashed(universe.join(listed, "key", "left_anti")), "other-keys")
    levels: list[Level] = []
    turn, waiting = inside, outside
    while True:
        count = turn.count()
        if count == 0:
            return Cascade(levels or [Level(np.zeros(1, np.uint64), 64, 0)])
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: two keys have the same pair of hashes")
        level = _level(turn, count, len(levels))
        levels.append(level)
        passed = waiting.mapInArrow(_passing(level), waiting.schema)
        turn, waiting = stored(passed, "passed-keys"), turn


def _passing(level: Level):
    def run(batches):
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            yield batch.filter(pa.array(level.has(h1, h2)))

    return run


def judge(
    pages: DataFrame,
    block: list[str],
    allow: list[str],
    listed: DataFrame | list[str],
    id_col: str = "page_id",
    url_col: str = "url",
    max_bytes: int = 64 << 20,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every page.

    ``block`` and ``allow`` are rules like ``example.net/en/``; the longest that fits decides.  Where none fits,
    a URL with a key in ``listed`` (the block list proper, a column ``key`` of such rules) is blocked.
    """
    spark = pages.sparkSession
    own = keys_frame(spark, listed) if isinstance(listed, list) else listed.select("key").distinct()
    own = stored(own, "block-list")
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    tried = sorted(set(shapes([*block, *allow])) | set(_shapes_of(own)))
    rows = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), tried))
    lists = [keys_frame(spark, block), keys_frame(spark, allow), own]
    size = sum(x.count() for x in lists) * BITS_PER_KEY // 8
    if size > max_bytes:
        return _judge_by_join(rows, lists)
    universe = stored(rows.select(F.explode("keys").alias("key")).distinct(), "universe")
    cascades = [build_cascade(x, universe) for x in lists]
    sent = spark.sparkContext.broadcast(cascades)

    def run(batches):
        for batch in batches:
            keys, h1, h2 = (batch.column(batch.schema.get_field_index(c)) for c in ("keys", "h1", "h2"))
            sizes = np.diff(keys.offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            a, b = (x.flatten().to_numpy(zero_copy_only=False) for x in (h1, h2))
            names = keys.flatten()
            blocked, allowed, own_ = (c.has(a, b) for c in sent.value)
            hit = np.flatnonzero(blocked | allowed)
            lengths = pc.utf8_length(names.take(pa.array(hit))).to_numpy(zero_copy_only=False)
            hit = hit[np.lexsort((hit, ~blocked[hit], -lengths, row[hit]))]
            first, at = np.unique(row[hit], return_index=True)
            which = np.full(batch.num_rows, -1)
            which[first] = hit[at]
            by_list = np.zeros(batch.num_rows, bool)
            by_list[row[own_]] = True
            ruled = which >= 0
            stop = np.where(ruled, blocked[which] if len(blocked) else False, by_list)
            rule = names.take(pa.array(which, mask=~ruled))
            verdict = pa.array(np.where(stop, "block", "allow"), pa.string())
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "host", "path")]
            yield pa.RecordBatch.from_arrays(
                [*kept, rule.cast(pa.string()), verdict, pa.array(by_list)],
                ["page_id", "host", "path", "rule", "verdict", "listed"],
            )

    return rows.withColumns(
        {
            "h1": F.transform("keys", lambda k: F.xxhash64(k)),
            "h2": F.transform("keys", lambda k: F.xxhash64(k, F.lit("second"))),
        }
    ).mapInArrow(run, RESULT)


RESULT = "page_id bigint, host string, path string, rule string, verdict string, listed boolean"


def keys_frame(spark: SparkSession, keys: list[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in sorted(set(keys))], "key string")


def _shapes_of(listed: DataFrame) -> list[tuple[int, int]]:
    """The shapes in a list; as many rows as there are shapes, not keys."""
    host = F.substring_index("key", "/", 1)
    found = listed.select(F.size(F.split(host, r"\.")).alias("n"), (F.length("key") - F.length(host)).alias("l")).distinct()
    return [(r["n"], r["l"]) for r in found.toLocalIterator()]


def _judge_by_join(rows: DataFrame, lists: list[DataFrame]) -> DataFrame:
    marked = lists[0].withColumn("kind", F.lit(0)).unionByName(lists[1].withColumn("kind", F.lit(1))).unionByName(
        lists[2].withColumn("kind", F.lit(2))
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "judged-rows")
    keys = rows.select("row", F.explode("keys").alias("key")).join(marked, "key")
    ruled = F.when(F.col("kind") < 2, F.struct((-F.length("key")).alias("l"), "kind", "key"))
    best = keys.groupBy("row").agg(F.min(ruled).alias("best"), F.max(F.col("kind") == 2).alias("own"))
    own = F.coalesce("own", F.lit(False))
    stop = F.coalesce(F.col("best.kind") == 0, own)
    return rows.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.when(stop, "block").otherwise("allow").alias("verdict"), own.alias("listed"),
    )
