"""Ids of the trees of all commits, from one pass per directory level.

A directory's id is the digest of a set that is summed up entry by entry (see ``functions.digest``), so it need not be
made from a snapshot: a commit takes one entry out of its file's directory and puts another one in, and the sums run
along the commits.  Every change of a directory's id is in turn a change of one entry in the directory above.

Along a lineage the sums are those that the ancestors had at the branch's caps, plus the branch's own changes; caps run
along as rows that change nothing, and only for directories the branch touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.functions.digest import entry_sums, sums_digest
from palimpsest.functions.paths import leaf_name, parent_dir
from palimpsest.operators import ordered
from palimpsest.operators.history import with_ord
from palimpsest.operators.lineage_state import inherited, own_spans, with_start
from palimpsest.operators.ordered import HOT_ROWS
from palimpsest.schema import path_depth
from palimpsest.session import stored

SUMS = ("n", "first", "second")


def _file_events(own: DataFrame, chain: DataFrame, hot_rows: int) -> DataFrame:
    """``branch, ord, path, mode, old_id, new_id``: what every commit takes out of its directory and puts in."""
    spans = own_spans(own, hot_rows, ("id",), ("is_dead", "id"))
    start = inherited(spans.drop("_before"), chain, hot_rows, ("id",))
    start = start.select("branch", "path", F.when(~F.col("is_dead"), F.col("id")).alias("_inherited"))
    before = F.when(F.col("_before").isNull(), F.col("_inherited")).when(~F.col("_before.is_dead"), F.col("_before.id"))
    return with_start(spans.drop("next_ord", "opens"), start).select(
        "branch", "ord", "path", F.lit("file").alias("mode"),
        before.alias("old_id"), F.when(~F.col("is_dead"), F.col("id")).alias("new_id"),
    )


def _weights(name: Column) -> dict[str, Column]:
    """What an event adds to count and sums of its directory."""

    def of(side: str) -> list[Column]:
        there = F.col(side).isNotNull()
        sums = entry_sums(F.concat_ws("/", name, "mode", side))
        return [there.cast("long"), *(F.when(there, x).otherwise(F.lit(0).cast("decimal(38,0)")) for x in sums)]

    return {c: new - old for c, new, old in zip(SUMS, of("new_id"), of("old_id"), strict=True)}


def tree_ids(own: DataFrame, chain: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``branch, ord, dir, id, n_entries`` for every commit and every directory above its file.

    ``own`` has an ``id`` per revision, such as a blob id.  The row with the
    empty ``dir`` is the commit's tree; an empty directory has no id.  Ids are
    those that ``rollup.dir_digests`` gives for the snapshot at the commit.
    """
    files = _file_events(own, chain, hot_rows).withColumn("level", path_depth("path"))
    files = stored(files.sortWithinPartitions("level"), "file-events")
    above = stored(chain.filter((F.col("branch") != F.col("ancestor")) & F.col("cap").isNotNull()), "caps")
    deepest = files.agg(F.max("level")).first()[0]
    trees = found = None
    # One round per directory level, as deep as the longest path.
    for level in range(-1 if deepest is None else deepest, -1, -1):
        events = files.filter(F.col("level") == level).drop("level")
        if trees is not None:
            events = events.unionByName(
                trees.select("branch", "ord", F.col("dir").alias("path"), F.lit("tree").alias("mode"), "old_id", F.col("id").alias("new_id"))
            )
        changes = events.select("branch", "ord", parent_dir(F.col("path")).alias("dir"), *(w.alias(c) for c, w in _weights(leaf_name(F.col("path"))).items()))
        # The ids are made anew where they are read, which costs less than to store them.
        trees = _summed(stored(changes, "tree-changes"), above, hot_rows)
        rows = trees.select("branch", "ord", "dir", "id", "n_entries")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return with_ord(own).select("branch", "ord", F.lit("").alias("dir"), F.lit("").alias("id"), F.lit(0).cast("long").alias("n_entries")).limit(0)
    return found


def _summed(changes: DataFrame, above: DataFrame, hot_rows: int) -> DataFrame:
    """``branch, ord, dir, old_id, id, n_entries`` of every change."""
    touched = changes.select("branch", "dir").distinct()
    probes = touched.join(above, "branch").select(
        F.col("ancestor").alias("branch"), F.col("cap").alias("ord"), "dir", F.col("branch").alias("_heir")
    )
    both = changes.unionByName(probes, allowMissingColumns=True).withColumn("_late", F.col("_heir").isNotNull())
    sums = {f"_{c}": (F.coalesce(F.col(c), F.lit(0)), "sum") for c in SUMS}
    run = stored(ordered.running_all(both, ["branch", "dir"], ["ord", "_late"], sums, hot_rows), "tree-sums")
    bases = run.filter("_late").groupBy(F.col("_heir").alias("branch"), "dir").agg(*(F.sum(f"_{c}").alias(f"_base_{c}") for c in SUMS))
    full = run.filter(~F.col("_late")).join(bases, ["branch", "dir"], "left")
    after = [(F.col(f"_{c}") + F.coalesce(f"_base_{c}", F.lit(0))).cast("long" if c == "n" else "decimal(38,0)") for c in SUMS]
    before = [(now - F.col(c)).cast("long" if c == "n" else "decimal(38,0)") for c, now in zip(SUMS, after, strict=True)]
    return full.select(
        "branch", "ord", "dir",
        F.when(before[0] > 0, sums_digest(*before)).alias("old_id"),
        F.when(after[0] > 0, sums_digest(*after)).alias("id"),
        after[0].alias("n_entries"),
    )
