"""Directory roll-ups of a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.functions.digest import set_digest
from palimpsest.functions.paths import ancestor_dirs, leaf_name, parent_dir
from palimpsest.schema import path_depth
from palimpsest.session import stored


def dir_totals(files: DataFrame, size: Column | None = None) -> DataFrame:
    """Files and bytes below every directory; empty directories do not exist."""
    size = F.lit(0) if size is None else size
    return (
        files.select(F.explode(ancestor_dirs(F.col("path"))).alias("dir"), size.cast("long").alias("bytes"))
        .groupBy("dir")
        .agg(F.count("*").alias("n_files"), F.sum("bytes").alias("n_bytes"))
    )


def dir_entries(files: DataFrame, directory: str = "") -> DataFrame:
    """Entries of one directory: its files, and its sub-directories once each."""
    prefix = f"{directory}/" if directory else ""
    below = files.filter(F.col("path").startswith(prefix)).select(
        F.substring("path", len(prefix) + 1, 2**31 - 1).alias("rest")
    )
    name = F.substring_index("rest", "/", 1)
    return (
        below.select(name.alias("name"), F.when(F.contains("rest", F.lit("/")), "tree").otherwise("file").alias("mode"))
        .distinct()
    )


def dir_digests(files: DataFrame) -> DataFrame:
    """An id for every directory that depends on the files below it only.

    ``files`` has ``path`` and ``id``.  Levels are folded from the deepest one
    up; a directory's id is a digest of the set of its entries, summed with
    partial aggregation, so a directory may hold any number of files.  Equal
    trees have equal ids.  They are not the ids of any other tool.

    Every level is written once.  The entries lie in the order of their level,
    so a level reads its own row groups and the source is read once.
    """
    rows = files.select("path", F.lit("file").alias("mode"), "id", path_depth("path").alias("level"))
    entries = stored(rows.repartitionByRange("level", "path").sortWithinPartitions("level"), "entries")
    deepest = entries.agg(F.max("level")).first()[0] or 0
    digests = trees = None
    for level in range(deepest, -1, -1):
        here = entries.filter(F.col("level") == level).drop("level")
        if trees is not None:
            here = here.unionByName(trees.select(F.col("dir").alias("path"), F.lit("tree").alias("mode"), "id"))
        entry = F.concat_ws("/", leaf_name(F.col("path")), "mode", "id")
        trees = stored(
            here.groupBy(parent_dir(F.col("path")).alias("dir"))
            .agg(set_digest(entry).alias("id"), F.count("*").alias("n_entries")),
            "directories",
        )
        digests = trees if digests is None else digests.unionByName(trees)
    return digests
