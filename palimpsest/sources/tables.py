"""The stored form of a history: Parquet tables below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.functions.paths import clean_path
from palimpsest.schema import CONTENTS


def read_revisions(
    spark: SparkSession, folder: str, branch: str | None = None, start=None, end=None
) -> DataFrame:
    """The change log; branch and date bounds reach the scan."""
    rows = spark.read.parquet(f"{folder}/revisions")
    if branch is not None:
        rows = rows.filter(F.col("branch") == branch)
    if start is not None:
        rows = rows.filter(F.col("date") > F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("date") < F.lit(end))
    return rows


def in_layout(revisions: DataFrame) -> DataFrame:
    """Revisions in the order they are stored in.

    A range shuffle gives tasks of even size whatever the sizes of branches and
    paths, each with few branches and neighbouring paths.
    """
    layout = ["branch", "path", "date", "revision"]
    return revisions.repartitionByRange(*layout).sortWithinPartitions(*layout)


def write_revisions(revisions: DataFrame, folder: str, mode: str = "append") -> None:
    """Append to the change log, one directory per branch."""
    in_layout(revisions).write.mode(mode).partitionBy("branch").parquet(f"{folder}/revisions")


def write_table(df: DataFrame, folder: str, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(f"{folder}/{name}")


def write_diff(diff: DataFrame, folder: str, lines: DataFrame | None = None) -> None:
    """Diff rows, and their line rows if given, one directory per pair of branches."""
    for rows, name in ((diff, "patches"), (lines, "patch_lines")):
        if rows is not None:
            rows.write.mode("overwrite").partitionBy("parent", "branch").parquet(f"{folder}/{name}")


def read_contents(spark: SparkSession, folder: str, root: str, module: str, revision: list[int]) -> DataFrame:
    """Files of an exported tree as ``contents`` rows of one version."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_replace("path", "^file:/*", "/")
    return files.select(
        clean_path(path, root, module).alias("path"),
        F.array(*(F.lit(part) for part in revision)).cast("array<int>").alias("revision"),
        "content",
    ).to(CONTENTS)
