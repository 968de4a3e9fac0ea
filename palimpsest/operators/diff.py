"""Differences between two states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, content_id: str = "revision") -> DataFrame:
    """Changed files between two snapshots: ADD, MODIFY or DELETE.

    ``content_id`` is the column that tells whether a file changed.  Renames
    show up as DELETE and ADD.
    """
    # A file may be there without a content id.
    before = old.select("path", F.col(content_id).alias("old_id"), F.lit(True).alias("_old"))
    after = new.select("path", F.col(content_id).alias("new_id"), F.lit(True).alias("_new"))
    change = F.when(F.col("_old").isNull(), "ADD").when(F.col("_new").isNull(), "DELETE").otherwise("MODIFY")
    same = F.col("_old").isNotNull() & F.col("_new").isNotNull() & F.col("old_id").eqNullSafe(F.col("new_id"))
    return before.join(after, "path", "full_outer").filter(~same).withColumn("change", change).drop("_old", "_new")


def line_delta(old: DataFrame, new: DataFrame, text: Column) -> DataFrame:
    """Lines that occur more or less often, by path.

    A multiset difference: a line that only moved does not show up.  Both sides
    go through one aggregation with partial sums, so a line that is repeated
    over and over is combined before the shuffle.
    """

    def lines(files: DataFrame, sign: int) -> DataFrame:
        return files.select(
            "path", F.explode(F.split(text, "\n")).alias("line"), F.lit(sign).cast("long").alias("n")
        )

    return (
        lines(old, -1)
        .unionByName(lines(new, 1))
        .groupBy("path", "line")
        .agg(F.sum("n").alias("delta"))
        .filter(F.col("delta") != 0)
    )


def line_totals(delta: DataFrame) -> DataFrame:
    """Added and removed lines per file."""
    added = F.when(F.col("delta") > 0, F.col("delta")).otherwise(0)
    removed = F.when(F.col("delta") < 0, -F.col("delta")).otherwise(0)
    return delta.groupBy("path").agg(F.sum(added).alias("added"), F.sum(removed).alias("removed"))
