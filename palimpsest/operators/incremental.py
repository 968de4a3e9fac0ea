"""Taking in new revisions of a history that is already stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palimpsest.functions.dates import day_bound
from palimpsest.operators.history import with_ord

KEY = ("branch", "path", "revision")


def fetched(log: DataFrame, heads: DataFrame) -> DataFrame:
    """What has to be read again: of each branch the rows from the day of its head on, all of a new branch."""
    bounds = heads.select("branch", day_bound(F.col("ord.date")).alias("fetch_from"))
    return (
        log.join(bounds, "branch", "left")
        .filter(F.col("fetch_from").isNull() | (F.col("date") >= F.col("fetch_from")))
        .drop("fetch_from")
    )


def after_heads(batch: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows past the stored head of their branch; all rows of a new branch."""
    marks = heads.select("branch", F.col("ord").alias("head_ord"))
    return (
        with_ord(batch)
        .join(marks, "branch", "left")
        .filter(F.col("head_ord").isNull() | (F.col("ord") > F.col("head_ord")))
        .drop("head_ord", "ord")
    )


def late_rows(batch: DataFrame, heads: DataFrame, history: DataFrame) -> DataFrame:
    """Rows at or before the head that the history does not hold."""
    marks = heads.select("branch", F.col("ord").alias("head_ord"))
    early = (
        with_ord(batch)
        .join(marks, "branch")
        .filter(F.col("ord") <= F.col("head_ord"))
        .drop("head_ord", "ord")
    )
    return early.join(history.select(*KEY), list(KEY), "left_anti")


def new_branches(branches: DataFrame, imported: DataFrame) -> DataFrame:
    """Branches without any imported commit."""
    return branches.join(imported.select("branch"), "branch", "left_anti")


def upsert_tags(old: DataFrame, new: DataFrame, place: str = "place") -> DataFrame:
    """Merge tag positions: what is new or moved is taken, nothing is deleted."""
    before = old.select("tag", F.col(place).alias("old_place"))
    after = new.select("tag", F.col(place).alias("new_place"))
    action = (
        F.when(F.col("old_place").isNull(), "INSERT")
        .when(F.col("new_place").isNull(), "KEEP")
        .when(F.col("old_place") == F.col("new_place"), "NOOP")
        .otherwise("UPDATE")
    )
    return before.join(after, "tag", "full_outer").select(
        "tag", action.alias("action"), F.coalesce("new_place", "old_place").alias(place)
    )
