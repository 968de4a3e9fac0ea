"""Branch histories: predecessors, validity, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.operators import ordered
from palimpsest.operators.ordered import HOT_ROWS
from palimpsest.schema import FILE_ORDER, ORDER, ord_struct, path_depth
from palimpsest.session import stored

COMMIT = ("path", "revision", "date")


def with_ord(revisions: DataFrame) -> DataFrame:
    return revisions.withColumn("ord", ord_struct())


def with_depth(revisions: DataFrame) -> DataFrame:
    return revisions.withColumn("path_depth", path_depth("path"))


def commit_positions(revisions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number every commit of a branch in commit order."""
    rows = with_depth(revisions)
    return ordered.position(rows, ["branch"], ORDER, "position", hot_rows).drop("path_depth")


def parent_links(
    revisions: DataFrame, branches: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every commit with the commit before it on its branch.

    The first own commit of a branch follows the commit it was grafted on,
    ``branches(branch, graft_ord)``; on trunk it has no parent.
    """
    grafts = None if branches is None else branches.select("branch", "graft_ord")
    return with_ord(
        ordered.previous_row(
            with_depth(revisions), ["branch"], ORDER, ORDER, "parent_ord", grafts, hot_rows
        )
    ).drop("path_depth")


def branch_heads(revisions: DataFrame) -> DataFrame:
    """Newest commit of every branch."""
    return with_ord(revisions).groupBy("branch").agg(F.max("ord").alias("ord"))


def last_updated(revisions: DataFrame) -> DataFrame:
    """Date of the newest own commit of every branch."""
    return branch_heads(revisions).select("branch", F.col("ord.date").alias("last_updated"))


def branch_log(revisions: DataFrame, branch: str) -> DataFrame:
    """Commits of one branch, newest first."""
    return revisions.filter(F.col("branch") == branch).orderBy(ord_struct().desc())


def file_intervals(revisions: DataFrame, hot_rows: int = HOT_ROWS, before: Sequence[str] = ()) -> DataFrame:
    """Every revision with the order key of the one that replaces it (null: none).

    ``opens`` marks the first revision of a file on its branch.  ``before``
    names columns of the revision that it replaces, added as a struct
    ``_before``.
    """
    return _with_keys(_linked(revisions, hot_rows, before))


def _linked(revisions: DataFrame, hot_rows: int, before: Sequence[str]) -> DataFrame:
    # The path first: sorts compare the beginning of the first key, and a branch has many files.
    linked = ordered.next_row(
        revisions, ["path", "branch"], FILE_ORDER, FILE_ORDER, "next", "opens", hot_rows, before
    )
    return linked.withColumn("_depth", path_depth("path"))


def _with_keys(linked: DataFrame) -> DataFrame:
    place = F.col("_depth").alias("path_depth"), F.col("path")
    next_ord = F.struct(F.col("next.date"), *place, F.col("next.revision"))
    return linked.withColumns(
        {"ord": F.struct("date", *place, "revision"), "next_ord": F.when(F.col("next").isNotNull(), next_ord)}
    ).drop("next", "_depth")


def stored_intervals(
    revisions: DataFrame, name: str, hot_rows: int = HOT_ROWS, before: Sequence[str] = ()
) -> DataFrame:
    """``file_intervals``, stored without the order keys.

    These repeat path, date and version; readers put them together again, and
    only those they need.
    """
    return _with_keys(stored(_linked(revisions, hot_rows, before), name))


def extended_intervals(spans: DataFrame, added: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Intervals ``spans`` with further commits ``added``: ``branch, path, revision, is_dead, ord, next_ord, opens``.

    Only the files on branches that have added commits are linked again.  Both
    are read several times, so pass stored tables.
    """
    columns = ["branch", "path", "revision", "is_dead"]
    added = added.select(*columns, "date")
    touched = stored(added.select(F.col("branch").alias("_branch"), F.col("path").alias("_path")).distinct(), "touched")
    # Rows without branch or path are a group of their own, as in a window.
    same = spans["branch"].eqNullSafe(touched["_branch"]) & spans["path"].eqNullSafe(touched["_path"])
    before = spans.join(touched, same, "left_semi").select(*columns, F.col("ord.date").alias("date"))
    again = stored_intervals(before.unionByName(added), "relinked", hot_rows)
    columns += ["ord", "next_ord", "opens"]
    return spans.join(touched, same, "left_anti").select(*columns).unionByName(again.select(*columns))


def timeline(revisions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Intervals of all files in the columns that tag location needs."""
    spans = file_intervals(revisions.select("branch", "path", "revision", "date"), hot_rows)
    return spans.select("branch", "path", "revision", "ord", "next_ord", "opens")


def snapshot_asof(revisions: DataFrame, at: Column, columns: tuple[str, ...] = ()) -> DataFrame:
    """Live files of every branch after the last commit at or before the date ``at``.

    One aggregate with partial results; no window.
    """
    state = F.struct("revision", "is_dead", *columns)
    newest = (
        with_ord(revisions)
        .filter(F.col("date") <= at)
        .groupBy("branch", "path")
        .agg(F.max_by(state, "ord").alias("state"))
        .filter(~F.col("state.is_dead"))
    )
    return newest.select("branch", "path", "state.revision", *(f"state.{name}" for name in columns))


def live_file_counts(revisions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number of live files after each commit, of those that the branch itself made.

    ``lineage_state.branch_live_counts`` counts inherited files too.
    """
    seen = ordered.previous_row(
        with_depth(revisions), ["branch", "path"], FILE_ORDER, ["is_dead"], "before", hot_rows=hot_rows
    )
    was_live = ~F.coalesce("before.is_dead", F.lit(True))
    change = (~F.col("is_dead")).cast("int") - was_live.cast("int")
    counted = ordered.running(seen, ["branch"], ORDER, change.cast("long"), "live_files", hot_rows=hot_rows)
    return counted.drop("before", "path_depth")
