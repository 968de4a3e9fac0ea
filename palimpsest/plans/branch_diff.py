"""What a branch changed since it left another one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palimpsest.operators.branches import branch_history, merge_base
from palimpsest.operators.diff import line_delta, snapshot_diff


def branch_snapshot(own: DataFrame, chain: DataFrame, until: DataFrame | None = None) -> DataFrame:
    """Live files at the head of the branches in ``chain``, or at a commit of theirs.

    ``until(branch, ancestor, cap)`` names the commit: own commit ``cap`` of
    ``ancestor`` in the history of ``branch``; a null cap is the ancestor's last.
    """
    history = branch_history(own, chain)
    if until is not None:
        levels = chain.select("branch", "ancestor", F.col("level").alias("last_level"))
        ends = until.join(levels, ["branch", "ancestor"]).select(
            "branch", "last_level", F.col("cap").alias("last_ord")
        )
        history = history.join(ends, "branch").filter(
            (F.col("level") < F.col("last_level"))
            | (
                (F.col("level") == F.col("last_level"))
                & (F.col("last_ord").isNull() | (F.col("ord") <= F.col("last_ord")))
            )
        )
    return (
        history.groupBy("branch", "path")
        .agg(F.max_by(F.struct("revision", "is_dead"), "history_ord").alias("state"))
        .filter(~F.col("state.is_dead"))
        .select("branch", "path", "state.revision")
    )


def branch_diff(own: DataFrame, chain: DataFrame, parent: str, branch: str) -> DataFrame:
    """Changed files from the merge base of two branches to the head of ``branch``.

    Empty if the branches have no common commit.
    """
    pair = chain.sparkSession.range(1).select(F.lit(parent).alias("left"), F.lit(branch).alias("right"))
    base = merge_base(chain, pair).select(F.col("right").alias("branch"), "ancestor", "cap")
    this = chain.filter(F.col("branch") == branch).join(base.select("branch"), "branch", "left_semi")
    changed = snapshot_diff(branch_snapshot(own, this, base), branch_snapshot(own, this))
    return changed.select(F.lit(parent).alias("parent"), F.lit(branch).alias("branch"), "*")


def branch_diff_lines(changes: DataFrame, contents: DataFrame) -> DataFrame:
    """Line rows of ``branch_diff``'s changes: ``parent, branch, path, change, line, delta``.

    Only the changed files' contents are joined and split.  ``delta`` tells how
    much more often the line occurs on the branch; a file whose versions have
    equal contents gives no row.
    """
    def texts(side: str) -> DataFrame:
        wanted = changes.filter(F.col(side).isNotNull()).select("path", F.col(side).alias("revision"))
        return wanted.join(contents, ["path", "revision"]).select("path", "content")

    delta = line_delta(texts("old_id"), texts("new_id"), F.col("content").cast("string"))
    return delta.join(changes.select("path", "parent", "branch", "change"), "path").select(
        "parent", "branch", "path", "change", "line", "delta"
    )
