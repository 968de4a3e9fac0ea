"""Selections and key lookups on the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.functions import paths as P, versions as V
from palimpsest.schema import TRUNK, ord_struct

NOISE_VERSION = (1, 1)


def is_noise() -> Column:
    """A dead first version on trunk only says that the file began on a branch."""
    first = F.array(*(F.lit(part) for part in NOISE_VERSION))
    return F.col("is_dead") & (F.col("revision") == first)


def useful(revisions: DataFrame) -> DataFrame:
    return revisions.filter(~is_noise())


def noise(revisions: DataFrame) -> DataFrame:
    return revisions.filter(is_noise())


def commit_order(revisions: DataFrame) -> DataFrame:
    """Revisions in commit order; the sort is a range shuffle."""
    return revisions.orderBy(ord_struct())


def file_list(revisions: DataFrame) -> DataFrame:
    return revisions.select("path").distinct()


def commit_lookup(revisions: DataFrame, path: str, revision: str) -> DataFrame:
    """The revision with the given key, if any."""
    version = F.array(*(F.lit(int(part)) for part in revision.split(".")))
    return revisions.filter((F.col("path") == path) & (F.col("revision") == version)).limit(1)


def commits_for_tag(revisions: DataFrame, tags: DataFrame, tag: str) -> DataFrame:
    """Revisions that the tag names."""
    return revisions.join(tags.filter(F.col("tag") == tag), ["path", "revision"], "left_semi")


def content_lookup(revisions: DataFrame, contents: DataFrame) -> DataFrame:
    """Live revisions with their content."""
    return revisions.filter(~F.col("is_dead")).join(contents, ["path", "revision"])


def _with_stem(revisions: DataFrame) -> DataFrame:
    rows = revisions.withColumn("stem", V.revision_stem(F.col("revision")))
    on_trunk = F.size("stem") == 1
    if "default_branch" in revisions.columns:
        on_trunk = F.coalesce(F.col("stem") == F.col("default_branch"), on_trunk)
    return rows.withColumn("on_trunk", on_trunk)


def _stems(branch_tags: DataFrame) -> DataFrame:
    return branch_tags.filter(V.is_branch(F.col("revision"))).select(
        "path", V.branch_stem(F.col("revision")).alias("stem"), F.col("tag").alias("branch")
    )


def assign_branches(revisions: DataFrame, branch_tags: DataFrame) -> DataFrame:
    """Give every revision the branch it was made on.

    Branch ``a.b.0.n`` holds the versions ``a.b.n.x``.  Two components are
    trunk, unless a column ``default_branch`` names another stem as the trunk
    of the file.  A stem with several names gives a row for each; the rows of a
    stem without a name are those of ``unassigned``.
    """
    rows = _with_stem(revisions)
    trunk = rows.filter("on_trunk").withColumn("branch", F.lit(TRUNK))
    named = rows.filter(F.size("stem") > 1).join(_stems(branch_tags), ["path", "stem"])
    return trunk.unionByName(named).drop("stem", "on_trunk", "default_branch")


def unassigned(revisions: DataFrame, branch_tags: DataFrame) -> DataFrame:
    """Revisions made on a branch that no tag names."""
    rows = _with_stem(revisions).filter(~F.col("on_trunk"))
    return rows.join(_stems(branch_tags), ["path", "stem"], "left_anti").drop("stem", "on_trunk", "default_branch")


def select_branch(revisions: DataFrame, branch_tags: DataFrame, branch: str | None = None) -> DataFrame:
    """Revisions of one branch, or of trunk."""
    wanted = branch_tags.filter(F.col("tag") == branch) if branch else branch_tags.limit(0)
    return assign_branches(revisions, wanted).filter(F.col("branch") == (branch or TRUNK))


def ref_list(revisions: DataFrame, tags: DataFrame) -> DataFrame:
    """All named positions: imported branches with their refs, and tags."""
    branches = revisions.select("branch").distinct()
    return branches.select(
        F.lit("branch").alias("kind"),
        F.col("branch").alias("name"),
        P.remote_ref(F.col("branch")).alias("ref"),
    ).unionByName(
        tags.select("tag")
        .distinct()
        .select(
            F.lit("tag").alias("kind"),
            F.col("tag").alias("name"),
            F.concat(F.lit("refs/tags/"), F.col("tag")).alias("ref"),
        )
    )
