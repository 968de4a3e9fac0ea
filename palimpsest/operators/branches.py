"""Branches: lineage, graft points, common ancestors."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.functions import versions as V
from palimpsest.operators.history import branch_heads, stored_intervals, with_ord
from palimpsest.operators.tags import (
    FOUND,
    branch_parent,
    branch_tags,
    clean_tags,
    tag_hits_on,
    tag_locate_on,
)
from palimpsest.schema import BRANCH_POINT_SUFFIX, TRUNK
from palimpsest.session import stored

GRAFTED, BRANCH_POINT, NONE = "GRAFTED", "BRANCH_POINT", "NONE"


def branch_depths(tags: DataFrame) -> DataFrame:
    """Depth of every branch: the greatest one among its files."""
    return branch_tags(tags).groupBy("tag").agg(F.max(V.depth(F.col("revision"))).alias("depth"))


def lineage(branches: DataFrame) -> DataFrame:
    """What each branch's history is made of.

    ``branches(branch, parent, graft_ord)`` is a small table, one row per
    branch.  The result has ``(branch, ancestor, level, cap, n_levels)``: level
    0 is the oldest ancestor, the last level the branch itself; ``cap`` is the
    last commit of the ancestor that belongs to the history, null for no limit.
    The loop runs once per branch level, not per branch.
    """
    edges = stored(branches.select("branch", "parent", "graft_ord"))
    up = edges.filter(F.col("parent").isNotNull())
    longest = edges.count()
    hops = edges.select(
        "branch",
        F.col("branch").alias("ancestor"),
        F.lit(0).alias("hop"),
        F.when(F.lit(False), F.col("graft_ord")).alias("cap"),
    )
    reached = hops
    for n_hops in itertools.count(1):
        step = reached.select("branch", F.col("ancestor").alias("below"), "hop").join(
            up.select(F.col("branch").alias("below"), F.col("parent"), "graft_ord"), "below"
        )
        reached = stored(
            step.select(
                "branch",
                F.col("parent").alias("ancestor"),
                (F.col("hop") + 1).alias("hop"),
                F.col("graft_ord").alias("cap"),
            )
        )
        if reached.isEmpty():
            break
        if n_hops >= longest:  # more hops than branches
            raise ValueError("branches are each other's parents")
        hops = hops.unionByName(reached)
    n_levels = F.max("hop").over(Window.partitionBy("branch")) + 1
    return hops.withColumn("n_levels", n_levels).select(
        "branch",
        "ancestor",
        (F.col("n_levels") - 1 - F.col("hop")).cast("int").alias("level"),
        "cap",
        "n_levels",
    )


def _extend_lineage(chain: DataFrame, added: DataFrame) -> DataFrame:
    """Lineage with the rows of branches whose parents are in it already."""
    links = added.select("branch", "parent", "graft_ord")
    above = chain.select(
        F.col("branch").alias("parent"), "ancestor", "level", F.col("cap").alias("above_cap"), "n_levels"
    )
    inherited = links.join(above, "parent").select(
        "branch",
        "ancestor",
        "level",
        F.when(F.col("ancestor") == F.col("parent"), F.col("graft_ord"))
        .otherwise(F.col("above_cap"))
        .alias("cap"),
        (F.col("n_levels") + 1).alias("n_levels"),
    )
    tops = chain.filter(F.col("branch") == F.col("ancestor"))
    selves = links.join(tops.select(F.col("branch").alias("parent"), "n_levels"), "parent", "left").select(
        "branch",
        F.col("branch").alias("ancestor"),
        F.coalesce("n_levels", F.lit(0)).alias("level"),
        F.when(F.lit(False), F.col("graft_ord")).alias("cap"),
        (F.coalesce("n_levels", F.lit(0)) + 1).alias("n_levels"),
    )
    return chain.unionByName(inherited).unionByName(selves)


def branch_history(own: DataFrame, chain: DataFrame) -> DataFrame:
    """Full history of branches: ancestors up to their caps, then own commits.

    Its order is ``struct(level, ord)``.  Pass the lineage of the branches that
    are wanted; the histories of all branches repeat their ancestors' commits.
    """
    rows = with_ord(own).withColumnRenamed("branch", "ancestor")
    return (
        rows.join(chain.select("branch", "ancestor", "level", "cap"), "ancestor")
        .filter(F.col("cap").isNull() | (F.col("ord") <= F.col("cap")))
        .withColumn("history_ord", F.struct("level", "ord"))
        .drop("cap")
    )


def merge_base(chain: DataFrame, pairs: DataFrame) -> DataFrame:
    """Newest common commit of two branches, ``pairs(left, right)``.

    It lies on their deepest common ancestor, at the lesser of the two caps;
    a null ``cap`` stands for that branch's head.
    """
    left = chain.select(F.col("branch").alias("left"), "ancestor", F.col("level"), F.col("cap").alias("left_cap"))
    right = chain.select(F.col("branch").alias("right"), "ancestor", F.col("cap").alias("right_cap"))
    shared = pairs.join(left, "left").join(right, ["right", "ancestor"])
    base = F.struct("ancestor", F.least("left_cap", "right_cap").alias("cap"))
    return (
        shared.groupBy("left", "right")
        .agg(F.max_by(base, "level").alias("base"))
        .select("left", "right", F.col("base.ancestor").alias("ancestor"), F.col("base.cap").alias("cap"))
    )


def merge_base_commits(chain: DataFrame, pairs: DataFrame) -> DataFrame:
    """Newest common commit of two commits, ``pairs(left_branch, left_ord, right_branch, right_ord)``.

    A commit's history is that of its branch with the commit itself as the cap
    of the last level.  The lineage labels every branch with all its ancestors,
    so one equi-join per side finds the shared ones, whatever the depth; the
    base lies on the deepest, at the lesser of the two caps.  Each distinct pair
    comes out once, those without a common commit not at all.
    """
    key = ["left_branch", "left_ord", "right_branch", "right_ord"]

    def labels(side: str) -> DataFrame:
        return chain.select(
            F.col("branch").alias(f"{side}_branch"), "ancestor",
            *([F.col("level")] if side == "left" else []), F.col("cap").alias(f"{side}_cap"),
        )

    def cap(side: str) -> Column:
        own = F.col("ancestor") == F.col(f"{side}_branch")
        return F.when(own, F.col(f"{side}_ord")).otherwise(F.col(f"{side}_cap"))

    shared = pairs.select(*key).join(labels("left"), "left_branch").join(labels("right"), ["right_branch", "ancestor"])
    base = F.struct("ancestor", F.least(cap("left"), cap("right")).alias("ord"))
    found = shared.groupBy(*key).agg(F.max_by(base, "level").alias("base"))
    return found.select(*key, F.col("base.ancestor").alias("ancestor"), F.col("base.ord").alias("base_ord"))


def branch_points(own: DataFrame, branch_entries: DataFrame) -> DataFrame:
    """Copies of the commits a branch starts from, as a history of their own."""
    points = branch_parent(branch_entries).select(
        F.concat("tag", F.lit(BRANCH_POINT_SUFFIX)).alias("branch"), "path", "revision"
    )
    # Few of all commits; of several with one version the first is taken.
    key, columns = ["path", "revision"], [c for c in own.columns if c != "branch"]
    wanted = own.join(points.select(*key).distinct(), key, "left_semi")
    first = wanted.groupBy(*key).agg(F.min_by(F.struct(*columns), F.struct("date", "branch")).alias("commit"))
    return first.select("commit.*").join(points, key).select(*own.columns)


def _trunk_only(own: DataFrame) -> DataFrame:
    ord_type = with_ord(own).schema["ord"].dataType
    return own.sparkSession.range(1).select(
        F.lit(TRUNK).alias("branch"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(None).cast(ord_type).alias("graft_ord"),
        F.lit(NONE).alias("method"),
    )


def _locate_grafts(
    spans: DataFrame, points: DataFrame, hits: DataFrame, chain: DataFrame, parents: DataFrame
) -> DataFrame:
    """The commit each branch point denotes in a history of one of ``parents(branch)``."""
    located = tag_locate_on(points, spans, chain, hits=hits)
    reachable = chain.join(parents, "branch", "left_semi").select(
        F.col("ancestor").alias("parent"), F.col("cap")
    )
    choices = (
        located.filter(F.col("status") == FOUND)
        .select("tag", F.col("anchor.owner").alias("parent"), F.col("anchor.ord").alias("graft_ord"))
        .join(reachable, "parent")
        .filter(F.col("cap").isNull() | (F.col("graft_ord") <= F.col("cap")))
    )
    # A branch has few choices, one per candidate.
    newest = Window.partitionBy("tag").orderBy(F.col("graft_ord").desc(), "parent")
    return (
        choices.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .select(F.col("tag").alias("branch"), "parent", "graft_ord", F.lit(GRAFTED).alias("method"))
    )


def _start_from_copies(pending: DataFrame, copied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Branches that start at the head of their copied commits, and these heads as branches."""
    heads = branch_heads(copied)
    points = heads.select(
        "branch",
        F.lit(None).cast("string").alias("parent"),
        F.when(F.lit(False), F.col("ord")).alias("graft_ord"),
        F.lit(NONE).alias("method"),
    )
    marks = heads.select(F.col("branch").alias("parent"), F.col("ord").alias("graft_ord"))
    has_point = F.col("graft_ord").isNotNull()
    starts = (
        pending.withColumn("parent", F.concat("branch", F.lit(BRANCH_POINT_SUFFIX)))
        .join(marks, "parent", "left")
        .select(
            "branch",
            F.when(has_point, F.col("parent")).alias("parent"),
            "graft_ord",
            F.when(has_point, BRANCH_POINT).otherwise(NONE).alias("method"),
        )
    )
    return starts, points


def graft_points(
    own: DataFrame,
    branch_entries: DataFrame,
    noise: DataFrame,
    auto_graft: bool = True,
    known: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Attach every branch to the commit it forks from.

    ``own`` holds the useful commits of trunk and of all branches,
    ``branch_entries`` the branch tags.  Branches are taken level by level,
    because a branch is looked up in the histories of the level above: trunk
    for the first level, all branches one level up after that.  The newest
    commit wins, then the smaller name.  A branch that is found nowhere starts
    from copies of its branch-point commits, if there are any.

    ``known`` has branches attached before.  Returns ``branches(branch, parent,
    graft_ord, method)``, the copied commits, the timeline of all commits, with
    ``is_dead``, and the lineage of all branches.
    """

    def linked(rows: DataFrame) -> DataFrame:
        spans = stored_intervals(rows.select("branch", "path", "revision", "is_dead", "date"), "timeline")
        return spans.select("branch", "path", "revision", "is_dead", "ord", "next_ord", "opens")

    # Every level looks branches up in it: computed once.
    spans = linked(own)
    attached = _trunk_only(own) if known is None else known.select("branch", "parent", "graft_ord", "method")
    chain = stored(lineage(attached))
    depths = stored(branch_depths(branch_entries).withColumnRenamed("tag", "branch"))
    todo = depths.join(attached, "branch", "left_anti")
    trunk = own.sparkSession.range(1).select(F.lit(TRUNK).alias("branch"))
    copies = own.limit(0)
    if auto_graft:
        # Of all levels at once, so that noise and timeline are joined once and not per level.
        unplaced = branch_entries.join(todo.select(F.col("branch").alias("tag")), "tag", "left_semi")
        points = stored(clean_tags(branch_parent(unplaced), noise), "points")
        hits = stored(tag_hits_on(points, spans), "hits")
    # One value per level of branching: no more than the longest version has.
    for (level,) in todo.select("depth").distinct().orderBy("depth").collect():
        pending = todo.filter(F.col("depth") == level).select("branch")
        entries = branch_entries.join(pending.withColumnRenamed("branch", "tag"), "tag", "left_semi")
        found = attached.limit(0)
        if auto_graft:
            parents = depths.filter(F.col("depth") == level - 1).select("branch")
            names = pending.withColumnRenamed("branch", "tag")
            here = (rows.join(names, "tag", "left_semi") for rows in (points, hits))
            found = stored(_locate_grafts(spans, *here, chain, trunk if level == 2 else parents))
            pending = stored(pending.join(found, "branch", "left_anti"))
        added = [found]
        if not pending.isEmpty():
            lost = entries.join(pending.withColumnRenamed("branch", "tag"), "tag", "left_semi")
            copied = stored(branch_points(own, lost))
            copies = copies.unionByName(copied)
            added_spans = linked(copied)
            spans = spans.unionByName(added_spans)
            if auto_graft:
                hits = hits.unionByName(stored(tag_hits_on(points, added_spans), "hits"))
            starts, heads = _start_from_copies(pending, copied)
            chain = _extend_lineage(chain, heads)
            attached = attached.unionByName(heads)
            added.append(starts)
        for rows in added:
            attached = attached.unionByName(rows)
            chain = _extend_lineage(chain, rows)
        chain = stored(chain)
    return stored(attached), copies, spans, chain
