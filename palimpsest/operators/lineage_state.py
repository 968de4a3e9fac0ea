"""States of branches with what they inherit.

A branch's history is the part of its ancestors' histories up to where it left them, then its own commits; its order
is ``(level, ord)``.  Nothing here writes that history out to find a state.  Intervals of own commits are made once;
an ancestor's are clipped at the cap, and those still open there are closed by the first commit of a lower level on
the same file.  What a branch starts with are the ancestors' intervals that hold at its caps.

``chain`` is ``branches.lineage``; ``own`` holds every branch's own useful commits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.functions.digest import entry_sums, sums_digest
from palimpsest.operators import ordered
from palimpsest.operators.history import stored_intervals
from palimpsest.operators.intervals import FEW, spans_at
from palimpsest.operators.ordered import HOT_ROWS
from palimpsest.session import stored


def own_spans(
    own: DataFrame, hot_rows: int = HOT_ROWS, extra: tuple[str, ...] = (), before: tuple[str, ...] = ()
) -> DataFrame:
    """``branch, path, revision, is_dead, ord, next_ord, opens`` of every own commit, and ``extra`` columns, from a stored table.

    With ``before``, also a struct ``_before`` of these columns of the own
    commit that it replaces.
    """
    spans = stored_intervals(own.select("branch", "path", "revision", "is_dead", "date", *extra), "own-spans", hot_rows, before)
    columns = ("branch", "path", "revision", "is_dead", *extra, "ord", "next_ord", "opens", *(["_before"] if before else []))
    return spans.select(*columns)


def with_start(spans: DataFrame, start: DataFrame) -> DataFrame:
    """``spans`` with the columns of ``start(branch, path, ...)`` where no own commit went before; elsewhere null."""
    first = F.col("_before").isNull()
    return spans.filter(first).join(start, ["branch", "path"], "left").unionByName(
        spans.filter(~first), allowMissingColumns=True
    )


def inherited(spans: DataFrame, chain: DataFrame, hot_rows: int = HOT_ROWS, extra: tuple[str, ...] = ()) -> DataFrame:
    """What branches start with: ``branch, path, revision, is_dead, owner`` of the newest inherited commit of a file.

    Dead ones are there too.  The caps of all branches are points in their
    ancestors' orders, looked up at once.
    """
    caps = chain.filter((F.col("branch") != F.col("ancestor")) & F.col("cap").isNotNull()).select(
        F.col("ancestor").alias("branch"), F.col("cap").alias("at"), F.col("branch").alias("heir"), "level"
    )
    held = spans_at(spans.drop("opens"), stored(caps, "caps"), ["branch"], hot_rows=hot_rows, few=FEW)
    state = F.max_by(F.struct("revision", "is_dead", F.col("branch").alias("owner"), *extra), "level")
    return held.groupBy("heir", "path").agg(state.alias("state")).select(
        F.col("heir").alias("branch"), "path", "state.revision", "state.is_dead", "state.owner", *(f"state.{c}" for c in extra)
    )


def branch_axis(spans: DataFrame, chain: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All states of all files along every branch's own commits: ``branch, path, revision, is_dead, ord, next_ord``.

    An inherited state has no ``ord``, as it is there from the start, and ends
    with the branch's first own commit of the file.
    """
    first = spans.filter("opens").select("branch", "path", F.col("ord").alias("next_ord"))
    start = inherited(spans, chain, hot_rows).join(first, ["branch", "path"], "left")
    none = F.when(F.lit(False), F.col("next_ord")).alias("ord")
    columns = ("branch", "path", "revision", "is_dead")
    return spans.select(*columns, "ord", "next_ord").unionByName(start.select(*columns, none, "next_ord"))


def branch_heads_state(
    own: DataFrame, chain: DataFrame, hot_rows: int = HOT_ROWS, spans: DataFrame | None = None
) -> DataFrame:
    """Live files at the head of every branch, inherited ones too: ``branch, path, revision``.

    ``spans`` are ``own_spans`` of ``own``, if they are there already.
    """
    axis = branch_axis(own_spans(own, hot_rows) if spans is None else spans, chain, hot_rows)
    return axis.filter(F.col("next_ord").isNull() & ~F.col("is_dead")).select("branch", "path", "revision")


def snapshots_at(own: DataFrame, chain: DataFrame, points: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Live files after each of many commits: ``name, branch, path, revision``.

    ``points(name, branch, at)``: ``at`` is the order key of a commit of
    ``branch`` itself, as tag location returns it as anchor and owner.  The
    result is as long as all the states together; nothing else is.
    """
    points = stored(points.select("name", "branch", "at"), "points")
    needed = points.select("branch").distinct()
    wanted = chain.join(needed, "branch", "left_semi")
    axis = branch_axis(own_spans(own, hot_rows), wanted, hot_rows).filter(~F.col("is_dead"))
    return spans_at(axis, points, ["branch"], hot_rows=hot_rows).select("name", "branch", "path", "revision")


def snapshot_digests(own: DataFrame, chain: DataFrame, points: DataFrame, entry: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number and digest of the live files after each of many commits: ``name, n_files, files``.

    ``points`` are those of ``snapshots_at``, and the result is its states
    grouped by name, with ``functions.digest.set_digest`` of ``entry``, a text
    of ``path`` and ``revision`` that is never null.  States are not written
    out: the digest is made of sums, to which a file's version adds where it
    begins to hold and from which it is taken where it ends, so one running
    sum along the commits gives all of them.  Points run along as rows that
    change nothing.
    """
    points = stored(points.filter(F.col("branch").isNotNull() & F.col("at").isNotNull()).select("name", "branch", "at"), "points")
    needed = points.select("branch").distinct()
    wanted = chain.join(needed, "branch", "left_semi")
    axis = branch_axis(own_spans(own, hot_rows), wanted, hot_rows).filter(~F.col("is_dead"))
    first, second = entry_sums(entry)
    edges = F.array(F.struct(F.col("ord").alias("at"), F.lit(1).alias("n")), F.struct(F.col("next_ord").alias("at"), F.lit(-1).alias("n")))
    changes = (
        axis.join(needed, "branch", "left_semi")
        .select("branch", "next_ord", first.alias("first"), second.alias("second"), F.posexplode(edges).alias("side", "edge"))
        # A version without successor never ends.
        .filter((F.col("side") == 0) | F.col("next_ord").isNotNull())
        .select("branch", "edge.at", "edge.n", *(F.when(F.col("side") == 0, F.col(c)).otherwise(-F.col(c)).alias(c) for c in ("first", "second")))
    )
    both = changes.unionByName(points, allowMissingColumns=True).withColumn("_late", F.col("n").isNull())
    sums = {f"_{c}": (F.coalesce(F.col(c), F.lit(0)).cast(kind), "sum") for c, kind in (("n", "long"), ("first", "decimal(38,0)"), ("second", "decimal(38,0)"))}
    run = ordered.running_all(stored(both, "state-changes"), ["branch"], ["at", "_late"], sums, hot_rows)
    states = run.filter("_late").groupBy("name").agg(*(F.sum(c).alias(c) for c in sums)).filter(F.col("_n") > 0)
    return states.select("name", F.col("_n").alias("n_files"), sums_digest(*(F.col(c) for c in sums)).alias("files"))


def branch_intervals(
    own: DataFrame, chain: DataFrame, hot_rows: int = HOT_ROWS, spans: DataFrame | None = None
) -> DataFrame:
    """Every commit in every branch's full history with the one that replaces it there.

    ``branch, ancestor, level, path, revision, is_dead, ord, next_level,
    next_ord``; the result repeats the ancestors' commits for each branch of
    ``chain``, so pass the branches that are wanted.  ``spans`` are
    ``own_spans`` of ``own``, if they are there already.
    """
    spans = (own_spans(own, hot_rows) if spans is None else spans).withColumnRenamed("branch", "ancestor")
    within = F.col("cap").isNull() | (F.col("ord") <= F.col("cap"))
    clipped = (
        spans.join(chain.select("branch", "ancestor", "level", "cap"), "ancestor")
        .filter(within)
        .withColumn("next_ord", F.when(F.col("cap").isNull() | (F.col("next_ord") <= F.col("cap")), F.col("next_ord")))
        .drop("cap")
    )
    columns = ("branch", "ancestor", "level", "path", "revision", "is_dead", "ord")
    closed = clipped.filter(F.col("next_ord").isNotNull()).select(*columns, F.col("level").alias("next_level"), "next_ord")
    # At most two commits per file and level, the first and the last: as many as a version has levels of branches.
    ends = clipped.filter(F.col("next_ord").isNull() | F.col("opens"))
    lower = Window.partitionBy("path", "branch").orderBy("level").rangeBetween(1, Window.unboundedFollowing)
    first = F.min(F.when(F.col("opens") & F.col("path").isNotNull(), F.struct("level", "ord"))).over(lower)
    still_open = (
        ends.withColumn("_next", first)
        .filter(F.col("next_ord").isNull())
        .select(*columns, F.col("_next.level").alias("next_level"), F.col("_next.ord").alias("next_ord"))
    )
    return closed.unionByName(still_open)


def branch_live_counts(own: DataFrame, chain: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``own`` with ``live_files``: the live files of the branch, inherited ones too, after each of its commits.

    A commit counts for the branches below as well: up to its graft point a
    branch's counts are those of its ancestors, so none is repeated.  A
    branch's first commit of a file changes the count against the inherited
    state; its counts start from the sum of what its ancestors had added up
    at its caps.
    """
    extra = tuple(c for c in own.columns if c not in ("branch", "path", "revision", "is_dead", "date"))
    spans = own_spans(own, hot_rows, extra, ("is_dead",))
    start = inherited(spans.select("branch", "path", "revision", "is_dead", "ord", "next_ord", "opens"), chain, hot_rows)
    start = start.select("branch", "path", (~F.col("is_dead")).alias("_inherited"))
    was_live = F.coalesce(~F.col("_before.is_dead"), F.col("_inherited"), F.lit(False))
    change = (~F.col("is_dead")).cast("long") - was_live.cast("long")
    changes = with_start(spans.drop("next_ord", "opens"), start).withColumns({"_change": change, "date": F.col("ord.date")})
    changes = changes.drop("_before", "_inherited")
    # Caps run along as rows that change nothing.
    caps = chain.filter((F.col("branch") != F.col("ancestor")) & F.col("cap").isNotNull()).select(
        F.col("ancestor").alias("branch"), F.col("cap").alias("ord"), F.col("branch").alias("_heir"), F.lit(0).cast("long").alias("_change")
    )
    both = changes.unionByName(caps, allowMissingColumns=True).withColumn("_late", F.col("_heir").isNotNull())
    # A large group is read several times.
    both = stored(both, "changes")
    run = stored(ordered.running(both, ["branch"], ["ord", "_late"], F.col("_change"), "live_files", hot_rows=hot_rows), "running-counts")
    bases = run.filter("_late").groupBy(F.col("_heir").alias("branch")).agg(F.sum("live_files").alias("_base"))
    counted = run.filter(~F.col("_late")).join(bases, "branch", "left")
    total = F.col("live_files") + F.coalesce("_base", F.lit(0))
    return counted.withColumn("live_files", total).select(*own.columns, "live_files")
