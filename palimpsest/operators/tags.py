"""Tags: named sets of file versions, and where in a history they were set.

All operators take the long form ``tags(tag, path, revision)``.  A tag may hold
a large share of all rows, so everything per tag is an aggregate with partial
results or a salted join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.functions import versions as V
from palimpsest.functions.digest import set_digest
from palimpsest.functions.notes import tag_line
from palimpsest.operators.history import file_intervals, with_ord
from palimpsest.operators.skew import salted_join
from palimpsest.session import stored

FOUND, PARTIAL, OUT_OF_SYNC, NOT_FOUND = "FOUND", "PARTIAL", "OUT_OF_SYNC", "NOT_FOUND"

#: Rows that a tag's map is dealt out to; a fixed grain, whatever the size of a tag.
BUCKETS = 64


def branch_tags(tags: DataFrame) -> DataFrame:
    """The entries that are branches."""
    return tags.filter(V.is_branch(F.col("revision")))


def plain_tags(tags: DataFrame) -> DataFrame:
    return tags.filter(~F.coalesce(V.is_branch(F.col("revision")), F.lit(False)))


def tag_names(tags: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Distinct names of the entries that satisfy ``predicate`` (tag, revision)."""
    chosen = tags if predicate is None else tags.filter(predicate)
    return chosen.select("tag").distinct()


def resolve_tags(tags: DataFrame, names: DataFrame) -> DataFrame:
    """Entries of the named tags; an unknown name keeps one row without file."""
    wanted = names.select("tag").distinct()
    known = tags.join(wanted, "tag", "left_semi")
    unknown = wanted.join(tags.select("tag").distinct(), "tag", "left_anti")
    return known.unionByName(unknown, allowMissingColumns=True)


def tag_summary(tags: DataFrame) -> DataFrame:
    """Files, depth and kind of every tag; ``mixed`` marks half branch, half tag."""
    branch = F.coalesce(V.is_branch(F.col("revision")), F.lit(False))
    return tags.groupBy("tag").agg(
        F.count("*").alias("n_files"),
        F.max(V.depth(F.col("revision"))).alias("depth"),
        F.bool_or(branch).alias("is_branch"),
        (F.bool_or(branch) & ~F.bool_and(branch)).alias("mixed"),
    )


def bucket_of(path: Column, buckets: int) -> Column:
    """The bucket of a file, from the first 32 bits of the MD5 of its path."""
    number = F.conv(F.substring(F.md5(path), 1, 8), 16, 10).cast("long")
    return F.pmod(number, F.lit(buckets)).cast("int")


def tag_maps(tags: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Tags as maps ``path -> version``, one row per tag and bucket of paths.

    A map is one value of one row; the map of a tag is the union of its rows.
    The grain is the same for tags of any size; a bucket without files has no
    row.
    """
    entries = F.array_sort(F.collect_list(F.struct("path", "revision")))
    return (
        tags.withColumn("bucket", bucket_of(F.col("path"), buckets))
        .groupBy("tag", "bucket")
        .agg(F.map_from_entries(entries).alias("files"))
    )


def with_file(tags: DataFrame, path: str, revision: Column) -> DataFrame:
    """Every tag with ``path`` set to ``revision``."""
    others = tags.select("tag", "path", "revision").filter(F.col("path") != path)
    return others.unionByName(
        tags.select("tag").distinct().select("tag", F.lit(path).alias("path"), revision.alias("revision"))
    )


def tag_messages(tags: DataFrame) -> DataFrame:
    """Readable text of the tags, one row per line: the name, then a line per file.

    ``tag, path, line``; ordered by ``tag``, ``path`` (nulls first, the name)
    the rows are the text.  A line is never gathered with others, so a tag may
    have any number of files.
    """
    names = tags.select("tag").distinct()
    return names.select("tag", F.lit(None).cast("string").alias("path"), F.col("tag").alias("line")).unionByName(
        tags.select("tag", "path", tag_line(F.col("path"), F.col("revision")).alias("line"))
    )


def tag_classes(tags: DataFrame) -> DataFrame:
    """Tags with the same files and versions: each tag with the first name of its class.

    Classes are compared by a 120-bit set digest, not by gathered entries.
    """
    entry = tag_line(F.col("path"), F.col("revision"))
    prints = tags.groupBy("tag").agg(set_digest(entry).alias("digest"), F.count("*").alias("n_files"))
    classes = prints.groupBy("digest", "n_files").agg(
        F.min("tag").alias("class"), F.count("*").alias("n_tags")
    )
    return prints.join(classes, ["digest", "n_files"]).select("tag", "class", "n_tags", "n_files")


def branch_parent(tags: DataFrame) -> DataFrame:
    """Branches to their branch points; files without one are left out."""
    return tags.withColumn("revision", V.branch_parent(F.col("revision"))).filter(
        F.col("revision").isNotNull()
    )


def tag_hits(tags: DataFrame, revisions: DataFrame) -> DataFrame:
    """Commits that are members of a tag."""
    return tags.join(revisions, ["path", "revision"])


def clean_tags(tags: DataFrame, noise: DataFrame) -> DataFrame:
    """Tags without the files whose tagged version is a noise commit."""
    return tags.join(noise.select("path", "revision"), ["path", "revision"], "left_anti")


def _status(found_any: Column, n_missing: Column, n_wrong: Column) -> Column:
    return (
        F.when(~found_any, NOT_FOUND)
        .when(n_wrong > 0, OUT_OF_SYNC)
        .when(n_missing > 0, PARTIAL)
        .otherwise(FOUND)
    )


def tag_locate(tags: DataFrame, revisions: DataFrame) -> DataFrame:
    """Where each tag was set in one history.

    The *anchor* is the newest commit that the tag names.  The tag is FOUND if
    every file has its tagged version at that point, OUT_OF_SYNC if one has
    another version, PARTIAL if one does not exist yet, and NOT_FOUND without
    any commit of the tag.  Files the tag does not name are not looked at.

    Only equi-joins: a version holds at the anchor if it came before and its
    successor did not.  ``revisions`` is one branch's history without noise,
    each (path, revision) once.
    """
    history = revisions.withColumn("branch", F.lit(""))
    spans = file_intervals(history).select("path", "revision", "ord", "next_ord")
    first = with_ord(history).groupBy("path").agg(F.min("ord").alias("first_ord"))
    anchors = (
        tags.join(with_ord(history).select("path", "revision", "ord"), ["path", "revision"])
        .groupBy("tag")
        .agg(F.max("ord").alias("anchor"))
    )
    seen = tags.join(spans, ["path", "revision"], "left").join(first, "path", "left")
    known = salted_join(seen, anchors, ["tag"], F.col("path"), how="left")
    holds = F.col("ord").isNotNull() & (F.col("next_ord").isNull() | (F.col("next_ord") > F.col("anchor")))
    absent = F.col("first_ord").isNull() | (F.col("first_ord") > F.col("anchor"))
    counts = known.select(
        "tag",
        "anchor",
        (~holds & absent).alias("missing"),
        (~holds & ~absent).alias("wrong"),
    ).groupBy("tag").agg(
        F.first("anchor").alias("anchor"),
        F.count("*").alias("n_files"),
        F.count_if(F.coalesce("missing", F.lit(True))).alias("n_missing"),
        F.count_if(F.coalesce("wrong", F.lit(False))).alias("n_wrong"),
    )
    status = _status(F.col("anchor").isNotNull(), F.col("n_missing"), F.col("n_wrong"))
    return counts.withColumn("status", status)


def tag_hits_on(tags: DataFrame, timeline: DataFrame) -> DataFrame:
    """Every branch that made a tagged version, with the places of the commit and of its successor."""
    made = timeline.select(F.col("branch").alias("ancestor"), "path", "revision", "ord", "next_ord")
    return tags.join(made, ["path", "revision"]).select("tag", "path", "revision", "ancestor", "ord", "next_ord")


def tag_candidates(tags: DataFrame, hits: DataFrame, lineage: DataFrame) -> DataFrame:
    """The branches on which a tag may be found.

    If a tag is found anywhere, it is found, at the same commit, on a branch
    that made one of its versions and whose lineage made all of them.  Where no
    branch does, all that made one of its versions are kept, to report the best
    status among them.
    """
    owned = hits.groupBy("tag", "ancestor").agg(F.count("*").alias("n_own"))
    sizes = tags.groupBy("tag").agg(F.count("*").alias("n_files"))
    covered = (
        owned.join(lineage.select("branch", "ancestor"), "ancestor")
        .groupBy("tag", "branch")
        .agg(
            F.sum("n_own").alias("n_covered"),
            F.bool_or(F.col("ancestor") == F.col("branch")).alias("is_owner"),
        )
        .filter("is_owner")
    )
    # Per tag as many rows as branches made one of its versions.
    best = F.max("n_covered").over(Window.partitionBy("tag"))
    return (
        covered.withColumn("best", best)
        .join(sizes, "tag")
        .filter((F.col("n_covered") >= F.col("n_files")) | (F.col("best") < F.col("n_files")))
        .select("tag", "branch")
    )


def tag_locate_on(
    tags: DataFrame, timeline: DataFrame, lineage: DataFrame, candidates: DataFrame | None = None, hits: DataFrame | None = None
) -> DataFrame:
    """Where tags were set in the histories of several branches.

    ``timeline`` has the intervals of each branch's own commits (see
    ``history.timeline``), ``lineage(branch, ancestor, level, cap)`` what its
    history is made of (see ``branches.lineage``).  One row per pair of
    ``candidates(tag, branch)``, by default the branches on which a tag may be
    found; the anchor is ``struct(level, ord, owner)``.  ``tags`` and ``hits``
    (``tag_hits_on`` of the same tags, if it is there already) are read several
    times, so pass stored tables.
    """
    # About as long as the tags themselves; the timeline is shuffled for it, and for nothing else below.
    if hits is None:
        hits = stored(tag_hits_on(tags, timeline), "hits")
    if candidates is None:
        candidates = tag_candidates(tags, hits, lineage)
    # A row per tag, candidate and level: small next to tags and commits.
    members = stored(
        candidates.join(lineage, "branch").select("tag", "branch", "ancestor", "level", "cap"), "members"
    )
    anchors = (
        salted_join(hits, members, ["tag", "ancestor"], F.col("path"))
        .filter(F.col("cap").isNull() | (F.col("ord") <= F.col("cap")))
        .groupBy("tag", "branch")
        .agg(F.max(F.struct("level", "ord", F.col("ancestor").alias("owner"))).alias("anchor"))
    )

    # Every level of the lineage up to the anchor.
    limit = F.when(F.col("level") == F.col("anchor.level"), F.col("anchor.ord")).otherwise(F.col("cap"))
    levels = stored(
        members.join(anchors, ["tag", "branch"], "left")
        .filter(F.col("anchor").isNull() | (F.col("level") <= F.col("anchor.level")))
        .withColumn("limit", limit)
        .drop("cap"),
        "levels",
    )

    def by_limit(column: str) -> Column:
        return F.col(column).isNotNull() & (F.col("limit").isNull() | (F.col(column) <= F.col("limit")))

    # A file that has its version on the anchor's own level needs no other level: most files of most tags.
    last = levels.filter(F.col("level") == F.col("anchor.level")).select("tag", "branch", "ancestor", "limit")
    sure = salted_join(hits, last, ["tag", "ancestor"], F.col("path")).filter(by_limit("ord") & ~by_limit("next_ord"))
    sure = stored(sure.select("tag", "branch", "path", "revision"), "sure")
    doubtful = salted_join(tags, levels.select("tag", "branch").distinct(), ["tag"], F.col("path"))
    doubtful = doubtful.join(sure, ["tag", "branch", "path", "revision"], "left_anti")
    first = timeline.filter("opens").select(F.col("branch").alias("ancestor"), "path", F.col("ord").alias("first_ord"))
    checked = (
        salted_join(doubtful, levels, ["tag", "branch"], F.col("path"))
        .join(first, ["ancestor", "path"], "left")
        .join(hits, ["tag", "ancestor", "path", "revision"], "left")
        .withColumn("exists", F.col("anchor").isNotNull() & by_limit("first_ord"))
        .withColumn("holds", by_limit("ord") & ~by_limit("next_ord"))
    )
    # The file's state at the anchor is decided on the highest level it exists on.
    files = checked.groupBy("tag", "branch", "path", "revision").agg(
        F.max(F.when(F.col("exists"), 2 * F.col("level") + F.col("holds").cast("int"))).alias("state")
    )
    counted = files.select("tag", "branch", F.col("state").isNull().alias("missing"), (F.col("state") % 2 == 0).alias("wrong"))
    plain = sure.select("tag", "branch", F.lit(False).alias("missing"), F.lit(False).alias("wrong"))
    counts = counted.unionByName(plain).groupBy("tag", "branch").agg(
        F.count("*").alias("n_files"),
        F.count_if("missing").alias("n_missing"),
        F.count_if("wrong").alias("n_wrong"),
    )
    status = _status(F.col("anchor").isNotNull(), F.col("n_missing"), F.col("n_wrong"))
    places = levels.filter(F.col("ancestor") == F.coalesce("anchor.owner", "branch")).select(
        "tag", "branch", "anchor"
    )
    return counts.join(places, ["tag", "branch"]).withColumn("status", status)


STATUS_RANK = {FOUND: 0, OUT_OF_SYNC: 1, PARTIAL: 2, NOT_FOUND: 3}


def status_rank(status: Column) -> Column:
    rank = F.lit(len(STATUS_RANK))
    for name, value in STATUS_RANK.items():
        rank = F.when(status == name, value).otherwise(rank)
    return rank


def tag_locate_all(tags: DataFrame, timeline: DataFrame, lineage: DataFrame) -> DataFrame:
    """Best position of every tag over the branches that made one of its versions.

    FOUND positions win, then the smaller branch name.  The branch is the one
    that owns the commit.  A tag without any commit has no branch.  Tags with
    the same files and versions are located once.
    """
    tags = stored(tags, "tags")
    classes = stored(tag_classes(tags), "classes")
    firsts = classes.filter(F.col("tag") == F.col("class")).select("tag")
    located = tag_locate_on(tags.join(firsts, "tag", "left_semi"), timeline, lineage)
    best = located.groupBy("tag").agg(
        F.min_by(
            F.struct("branch", "status", "anchor", "n_missing", "n_wrong"),
            F.struct(status_rank(F.col("status")), F.col("branch")),
        ).alias("best")
    )
    sizes = classes.select("tag", "class", F.col("n_files").alias("size"))
    return sizes.join(best.withColumnRenamed("tag", "class"), "class", "left").select(
        "tag",
        "best.branch",
        F.coalesce("best.status", F.lit(NOT_FOUND)).alias("status"),
        F.col("best.anchor.owner").alias("owner"),
        F.col("best.anchor.ord").alias("anchor"),
        F.col("size").alias("n_files"),
        F.coalesce("best.n_missing", "size").alias("n_missing"),
        F.coalesce("best.n_wrong", F.lit(0)).alias("n_wrong"),
    )
