"""Import of a change log: revisions, noise, branches, tags and their positions."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.functions.dates import LOG_DATE_FORMATS
from palimpsest.operators import lookup
from palimpsest.operators.branches import graft_points, lineage
from palimpsest.operators.history import branch_heads, timeline, with_ord
from palimpsest.operators.incremental import KEY, after_heads, late_rows
from palimpsest.operators.tags import branch_tags, clean_tags, plain_tags, tag_locate_all
from palimpsest.schema import TRUNK
from palimpsest.session import stored
from palimpsest.sources import rlog, versions
from palimpsest.sources.tables import in_layout


@dataclass(frozen=True)
class ImportOptions:
    """Tags and grafting are on by default, ``only_new`` is off."""

    resolve_tags: bool = True
    auto_graft: bool = True
    only_new: bool = False
    root: str | None = None
    module: str | None = None
    date_formats: tuple[str, ...] = LOG_DATE_FORMATS

    @classmethod
    def from_flags(
        cls,
        skip_tags: bool = False,
        resolve_tags: bool = False,
        no_graft: bool = False,
        graft: bool = False,
        all_branches: bool = False,
        only_new: bool = False,
        **rest,
    ) -> ImportOptions:
        """Options from pairs of opposite switches."""
        return cls(
            resolve_tags=not skip_tags or resolve_tags,
            auto_graft=not no_graft or graft,
            only_new=not all_branches and only_new,
            **rest,
        )


@dataclass(frozen=True)
class History:
    """An imported history.  ``revisions`` has every branch's own useful commits."""

    revisions: DataFrame
    noise: DataFrame
    tags: DataFrame
    branches: DataFrame
    tag_locations: DataFrame | None = None
    late: DataFrame | None = None
    timeline: DataFrame | None = None
    unassigned: DataFrame | None = None
    lineage: DataFrame | None = None


def import_log(records: DataFrame, options: ImportOptions = ImportOptions(), imported: History | None = None) -> History:
    """Import the records of a log (see ``sources.rlog.read_log``)."""
    revisions = rlog.parse_rlog(records, options.root, options.module, options.date_formats)
    tags = rlog.parse_tags(records, options.root, options.module)
    return import_tables(revisions, tags, options, imported)


def import_tables(
    revisions: DataFrame,
    tags: DataFrame,
    options: ImportOptions = ImportOptions(),
    imported: History | None = None,
) -> History:
    """Import parsed revisions and tags, on top of what was imported before.

    Of a branch that is known already only the commits past its head are taken;
    ``only_new`` leaves known branches alone altogether.  A revision that is
    there several times is taken once; revisions of branches without a name go
    to ``unassigned``.
    """
    # Both are read by every later step: parse and assign them once.
    tags = stored(tags, "tags")
    entries = branch_tags(tags)
    lost = None
    if "branch" not in revisions.columns:
        lost = lookup.unassigned(revisions, entries).dropDuplicates(["path", "revision"])
        revisions = lookup.assign_branches(revisions, entries)
    rows = stored(revisions.dropDuplicates(list(KEY)), "revisions")
    fetched = lookup.useful(rows)
    noise = lookup.noise(rows).filter(F.col("branch") == TRUNK)
    known = late = None
    own = fetched
    if imported is not None:
        known = imported.branches
        heads = stored(branch_heads(imported.revisions), "heads")
        if options.only_new:
            fetched = fetched.join(heads.select("branch"), "branch", "left_anti")
        late = late_rows(fetched, heads, imported.revisions)
        own = imported.revisions.unionByName(after_heads(fetched, heads))
        noise = noise.unionByName(imported.noise).dropDuplicates(list(KEY))
    branches, copies, spans, chain = graft_points(own, entries, noise, options.auto_graft, known)
    own = own.unionByName(copies)
    history = History(own, noise, tags, branches, late=late, timeline=spans, unassigned=lost, lineage=chain)
    return replace(history, tag_locations=locate_tags(history)) if options.resolve_tags else history


def locate_tags(history: History) -> DataFrame:
    """Positions of all tags that are not branches."""
    tags = clean_tags(plain_tags(history.tags), history.noise)
    spans = history.timeline if history.timeline is not None else stored(timeline(history.revisions), "timeline")
    chain = history.lineage if history.lineage is not None else lineage(history.branches)
    return tag_locate_all(tags, spans, chain)


def import_summary(history: History) -> DataFrame:
    """Commits and noise per branch, with the way the branch is attached."""
    commits = with_ord(history.revisions).groupBy("branch").agg(
        F.count("*").alias("n_commits"),
        F.count_if("is_dead").alias("n_dead"),
        F.count_distinct("path").alias("n_files"),
        F.min("date").alias("first_date"),
        F.max("ord.date").alias("last_date"),
    )
    noise = history.noise.groupBy("branch").agg(F.count("*").alias("n_noise"))
    return (
        history.branches.select("branch", "parent", "method")
        .join(commits, "branch", "full_outer")
        .join(noise, "branch", "left")
        .na.fill(0, ["n_commits", "n_dead", "n_files", "n_noise"])
    )


#: Tables that hold what the last import knew; the others only grow.
REPLACED = ("branches",)
#: Tables whose rows stay when the log no longer has their tag.
PER_TAG = ("tags", "tag_locations")
GROWING = {"noise": list(KEY), "late": list(KEY), "unassigned": ["path", "revision"]}


def load_history(spark: SparkSession, folder: str) -> History | None:
    """The newest history that ``save_history`` published, or nothing where there is none yet."""
    return _history(versions.current(spark, folder))


def _history(version: versions.Version) -> History | None:
    revisions = version.read("revisions")
    if revisions is None:
        return None
    names = ("noise", "tags", "branches", "tag_locations", "late", "unassigned")
    # The branch is a directory's name and comes last when read.
    columns = ["branch", *(c for c in revisions.columns if c != "branch")]
    return History(revisions.select(*columns), **{name: version.read(name) for name in names})


def save_history(history: History, folder: str) -> None:
    """Write a history; of one that is there already only what is new.

    Saving the same history again changes nothing.  Tags that the log no longer
    has keep their entries and positions.  All tables become visible at once:
    until the end readers see the version before, and so they do if the save
    fails anywhere.
    """
    version = versions.current(history.revisions.sparkSession, folder)
    old, new = _history(version), version.next()
    fresh = history.revisions
    if old is not None:
        fresh = stored(fresh.join(old.revisions.select(*KEY), list(KEY), "left_anti"), "fresh")
    new.write(in_layout(fresh), "revisions", by=("branch",))
    for name, key in GROWING.items():
        rows, before = getattr(history, name), getattr(old, name, None)
        if rows is None:
            continue
        if before is not None:
            rows = rows.join(before.select(*key), key, "left_anti")
        new.write(rows, name)
    for name in (*PER_TAG, *REPLACED):
        rows, before = getattr(history, name), getattr(old, name, None)
        if rows is None:
            continue
        if name in PER_TAG and before is not None:
            gone = before.join(rows.select("tag").distinct(), "tag", "left_anti")
            rows = rows.unionByName(gone)
        new.write(rows, name, replace=True)
    new.publish()
