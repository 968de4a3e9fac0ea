"""Known commit counts, file sets and tag positions of small histories."""

import pytest
from pyspark.sql import functions as F

import golden
from palimpsest.functions.versions import render_version
from palimpsest.operators.branches import branch_history, lineage, merge_base
from palimpsest.operators.lookup import assign_branches, useful
from palimpsest.operators.tags import branch_tags, tag_locate
from palimpsest.plans.branch_diff import branch_diff
from palimpsest.plans.importing import (
    ImportOptions,
    import_log,
    import_summary,
    import_tables,
    load_history,
    locate_tags,
    save_history,
)
from palimpsest.sources import versions
from palimpsest.sources.rlog import read_log


_loaded = {}


def load(spark, module, **options):
    key = (module, *sorted(options.items()))
    if key not in _loaded:
        tables = golden.revisions(spark, module), golden.tags(spark, module)
        _loaded[key] = import_tables(*tables, ImportOptions(**options))
    return _loaded[key]


def commit_counts(history):
    """Commits in the full history of every branch."""
    full = branch_history(history.revisions, lineage(history.branches))
    return {row.branch: row["count"] for row in full.groupBy("branch").count().collect()}


def file_sets(history, branch):
    """Live files after each commit, newest first."""
    full = branch_history(history.revisions, lineage(history.branches))
    rows = full.filter(F.col("branch") == branch).orderBy("history_ord").collect()
    live, states = set(), []
    for row in rows:
        live = live - {row.path} if row.is_dead else live | {row.path}
        states.append(set(live))
    return states[::-1]


def found(history):
    rows = history.tag_locations.filter(F.col("status") == "FOUND").select(
        "tag", "owner", "anchor.path", render_version(F.col("anchor.revision")).alias("revision")
    )
    return {row.tag: (row.owner, row.path, row.revision) for row in rows.collect()}


TRUNK_SETS = {
    "subdirs": [
        {"1.txt", "2.txt", "3.txt", "dir/1.txt", "dir/2.txt", "dir/3.txt"},
        {"1.txt", "2.txt", "3.txt", "dir/1.txt", "dir/2.txt"},
        {"1.txt", "2.txt", "3.txt", "dir/1.txt"},
        {"1.txt", "2.txt", "3.txt"},
        {"1.txt", "2.txt"},
        {"1.txt"},
    ],
    "delete": [{"file.txt"}, {"file.txt", "evil.txt"}, {"file.txt", "evil.txt"}, {"file.txt"}],
    "readd": [{"good.txt", "evil.txt"}, {"good.txt"}, {"good.txt", "evil.txt"}, {"good.txt"}],
    "subdir_delete": [
        {"good.txt", "really/good.txt"},
        {"good.txt", "really/good.txt", "really/evil.txt"},
        {"good.txt", "really/good.txt", "really/evil.txt", "evil.txt"},
        {"good.txt", "really/evil.txt", "evil.txt"},
        {"good.txt", "evil.txt"},
        {"evil.txt"},
    ],
}


@pytest.mark.parametrize("module", TRUNK_SETS)
def test_trunk_states(spark, module):
    assert file_sets(load(spark, module, resolve_tags=False), "master") == TRUNK_SETS[module]


def test_branch_and_tag(spark):
    history = load(spark, "branch")
    assert file_sets(history, "master") == [{"main.cpp"}]
    both = {"main.cpp", "README.txt"}
    assert file_sets(history, "branch") == [both, both, {"main.cpp"}]
    assert found(history) == {"branch_start": ("master", "main.cpp", "1.1")}


MULTI = {"directx": 2, "master": 2, "opengl": 3, "experiment": 6}
MULTI_TAGS = {
    "libs_start": ("master", "main.cpp", "1.1"),
    "experiment_start": ("opengl", "opengl.cpp", "1.1.2.1"),
}


def test_multi_branch(spark):
    history = load(spark, "multi_branch")
    assert commit_counts(history) == MULTI
    assert found(history) == MULTI_TAGS
    chain = lineage(history.branches)
    pairs = spark.createDataFrame([("opengl", "experiment"), ("directx", "experiment")], "left string, right string")
    bases = {(r.left, r.right): (r.ancestor, r.cap and r.cap.path) for r in merge_base(chain, pairs).collect()}
    assert bases == {
        ("opengl", "experiment"): ("opengl", "opengl.cpp"),
        ("directx", "experiment"): ("master", "main.cpp"),
    }
    changes = branch_diff(history.revisions, chain, "opengl", "experiment").collect()
    assert {(row.path, row.change) for row in changes} == {
        ("awesome.txt", "ADD"),
        ("cool.cpp", "ADD"),
        ("main.cpp", "DELETE"),
    }


def test_no_graft(spark):
    counts = commit_counts(load(spark, "multi_branch", auto_graft=False))
    points = {"directx.branch_point": 1, "opengl.branch_point": 1, "experiment.branch_point": 3}
    assert counts == MULTI | points


def test_no_tags(spark):
    assert load(spark, "multi_branch", resolve_tags=False).tag_locations is None


def test_bad_branch(spark):
    history = load(spark, "out_of_sync")
    assert commit_counts(history) == {"bad_branch": 4, "bad_branch.branch_point": 2, "master": 4}
    methods = {row.branch: row.method for row in history.branches.collect()}
    assert methods["bad_branch"] == "BRANCH_POINT"
    assert found(history) == {"BPT": ("bad_branch.branch_point", "B", "1.2")}
    trunk = useful(assign_branches(golden.revisions(spark, "out_of_sync"), branch_tags(golden.tags(spark, "out_of_sync"))))
    trunk = trunk.filter(F.col("branch") == "master")
    tag = golden.tags(spark, "out_of_sync").filter(F.col("tag") == "BPT")
    row = tag_locate(tag, trunk).first()
    assert (row.status, row.anchor.path, row.anchor.revision) == ("OUT_OF_SYNC", "B", [1, 2])


def test_summary(spark):
    rows = {row.branch: row for row in import_summary(load(spark, "multi_branch")).collect()}
    assert (rows["master"].n_commits, rows["master"].n_noise, rows["master"].method) == (2, 5, "NONE")
    assert (rows["experiment"].n_commits, rows["experiment"].parent) == (3, "opengl")


@pytest.mark.parametrize("only_new", [False, True])
def test_second_import_changes_nothing(spark, only_new):
    once = load(spark, "multi_branch", only_new=only_new)
    tables = golden.revisions(spark, "multi_branch"), golden.tags(spark, "multi_branch")
    twice = import_tables(*tables, ImportOptions(only_new=only_new), imported=once)
    assert commit_counts(twice) == MULTI
    assert found(twice) == MULTI_TAGS
    assert twice.late.count() == 0


def test_tags_later(spark):
    once = load(spark, "multi_branch", resolve_tags=False, only_new=True)
    tables = golden.revisions(spark, "multi_branch"), golden.tags(spark, "multi_branch")
    assert found(import_tables(*tables, ImportOptions(only_new=True), imported=once)) == MULTI_TAGS


def test_flags():
    assert ImportOptions.from_flags() == ImportOptions(True, True, False)
    assert ImportOptions.from_flags(skip_tags=True, no_graft=True, only_new=True) == ImportOptions(False, False, True)
    assert ImportOptions.from_flags(
        skip_tags=True, resolve_tags=True, no_graft=True, graft=True, only_new=True, all_branches=True
    ) == ImportOptions(True, True, False)


def test_import_from_log_text(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "dump.rlog").write_text(golden.log_text("multi_branch"))
    records = read_log(spark, str(tmp_path / "log"))
    history = import_log(records, ImportOptions(root=golden.ROOT, module="multi_branch"))
    assert commit_counts(history) == MULTI
    assert found(history) == MULTI_TAGS


def rows_of(frame):
    return sorted((r.branch, r.path, tuple(r.revision)) for r in frame.collect())


def test_saving_twice_is_saving_once(spark, tmp_path):
    log, options = golden.revisions(spark, "subdirs", "master"), ImportOptions(resolve_tags=False)
    tags = spark.sql("select explode(array('kept', 'gone')) as tag, '1.txt' as path, array(1, 1) as revision")
    folder = str(tmp_path / "history")
    assert load_history(spark, folder) is None
    save_history(import_tables(log.unionByName(log), tags, options), folder)
    save_history(import_tables(log, tags.filter("tag = 'kept'"), options, load_history(spark, folder)), folder)
    again = load_history(spark, folder)
    assert rows_of(again.revisions) == rows_of(useful(log))
    assert [r.branch for r in again.branches.collect()] == ["master"]
    # A tag that is gone upstream stays.
    assert sorted(r.tag for r in again.tags.collect()) == ["gone", "kept"]


@pytest.mark.parametrize("broken", ["noise", "branches", "publish"])
def test_a_save_that_fails_is_not_seen(spark, tmp_path, monkeypatch, broken):
    log, options = golden.revisions(spark, "subdirs", "master"), ImportOptions(resolve_tags=False)
    tags = spark.sql("select 'kept' as tag, '1.txt' as path, array(1, 1) as revision")
    folder = str(tmp_path / "history")
    save_history(import_tables(log.filter("path < '2'"), tags, options), folder)
    before = rows_of(load_history(spark, folder).revisions)
    write, publish = versions.NextVersion.write, versions.NextVersion.publish

    def failing(self, rows, name, **more):
        if name == broken:
            raise OSError("lost")
        write(self, rows, name, **more)

    def overtaken(self):
        publish(self.before.next())  # someone else was faster
        publish(self)

    monkeypatch.setattr(versions.NextVersion, "write", failing)
    if broken == "publish":
        monkeypatch.setattr(versions.NextVersion, "publish", overtaken)
    later = import_tables(log, tags.withColumn("tag", F.lit("new")), options, load_history(spark, folder))
    with pytest.raises(OSError):
        save_history(later, folder)
    monkeypatch.undo()
    seen = load_history(spark, folder)
    assert rows_of(seen.revisions) == before and [r.tag for r in seen.tags.collect()] == ["kept"]
    save_history(later, folder)
    assert rows_of(load_history(spark, folder).revisions) == rows_of(useful(log))


def test_revisions_of_unnamed_branches_are_kept_aside(spark):
    log, tags = golden.revisions(spark, "multi_branch"), golden.tags(spark, "multi_branch")
    fewer = tags.filter("tag <> 'opengl'")
    history = import_tables(log, fewer, ImportOptions(resolve_tags=False))
    lost = history.unassigned.select("path", "revision").distinct().count()
    assert lost == assign_branches(log, tags.filter("tag = 'opengl'")).filter("branch = 'opengl'").count() > 0


def test_a_cycle_of_parents_is_an_error(spark):
    ring = load(spark, "multi_branch").branches.limit(1)
    ring = ring.withColumn("branch", F.lit("a")).withColumn("parent", F.lit("b")).unionByName(
        ring.withColumn("branch", F.lit("b")).withColumn("parent", F.lit("a"))
    )
    with pytest.raises(ValueError, match="parents"):
        lineage(ring)
