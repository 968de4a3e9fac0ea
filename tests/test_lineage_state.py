"""States along the lineage against plain walks through the full histories."""

import collections
import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import golden
from palimpsest.operators import branches as branch_ops, lineage_state, ordered
from palimpsest.operators.branches import lineage
from palimpsest.operators.history import extended_intervals, file_intervals, stored_intervals, with_ord
from palimpsest.operators.intervals import spans_at
from palimpsest.operators.tree_ids import tree_ids
from palimpsest.plans.importing import ImportOptions, import_tables
from palimpsest.schema import TRUNK


def test_branch_with_an_inherited_file(spark):
    """The branch has the trunk's file from its first commit on."""
    history = import_tables(golden.revisions(spark, "branch"), golden.tags(spark, "branch"), ImportOptions(resolve_tags=False))
    chain = lineage(history.branches)
    counts = lineage_state.branch_live_counts(history.revisions, chain).orderBy("date").collect()
    assert [(r.branch, r.live_files) for r in counts] == [("master", 1), ("branch", 2), ("branch", 2)]
    heads = lineage_state.branch_heads_state(history.revisions, chain).filter("branch = 'branch'").collect()
    assert {(r.path, tuple(r.revision)) for r in heads} == {("main.cpp", (1, 1, 2, 1)), ("README.txt", (1, 1, 2, 1))}


#: Branch, parent, how many of the parent's own commits belong to it.
TREE = [(TRUNK, None, None), ("b1", TRUNK, 40), ("b2", "b1", 12), ("b3", TRUNK, 5), ("b4", "b2", 1), ("empty", "b1", 20)]


@pytest.fixture(scope="module")
def forest(spark):
    """Random commits, several in one second, and the order keys of each branch."""
    rng = random.Random(3)
    start = dt.datetime(2020, 1, 1)
    rows, sizes = [], {TRUNK: 120, "b1": 30, "b2": 25, "b3": 30, "b4": 15, "empty": 0}
    for branch, size in sizes.items():
        for k in range(size):
            path = rng.choice(["a", "b", "d/a", "d/e/f", "x", "y", "z/z"])
            rows.append((branch, path, [1, k + 1], rng.random() < 0.3, start + dt.timedelta(seconds=rng.randrange(60))))
    own = spark.createDataFrame(rows, "branch string, path string, revision array<int>, is_dead boolean, date timestamp").cache()
    keyed = with_ord(own).collect()
    by_branch = collections.defaultdict(list)
    for r in sorted(keyed, key=lambda r: tuple(r.ord)):
        by_branch[r.branch].append(r)
    ord_type = with_ord(own).schema["ord"].dataType
    branches = spark.createDataFrame(
        [(b, p, None if n is None else by_branch[p][n - 1].ord) for b, p, n in TREE],
        f"branch string, parent string, graft_ord {ord_type.simpleString()}",
    )
    return own, lineage(branches).cache(), by_branch


def full(by_branch, branch):
    """The commits of a branch's history with their owner, in order."""
    _, parent, n = next(t for t in TREE if t[0] == branch)
    before = [] if parent is None else full(by_branch, parent)
    if parent is not None:
        at = [k for k, (owner, _) in enumerate(before) if owner == parent][:n]
        before = before[: at[-1] + 1] if at else before
    return before + [(branch, r) for r in by_branch[branch]]


def states(commits):
    live, after = {}, []
    for _, r in commits:
        live = {**live, r.path: None if r.is_dead else tuple(r.revision)}
        after.append({p: v for p, v in live.items() if v is not None})
    return after


@pytest.mark.parametrize("hot_rows", [10, 1 << 20])
def test_counts_and_heads(forest, hot_rows):
    own, chain, by_branch = forest
    got = {(r.branch, r.path, r.revision[1]): r.live_files for r in lineage_state.branch_live_counts(own, chain, hot_rows).collect()}
    heads = collections.defaultdict(dict)
    for r in lineage_state.branch_heads_state(own, chain, hot_rows).collect():
        heads[r.branch][r.path] = tuple(r.revision)
    expected = {}
    for branch, _, _ in TREE:
        commits = full(by_branch, branch)
        after = states(commits)
        expected |= {(o, r.path, r.revision[1]): len(s) for (o, r), s in zip(commits, after, strict=True) if o == branch}
        assert heads[branch] == after[-1], branch
    assert got == expected


def test_intervals(forest):
    own, chain, by_branch = forest
    got = collections.Counter(
        (r.branch, r.ancestor, r.path, r.revision[1], r.next_level, str(r.next_ord and tuple(r.next_ord)))
        for r in lineage_state.branch_intervals(own, chain, 20).collect()
    )
    expected = collections.Counter()
    for branch, _, _ in TREE:
        commits = full(by_branch, branch)
        levels = list(dict.fromkeys(o for o, _ in commits))
        deep = {r.ancestor: r.level for r in chain.filter(F.col("branch") == branch).collect()}
        assert [deep[o] for o in levels] == sorted(deep[o] for o in levels)
        for k, (owner, r) in enumerate(commits):
            later = next(((o, x) for o, x in commits[k + 1 :] if x.path == r.path), None)
            end = (None, None) if later is None else (deep[later[0]], tuple(later[1].ord))
            end = (end[0], str(end[1]))
            expected[(branch, owner, r.path, r.revision[1], *end)] += 1
    assert got == expected


def test_states_at_many_commits(spark, forest):
    own, chain, by_branch = forest
    names = own.filter("revision[1] % 4 = 0")
    points = with_ord(names).select(F.concat_ws(" ", "branch", F.col("revision")[1]).alias("name"), "branch", F.col("ord").alias("at"))
    got = collections.defaultdict(dict)
    for r in lineage_state.snapshots_at(own, chain, points).collect():
        got[r.name][r.path] = tuple(r.revision)
    expected = {}
    for branch, _, _ in TREE:
        commits = full(by_branch, branch)
        for (owner, r), state in zip(commits, states(commits), strict=True):
            if owner == branch and r.revision[1] % 4 == 0 and state:
                expected[f"{branch} {r.revision[1]}"] = state
    assert len(expected) > 40 and got == expected


def digest(entries):
    hashed = [hashlib.sha1(e.encode()).hexdigest() for e in entries]
    sums = (sum(int(h[k : k + 15], 16) for h in hashed) for k in (0, 15))
    return hashlib.sha1(":".join(map(str, (len(entries), *sums))).encode()).hexdigest()


def trees_of(files):
    """Ids and sizes of all directories of a snapshot."""
    entries = collections.defaultdict(set)
    for path, revision in files.items():
        folder, _, name = path.rpartition("/")
        entries[folder].add(f"{name}/file/{'.'.join(map(str, revision))}")
    for folder in sorted({"/".join(p.split("/")[:k]) for p in files for k in range(1, p.count("/") + 1)}, key=lambda d: -d.count("/")):
        above, _, name = folder.rpartition("/")
        entries[above].add(f"{name}/tree/{digest(entries[folder])}")
    return {folder: (digest(e), len(e)) for folder, e in entries.items()}


@pytest.mark.parametrize("hot_rows", [15, 1 << 20])
def test_digests_of_states(forest, monkeypatch, hot_rows):
    """They come from running sums; no state is written out."""
    own, chain, by_branch = forest
    monkeypatch.setattr(lineage_state, "snapshots_at", None)
    names = own.filter("revision[1] % 4 = 0")
    name = F.concat_ws(" ", "branch", F.col("revision")[1]).alias("name")
    points = with_ord(names).select(name, "branch", F.col("ord").alias("at"))
    none = points.limit(1).select("name", "branch", F.when(F.lit(False), F.col("at")).alias("at"))
    entry = F.concat_ws(" ", "path", F.array_join(F.col("revision").cast("array<string>"), "."))
    found = lineage_state.snapshot_digests(own, chain, points.unionByName(none), entry, hot_rows)
    got = {r.name: (r.n_files, r.files) for r in found.collect()}
    expected = {}
    for branch, _, _ in TREE:
        commits = full(by_branch, branch)
        for (owner, r), state in zip(commits, states(commits), strict=True):
            if owner == branch and r.revision[1] % 4 == 0 and state:
                files = [f"{p} {'.'.join(map(str, v))}" for p, v in state.items()]
                expected[f"{branch} {r.revision[1]}"] = (len(files), digest(files))
    assert len(expected) > 40 and got == expected


@pytest.mark.parametrize("hot_rows", [15, 1 << 20])
def test_tree_ids(forest, hot_rows):
    own, chain, by_branch = forest
    found = tree_ids(own.withColumn("id", F.array_join(F.col("revision").cast("array<string>"), ".")), chain, hot_rows)
    got = {(r.branch, r.ord.path, r.ord.revision[1], r.dir): (r.id, r.n_entries) for r in found.collect()}
    expected = {}
    for branch, _, _ in TREE:
        commits = full(by_branch, branch)
        for (owner, r), state in zip(commits, states(commits), strict=True):
            if owner == branch:
                trees = trees_of(state)
                for k in range(r.path.count("/") + 1):
                    folder = "/".join(r.path.split("/")[:k])
                    expected[branch, r.path, r.revision[1], folder] = trees.get(folder, (None, 0))
    assert got == expected
    assert tree_ids(own.limit(0).withColumn("id", F.lit("")), chain).isEmpty()


@pytest.mark.parametrize("bins", [1, 3, 50])
def test_binned_join(spark, bins):
    rng = random.Random(bins)
    spans = []
    for k in range(300):
        start = rng.choice([None, rng.randrange(50)])
        spans.append((rng.choice("xyz"), k, start, rng.choice([None, (start or 0) + rng.randrange(1, 30)])))
    points = [(rng.choice("xyw"), k, rng.randrange(60)) for k in range(40)]  # several at one place
    left = spark.createDataFrame(spans, "k string, span int, ord int, next_ord int")
    right = spark.createDataFrame(points, "k string, point int, at int")
    joined = spans_at(left, right, ["k"], bins=bins)
    expected = [
        (s[1], p[1]) for s in spans for p in points
        if s[0] == p[0] and (s[2] is None or s[2] <= p[2]) and (s[3] is None or p[2] < s[3])
    ]
    assert sorted((r.span, r.point) for r in joined.collect()) == sorted(expected)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("Join") >= 2


def test_no_commits(spark, forest):
    own, chain, _ = forest
    nothing = own.limit(0)
    assert lineage_state.branch_live_counts(nothing, chain).isEmpty()
    assert lineage_state.branch_heads_state(nothing, chain).isEmpty()
    assert lineage_state.branch_intervals(nothing, chain).isEmpty()


def test_timeline_is_joined_once_for_all_levels(spark, forest, monkeypatch):
    """Two levels of branches, one join of their entries with the timeline."""
    own, _, by_branch = forest
    useful = own.filter(F.col("branch").isin(TRUNK, "b1"))
    first, second = by_branch[TRUNK][39], by_branch["b1"][11]
    rows = [("b1", first.path, [*first.revision, 0, 2]), ("b2", second.path, [1, 1, 2, 1, 0, 2])]
    useful = useful.unionByName(spark.createDataFrame(
        [("b1", second.path, [1, 1, 2, 1], False, second.date)], own.schema))
    calls, plain = [], branch_ops.tag_hits_on
    monkeypatch.setattr(branch_ops, "tag_hits_on", lambda *a: calls.append(1) or plain(*a))
    entries = spark.createDataFrame(rows, "tag string, path string, revision array<int>")
    placed = branch_ops.graft_points(useful, entries, own.limit(0).select("path", "revision"))[0]
    assert {(r.branch, r.parent) for r in placed.collect()} == {(TRUNK, None), ("b1", TRUNK), ("b2", "b1")}
    assert len(calls) == 1


@pytest.mark.parametrize("hot_rows", [5, 1 << 20])
def test_both_neighbours_in_one_pass(forest, hot_rows):
    own, _, _ = forest
    keys, order = ["branch", "path"], ["date", "revision"]
    both = ordered.next_row(own, keys, order, ["date", "revision"], "next", "opens", hot_rows, ["is_dead"])
    ahead = ordered.next_row(own, keys, order, ["date", "revision"], "next", "opens", hot_rows)
    behind = ordered.previous_row(own, keys, order, ["is_dead"], "_before", hot_rows=hot_rows)
    rows = lambda df, *columns: sorted(map(str, df.select("branch", "path", "revision", *columns).collect()))
    assert rows(both, "next", "opens") == rows(ahead, "next", "opens")
    assert rows(both, "_before") == rows(behind, "_before")
    if hot_rows > 1000:
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


SPAN = ("branch", "path", "revision", "is_dead", "ord", "next_ord", "opens")


@pytest.mark.parametrize("hot_rows", [5, 1 << 20])
def test_added_commits_link_only_their_files_again(spark, forest, hot_rows):
    own, _, _ = forest
    none = spark.createDataFrame(
        [(None, None, [1, k], k == 2, dt.datetime(2020, 1, 1, 0, k)) for k in range(1, 5)], own.schema
    )
    rows = own.unionByName(none)
    late = (F.col("path").isin("a", "z/z") | F.col("path").isNull()) & (F.element_at("revision", -1) % 3 == 0)
    spans = stored_intervals(rows.filter(~F.coalesce(late, F.lit(False))), "timeline", hot_rows).select(*SPAN)
    got = extended_intervals(spans, rows.filter(late), hot_rows)
    assert rows.filter(late & F.col("path").isNull()).count() == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, file_intervals(rows, hot_rows).select(*SPAN).collect()))


def test_stored_intervals_repeat_no_order_keys(spark, forest):
    own, _, _ = forest
    frame = stored_intervals(own, "spans")
    written = spark.read.parquet(frame.inputFiles()[0].rpartition("/")[0])
    assert not {"ord", "next_ord"} & set(written.columns)
    assert sorted(map(str, frame.select(*SPAN).collect())) == sorted(map(str, file_intervals(own).select(*SPAN).collect()))


def test_branch_intervals_from_spans_that_are_there(forest, monkeypatch):
    """No second window over all commits, and the open ends meet the first commits in one pass."""
    own, chain, _ = forest
    plain = lineage_state.branch_intervals(own, chain).collect()
    heads = lineage_state.branch_heads_state(own, chain).collect()
    spans = lineage_state.own_spans(own)
    monkeypatch.setattr(lineage_state, "own_spans", None)
    found = lineage_state.branch_intervals(own, chain, spans=spans)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftOuter") == 0
    assert sorted(map(str, lineage_state.branch_heads_state(own, chain, spans=spans).collect())) == sorted(map(str, heads))


def test_few_caps_are_not_binned(forest, monkeypatch):
    """Caps of a handful of branches are compared at once, not looked up for each commit."""
    own, chain, _ = forest
    spans = lineage_state.own_spans(own)
    rows = lambda: sorted(map(str, lineage_state.inherited(spans, chain).collect()))
    direct = rows()
    monkeypatch.setattr(lineage_state, "FEW", 1)
    assert rows() == direct
    monkeypatch.undo()
    plan = lineage_state.inherited(spans, chain)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bounds" not in plan
