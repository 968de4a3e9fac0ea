"""Tag location against a literal walk through the history, newest commit first."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import golden
from palimpsest.operators import tags as T
from palimpsest.operators.branches import graft_points, lineage
from palimpsest.operators.history import timeline
from palimpsest.operators.lookup import noise, useful

START = dt.datetime(2020, 1, 1)
REVISIONS = (
    "branch string, path string, revision array<int>, is_dead boolean, date timestamp, "
    "author string, comment string, commit_id string"
)
TAGS = "tag string, path string, revision array<int>"


def walk(history, tag):
    """history: (path, revision) in commit order; tag: path -> revision."""
    state, anchor, found = "NOT_FOUND", None, set()
    for place in range(len(history) - 1, -1, -1):
        path, revision = history[place]
        if tag.get(path) == revision:
            if anchor is None:
                anchor = place
            found.add(path)
            state = "FOUND" if found == tag.keys() else "PARTIAL"
            if state == "FOUND":
                break
        elif anchor is not None and path in tag and path not in found:
            state = "OUT_OF_SYNC"
            break
    return state, anchor


def order_key(row):
    return (row[4], row[1].count("/"), row[1], row[2])


def random_commits(rng, branch, stem, size, files):
    counts, rows = {}, []
    for _ in range(size):
        path = rng.choice(files)
        counts[path] = counts.get(path, 0) + 1
        when = START + dt.timedelta(minutes=len(rows) // 2, days=rng.randrange(2))
        rows.append([branch, path, [*stem, counts[path]], rng.random() < 0.1, when, "a", "", None])
    # Versions of a path follow its dates.
    for path in counts:
        dates = sorted(r[4] for r in rows if r[1] == path)
        for row, date in zip(sorted((r for r in rows if r[1] == path), key=lambda r: r[2]), dates):
            row[4] = date
    return sorted((tuple(r) for r in rows), key=order_key)


FILES = ["a", "b", "c", "d/a", "d/e/a", "d/z"]


@pytest.mark.parametrize("seed", [1, 2])
def test_single_history(spark, seed):
    rng = random.Random(seed)
    rows = random_commits(rng, "master", [1], 40, FILES)
    history = [(r[1], tuple(r[2])) for r in rows]
    tags = {}
    for n in range(300):
        cut = rng.randrange(1, len(rows) + 1)
        state = dict(history[:cut])
        chosen = {p: state[p] for p in rng.sample(sorted(state), rng.randrange(1, len(state) + 1))}
        kind = n % 4
        if kind == 1:
            path, revision = rng.choice(history)
            chosen[path] = revision
        elif kind == 2:
            chosen["ghost"] = (1, 1)
        elif kind == 3:
            chosen = {rng.choice([*FILES, "ghost"]): (1, rng.randrange(1, 20)) for _ in range(3)}
        tags[f"t{n}"] = chosen
    entries = spark.createDataFrame([(t, p, list(r)) for t, m in tags.items() for p, r in m.items()], TAGS)
    revisions = spark.createDataFrame(rows, REVISIONS)
    place = {key: n for n, key in enumerate(history)}
    got = {
        r.tag: (r.status, r.anchor and place[r.anchor.path, tuple(r.anchor.revision)])
        for r in T.tag_locate(entries, revisions).collect()
    }
    want = {t: walk(history, m) for t, m in tags.items()}
    assert got == want
    assert {s for s, _ in want.values()} == {"FOUND", "PARTIAL", "OUT_OF_SYNC", "NOT_FOUND"}


def random_tree(rng):
    """Branches with random graft points: own commits, parents and full histories."""
    own = {"master": random_commits(rng, "master", [1], 14, FILES)}
    parents, full = {"master": None}, {"master": list(own["master"])}
    for k in range(1, 5):
        name = f"b{k}"
        base = rng.choice(sorted(own))
        cut = rng.randrange(1, len(full[base]) + 1)
        prefix = full[base][:cut]
        parents[name] = prefix[-1]
        own[name] = random_commits(rng, name, [1, 1, 2 * k], rng.randrange(1, 8), rng.sample(FILES, 4))
        full[name] = prefix + own[name]
    return own, parents, full


@pytest.mark.parametrize("seed", [3, 4])
def test_branch_histories(spark, seed):
    rng = random.Random(seed)
    own, parents, full = random_tree(rng)
    tags = {}
    for n in range(120):
        history = full[rng.choice(sorted(full))]
        state = {r[1]: tuple(r[2]) for r in history[: rng.randrange(1, len(history) + 1)]}
        chosen = {p: state[p] for p in rng.sample(sorted(state), rng.randrange(1, len(state) + 1))}
        if n % 3 == 1:
            row = rng.choice(rng.choice(list(full.values())))
            chosen[row[1]] = tuple(row[2])
        elif n % 3 == 2:
            chosen["ghost"] = (1, 1)
        tags[f"t{n}"] = chosen
    revisions = spark.createDataFrame([r for rows in own.values() for r in rows], REVISIONS)
    entries = spark.createDataFrame([(t, p, list(r)) for t, m in tags.items() for p, r in m.items()], TAGS)
    table = [
        (name, row and row[0], row and (row[4], row[1].count("/"), row[1], row[2]))
        for name, row in parents.items()
    ]
    branches = spark.createDataFrame(
        table,
        "branch string, parent string, graft_ord struct<date:timestamp,path_depth:int,path:string,revision:array<int>>",
    )
    chain = lineage(branches).cache()
    spans = timeline(revisions, 5).cache()
    pairs = entries.select("tag").distinct().join(branches.select("branch"))
    got = {
        (r.tag, r.branch): (r.status, r.anchor and (r.anchor.owner, r.anchor.ord.path, tuple(r.anchor.ord.revision)))
        for r in T.tag_locate_on(entries, spans, chain, pairs).collect()
    }
    want = {}
    for tag, files in tags.items():
        for branch, rows in full.items():
            state, at = walk([(r[1], tuple(r[2])) for r in rows], files)
            want[tag, branch] = state, None if at is None else (rows[at][0], rows[at][1], tuple(rows[at][2]))
    assert got == want

    # Looking only at promising branches must find whatever any branch has.
    best = {r.tag: r for r in T.tag_locate_all(entries, spans, chain).collect()}
    for tag in tags:
        places = {want[tag, b][1] for b in full if want[tag, b][0] == "FOUND"}
        row = best[tag]
        if places:
            assert row.status == "FOUND"
            assert places == {(row.owner, row.anchor.path, tuple(row.anchor.revision))}
        else:
            assert row.status != "FOUND"


def test_unlimited_known_branches(spark):
    """Attaching branches in two steps gives the same as in one."""
    module = "multi_branch"
    from palimpsest.operators.lookup import assign_branches

    entries = T.branch_tags(golden.tags(spark, module))
    rows = assign_branches(golden.revisions(spark, module), entries)
    first = entries.filter(F.col("tag") != "experiment")
    once, _, _, _ = graft_points(useful(rows), entries, noise(rows))
    before, _, _, _ = graft_points(useful(rows), first, noise(rows))
    after, _, _, _ = graft_points(useful(rows), entries, noise(rows), known=before)
    assert sorted(map(str, once.collect())) == sorted(map(str, after.collect()))


def test_maps_and_messages_have_one_grain(spark):
    entries = spark.range(1000).select(
        F.lit("big").alias("tag"),
        F.concat(F.lit("f"), "id").alias("path"),
        F.array(F.lit(1), (F.col("id") % 7 + 1).cast("int")).alias("revision"),
    ).unionByName(spark.sql("select 'small' as tag, 'x' as path, array(1, 2) as revision"))
    rows = T.tag_maps(entries, buckets=10).collect()
    assert sorted(r.bucket for r in rows if r.tag == "big") == list(range(10))
    assert max(len(r.files) for r in rows) < 200
    merged = {p: tuple(v) for r in rows if r.tag == "big" for p, v in r.files.items()}
    assert merged == {f"f{n}": (1, n % 7 + 1) for n in range(1000)}
    lines = [(r.tag, r.line) for r in T.tag_messages(entries).orderBy("tag", F.asc_nulls_first("path")).collect()]
    assert [line for tag, line in lines if tag == "small"] == ["small", "x : 1.2"]
    big = [line for tag, line in lines if tag == "big"]
    assert big == ["big", *sorted(f"f{n} : 1.{n % 7 + 1}" for n in range(1000))]
    ghost = T.with_file(entries, "x", F.array(F.lit(1), F.lit(9)))
    assert {r.tag: tuple(r.revision) for r in ghost.filter("path = 'x'").collect()} == {"big": (1, 9), "small": (1, 9)}


def test_classes_names_and_resolution(spark):
    entries = golden.tags(spark, "multi_branch")
    more = entries.unionByName(entries.filter("tag = 'libs_start'").withColumn("tag", F.lit("alias")))
    classes = {r.tag: (r["class"], r.n_tags) for r in T.tag_classes(more).collect()}
    assert classes["libs_start"] == classes["alias"] == ("alias", 2) and classes["opengl"] == ("opengl", 1)
    branches = T.tag_names(entries, F.element_at("revision", -2) == 0)
    assert {r.tag for r in branches.collect()} == {"directx", "experiment", "opengl"}
    assert {r.tag for r in T.tag_names(T.plain_tags(entries)).collect()} == {"experiment_start", "libs_start"}
    names = spark.createDataFrame([("libs_start",), ("nothing",)], "tag string")
    assert sorted(map(str, T.resolve_tags(entries, names).collect())) == [
        "Row(tag='libs_start', path='main.cpp', revision=[1, 1])",
        "Row(tag='nothing', path=None, revision=None)",
    ]
    summary = {r.tag: (r.n_files, r.depth, r.is_branch, r.mixed) for r in T.tag_summary(entries).collect()}
    assert summary["experiment"] == (5, 3, True, False) and summary["libs_start"] == (1, 1, False, False)
    parent = T.branch_parent(entries.filter("tag = 'experiment'")).collect()
    assert {(r.path, tuple(r.revision)) for r in parent} == {
        ("awesome.txt", (1, 1)), ("cool.cpp", (1, 1)), ("main.cpp", (1, 1)),
        ("opengl.c", (1, 1, 2, 1)), ("opengl.cpp", (1, 1, 2, 1)),
    }
