"""Order, snapshots, differences, roll-ups, repeated and streaming imports."""

import datetime as dt

from pyspark.sql import functions as F

import golden
from palimpsest.functions.versions import render_version
from palimpsest.operators import diff, history, incremental, lookup, rollup
from palimpsest.plans.branch_diff import branch_diff_lines
from palimpsest.sources import tables
from palimpsest.streaming.importer import import_batch, read_imported, read_rows, start_import


def keys(df):
    return sorted((r.path, r.v) for r in df.select("path", render_version(F.col("revision")).alias("v")).collect())


def test_order(spark):
    rows = [
        ("abc/asd", "2020-01-01"), ("cde", "2020-01-01"), ("zzz", "2019-12-31"),
        ("b", "2020-01-01"), ("a/b/c", "2020-01-01"), ("a", "2020-01-02"),
    ]
    df = spark.createDataFrame(rows, "path string, day string").select(
        "path", F.col("day").cast("timestamp").alias("date"), F.array(F.lit(1), F.lit(1)).alias("revision")
    )
    assert [r.path for r in lookup.commit_order(df).collect()] == ["zzz", "b", "cde", "abc/asd", "a/b/c", "a"]


def test_lookups(spark):
    rows = golden.revisions(spark, "delete", "master")
    assert lookup.commit_lookup(rows, "evil.txt", "1.2").first().comment == "HAHA"
    assert lookup.commit_lookup(rows, "evil.txt", "1.9").isEmpty()
    assert {r.path for r in lookup.file_list(rows).collect()} == {"file.txt", "evil.txt"}
    contents = spark.createDataFrame(
        [("evil.txt", [1, 2], b"x"), ("evil.txt", [1, 3], b"gone"), ("file.txt", [1, 1], b"y")],
        "path string, revision array<int>, content binary",
    )
    assert keys(lookup.content_lookup(rows, contents)) == [("evil.txt", "1.2"), ("file.txt", "1.1")]


def test_intervals_counts_and_links(spark):
    rows = golden.revisions(spark, "readd", "master")
    spans = {
        (r.path, r.revision[1]): r.next_ord and r.next_ord.revision[1]
        for r in history.file_intervals(rows).collect()
    }
    assert spans == {("good.txt", 1): None, ("evil.txt", 1): 2, ("evil.txt", 2): 3, ("evil.txt", 3): None}
    counts = history.live_file_counts(rows).orderBy("date").collect()
    assert [r.live_files for r in counts] == [1, 2, 1, 2]
    links = history.parent_links(rows).orderBy("date").collect()
    assert links[0].parent_ord is None
    assert [r.parent_ord.date for r in links[1:]] == [r.date for r in links[:-1]]
    assert history.branch_log(rows, "master").first().comment == "evil returns"
    assert history.last_updated(rows).first().last_updated == links[-1].date


def test_grafted_branch_follows_its_graft_point(spark):
    from palimpsest.plans.importing import ImportOptions, import_tables

    tables_ = golden.revisions(spark, "branch"), golden.tags(spark, "branch")
    imported = import_tables(*tables_, ImportOptions(resolve_tags=False))
    links = history.parent_links(imported.revisions, imported.branches).filter("branch = 'branch'")
    first = links.orderBy("ord").first()
    assert (first.path, first.parent_ord.path) == ("README.txt", "main.cpp")


def test_snapshots_and_diff(spark):
    rows = golden.revisions(spark, "subdir_delete", "master")
    early = history.snapshot_asof(rows, F.lit("2013-02-16 17:48:00").cast("timestamp"))
    late = history.snapshot_asof(rows, F.lit("2014-01-01").cast("timestamp"))
    assert {r.path for r in early.collect()} == {"evil.txt", "good.txt", "really/evil.txt", "really/good.txt"}
    assert {(r.path, r.change) for r in diff.snapshot_diff(early, late).collect()} == {
        ("evil.txt", "DELETE"), ("really/evil.txt", "DELETE"),
    }


def test_a_file_without_content_id_is_there(spark):
    schema = "path string, revision string"
    old = spark.createDataFrame([("a", None), ("b", None), ("c", "1"), ("d", None)], schema)
    new = spark.createDataFrame([("a", None), ("b", "2"), ("c", None), ("e", None)], schema)
    changes = {(r.path, r.change) for r in diff.snapshot_diff(old, new).collect()}
    assert changes == {("b", "MODIFY"), ("c", "MODIFY"), ("d", "DELETE"), ("e", "ADD")}


def test_line_delta(spark):
    old = spark.createDataFrame([("a", "x\ny\ny\nz"), ("b", "same\nmoved")], "path string, text string")
    new = spark.createDataFrame([("a", "y\nx\nq"), ("b", "moved\nsame"), ("c", "new")], "path string, text string")
    delta = diff.line_delta(old, new, F.col("text"))
    assert {(r.path, r.line): r.delta for r in delta.collect()} == {
        ("a", "y"): -1, ("a", "z"): -1, ("a", "q"): 1, ("c", "new"): 1,
    }
    assert {r.path: (r.added, r.removed) for r in diff.line_totals(delta).collect()} == {"a": (1, 2), "c": (1, 0)}


def test_rollup(spark):
    files = [("a", "1", 3), ("d/a", "2", 4), ("d/e/a", "3", 5), ("d/e/b", "4", 6)]
    df = spark.createDataFrame(files, "path string, id string, n int")
    totals = {r.dir: (r.n_files, r.n_bytes) for r in rollup.dir_totals(df, F.col("n")).collect()}
    assert totals == {"": (4, 18), "d": (3, 15), "d/e": (2, 11)}
    assert {(r.name, r.mode) for r in rollup.dir_entries(df).collect()} == {("a", "file"), ("d", "tree")}
    assert {(r.name, r.mode) for r in rollup.dir_entries(df, "d").collect()} == {("a", "file"), ("e", "tree")}

    def ids(frame):
        return {r.dir: r.id for r in rollup.dir_digests(frame).collect()}

    base = ids(df)
    assert base.keys() == {"", "d", "d/e"} and ids(df.repartition(3)) == base
    changed = ids(df.withColumn("id", F.when(F.col("path") == "d/a", "9").otherwise(F.col("id"))))
    assert {d for d in base if base[d] != changed[d]} == {"", "d"}
    moved = df.withColumn("path", F.regexp_replace("path", "^d/e/", "z/"))
    assert ids(moved)["z"] == base["d/e"]


def test_rows_after_the_head(spark):
    rows = golden.revisions(spark, "subdirs", "master")
    stored = rows.filter(F.col("path").isin("1.txt", "3.txt"))
    heads = history.branch_heads(stored)
    fetched = incremental.fetched(rows, heads)
    assert incremental.fetched(rows, heads.limit(0)).count() == rows.count()
    assert {r.path for r in incremental.after_heads(fetched, heads).collect()} == {"dir/1.txt", "dir/2.txt", "dir/3.txt"}
    assert {r.path for r in incremental.late_rows(fetched, heads, stored).collect()} == {"2.txt"}
    assert incremental.after_heads(rows, history.branch_heads(rows)).isEmpty()


def test_tag_upsert(spark):
    old = spark.createDataFrame([("same", "p"), ("moved", "p"), ("gone", "p")], "tag string, place string")
    new = spark.createDataFrame([("same", "p"), ("moved", "q"), ("new", "q")], "tag string, place string")
    rows = {r.tag: (r.action, r.place) for r in incremental.upsert_tags(old, new).collect()}
    assert rows == {"same": ("NOOP", "p"), "moved": ("UPDATE", "q"), "gone": ("KEEP", "p"), "new": ("INSERT", "q")}


def test_stream_equals_batch_and_survives_a_retry(spark, tmp_path):
    rows = golden.revisions(spark, "multi_branch", "master").unionByName(golden.revisions(spark, "delete", "other"))
    rows = rows.select("branch", *[c for c in rows.columns if c != "branch"])
    cut = F.lit("2013-02-25 18:30:00").cast("timestamp")
    held_back = F.col("path") == "main.cpp"
    first = rows.filter((F.col("date") < cut) & ~held_back)
    folder = str(tmp_path)
    # Three batches, the last two with what was there before; every start but the first goes on from a stop.
    for part in (first, rows, rows.unionByName(rows)):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        query = start_import(stream, f"{folder}/out", f"{folder}/state")
        query.awaitTermination()
        assert "dedupeWithinWatermark" in str([p["stateOperators"] for p in query.recentProgress])
    stored = lookup.useful(first)
    expected = keys(stored.unionByName(incremental.after_heads(lookup.useful(rows), history.branch_heads(stored))))
    assert keys(read_imported(spark, f"{folder}/out", rows.schema)) == expected
    assert keys(spark.read.parquet(f"{folder}/out/late")) == [("main.cpp", "1.1")]
    # Everything that arrived is there once, whatever its kind.
    arrived = read_rows(spark, f"{folder}/out", rows.schema)
    assert keys(arrived) == keys(rows)
    kinds = {kind: keys(arrived.filter(F.col("kind") == kind)) for kind in ("commit", "noise", "late")}
    assert kinds == {"commit": expected, "noise": keys(lookup.noise(rows)), "late": [("main.cpp", "1.1")]}
    # The last batch again, as after a crash before its commit.
    last = spark.read.parquet(f"{folder}/out/heads").agg(F.max("batch")).first()[0]
    import_batch(rows, last, f"{folder}/out")
    assert keys(read_rows(spark, f"{folder}/out", rows.schema)) == keys(rows)


def test_tables(spark, tmp_path):
    folder = str(tmp_path)
    rows = golden.revisions(spark, "delete", "master").unionByName(golden.revisions(spark, "readd", "side"))
    tables.write_revisions(rows, folder)
    read = tables.read_revisions(spark, folder, "side", start=dt.datetime(2013, 2, 15, 20, 25))
    assert keys(read) == [("evil.txt", "1.1"), ("evil.txt", "1.2"), ("evil.txt", "1.3")]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(branch" in plan and "GreaterThan(date" in plan
    (tmp_path / "tree" / "mod" / "My Documents").mkdir(parents=True)
    (tmp_path / "tree" / "mod" / "My Documents" / "simple file.txt").write_bytes(b"simple file\n\xff")
    files = tables.read_contents(spark, f"{folder}/tree", f"{folder}/tree", "mod", [1, 1]).collect()
    assert [(r.path, r.revision, bytes(r.content)) for r in files] == [
        ("My Documents/simple file.txt", [1, 1], b"simple file\n\xff")
    ]
    changes = spark.createDataFrame([("m", "b", "x", "ADD")], "parent string, branch string, path string, change string")
    tables.write_diff(changes, folder)
    assert spark.read.parquet(f"{folder}/patches").filter("branch = 'b'").count() == 1
    contents = spark.createDataFrame([("x", [1], b"one\ntwo"), ("y", [1], b"old"), ("y", [2], b"old\nnew")], "path string, revision array<int>, content binary")
    changes = spark.createDataFrame(
        [("m", "b", "x", "ADD", None, [1]), ("m", "b", "y", "MODIFY", [1], [2]), ("m", "b", "z", "DELETE", [1], None)],
        "parent string, branch string, path string, change string, old_id array<int>, new_id array<int>",
    )
    tables.write_diff(changes, folder, branch_diff_lines(changes, contents))
    lines = spark.read.parquet(f"{folder}/patch_lines").collect()
    assert {(r.branch, r.path, r.change, r.line, r.delta) for r in lines} == {
        ("b", "x", "ADD", "one", 1), ("b", "x", "ADD", "two", 1), ("b", "y", "MODIFY", "new", 1),
    }
