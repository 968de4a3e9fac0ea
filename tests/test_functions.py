import datetime as dt

from pyspark.sql import functions as F

from palimpsest.functions import dates, digest, notes, paths, tagmaps, versions as V

VERSIONS = ["1.1", "1.1.0.3", "1.1.2.1.0.2", "1.1.2.127", "1.1.2.128", "1.1.2.32767", "1.1.2.32768"]


def test_versions_round_trip_and_order(spark):
    df = spark.createDataFrame([(v,) for v in VERSIONS], "v string")
    parsed = df.select("v", V.parse_version(F.col("v")).alias("r"))
    assert all(row.v == row.t for row in parsed.select("v", V.render_version(F.col("r")).alias("t")).collect())
    ordered = [row.v for row in parsed.orderBy("r").collect()]
    assert ordered == sorted(VERSIONS, key=lambda v: [int(p) for p in v.split(".")])


def test_version_predicates(spark):
    cases = {
        "1.1": (False, None, 1, False),
        "1.1.0.2": (True, "1.1", 2, False),
        "1.1.2.1": (False, "1.1", 2, False),
        "1.1.1": (False, None, 1, True),
        "1.1.2.1.0.2": (True, "1.1.2.1", 3, False),
        "7": (None, None, 0, True),
        "x.1": (None, None, None, None),
    }
    r = V.parse_version(F.col("v"))
    rows = (
        spark.createDataFrame([(v,) for v in cases], "v string")
        .select(
            "v", V.is_branch(r), V.render_version(V.branch_parent(r)), V.depth(r), V.is_vendor_branch(r)
        )
        .collect()
    )
    assert {row[0]: tuple(row[1:]) for row in rows} == cases


def test_branch_stem(spark):
    row = spark.sql("select array(1, 1, 0, 2) as m, array(1, 1, 2, 7) as r").select(
        V.branch_stem(F.col("m")), V.revision_stem(F.col("r"))
    ).first()
    assert row[0] == row[1] == [1, 1, 2]


def test_clean_path(spark):
    cases = {
        "/r/mod/a.txt,v": "a.txt",
        "/r/mod/Attic/a.txt,v": "a.txt",
        "/r/mod/d/Attic/a.txt,v ": "d/a.txt",
        "/r/mod/MyAttic/x,v": "MyAttic/x",
        "/r/mod/Attic/Attic/x,v": "x",
        "/r/mod/My Documents/simple file.txt,v": "My Documents/simple file.txt",
    }
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    for root in ("/r", ":pserver:me@host:/r"):
        rows = df.select("p", paths.clean_path(F.col("p"), root, "mod").alias("c")).collect()
        assert {row.p: row.c for row in rows} == cases
    assert df.select(paths.clean_path(F.col("p"), "/r")).first()[0] == "mod/a.txt"


def test_path_parts(spark):
    row = spark.sql("select 'a/b/c.txt' as p, 'top' as q").select(
        paths.parent_dir(F.col("p")),
        paths.leaf_name(F.col("p")),
        paths.ancestor_dirs(F.col("p")),
        paths.parent_dir(F.col("q")),
        paths.ancestor_dirs(F.col("q")),
        paths.patch_name(F.lit("m"), F.lit("b"), F.lit("1")),
        paths.module_path("mod", F.col("p")),
        paths.head_ref(F.lit("b")),
    ).first()
    assert list(row) == [
        "a/b", "c.txt", ["", "a", "a/b"], "", [""], "patches/m/b__1.diff", "mod/a/b/c.txt", "refs/heads/b",
    ]


def test_dates(spark):
    cases = {
        "2013-08-12 19:34:29 +0300": dt.datetime(2013, 8, 12, 16, 34, 29),
        "2013/08/12 00:34:29": dt.datetime(2013, 8, 12, 0, 34, 29),
        "yesterday": None,
    }
    rows = spark.createDataFrame([(d,) for d in cases], "d string").select(
        "d", dates.parse_date(F.col("d")).cast("string").alias("t")
    )
    assert {r.d: r.t and dt.datetime.fromisoformat(r.t) for r in rows.collect()} == cases
    other = spark.sql("select '12.08.2013 10' as d").select(
        dates.parse_date(F.col("d"), ["dd.MM.yyyy HH"]).cast("string")
    )
    assert other.first()[0] == "2013-08-12 10:00:00"


def test_date_bounds(spark):
    df = spark.sql("select explode(sequence(date'2020-01-01', date'2020-01-05')) as d")
    low, high = F.lit("2020-01-02").cast("date"), F.lit("2020-01-04").cast("date")
    assert df.filter(dates.within(F.col("d"), low, high)).count() == 1
    assert df.filter(dates.within(F.col("d"), low)).count() == 3
    assert df.filter(dates.within(F.col("d"), None, high)).count() == 3
    assert df.filter(dates.within(F.col("d"), F.lit(None).cast("date"))).count() == 5


def test_notes(spark):
    df = spark.createDataFrame(
        [("d/a b.txt", [1, 2], True, "abc"), ("x", [1, 1, 2, 1], False, None)],
        "path string, revision array<int>, is_dead boolean, commit_id string",
    )
    note = notes.render_note(*(F.col(c) for c in df.columns))
    rows = df.select("*", note.alias("note")).select("*", notes.parse_note(F.col("note")).alias("back")).collect()
    assert rows[0].note == "CVS_PATH: d/a b.txt\nCVS_REV: 1.2\ndead\nCVS_COMMIT_ID: abc\n"
    assert rows[1].note == "CVS_PATH: x\nCVS_REV: 1.1.2.1\nalive\n\n"
    assert all(tuple(row.back) == tuple(row)[:4] for row in rows)


def test_blob_id(spark):
    row = spark.createDataFrame([(b"1\n",), (b"",)], "c binary").select(digest.blob_id(F.col("c"))).collect()
    assert row[0][0] == "d00491fd7e5bb6fa28c517a0bb32b8b506539d4d"
    assert row[1][0] == "e69de29bb2d1d6434b8b29ae775ad8c2e48c5391"


def test_set_digest_ignores_order_and_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("e"))
    one = df.repartition(1).agg(digest.set_digest(F.col("e"))).first()[0]
    many = df.orderBy(F.desc("e")).repartition(7).agg(digest.set_digest(F.col("e"))).first()[0]
    other = df.filter("id <> 7").agg(digest.set_digest(F.col("e"))).first()[0]
    assert one == many != other


def test_tag_maps(spark):
    df = spark.sql("select map('a', array(1,1,0,2), 'b', array(1,3), 'c', array(1,2,2,1,0,4)) as m, "
                   "cast(map() as map<string, array<int>>) as e")
    m, e = F.col("m"), F.col("e")
    version = F.array(F.lit(9), F.lit(9))
    row = df.select(
        tagmaps.with_file(m, F.lit("b"), version)["b"].alias("set"),
        F.size(tagmaps.with_file(m, F.lit("z"), version)).alias("added"),
        tagmaps.includes_file(m, F.lit("b")).alias("has"),
        tagmaps.includes_commit(m, F.lit("b"), F.array(F.lit(1), F.lit(3))).alias("hit"),
        tagmaps.includes_commit(m, F.lit("z"), F.array(F.lit(1), F.lit(3))).alias("miss"),
        F.map_keys(tagmaps.ignore_files(m, F.array(F.lit("a"), F.lit("z")))).alias("left"),
        tagmaps.tag_depth(m).alias("depth"),
        tagmaps.tag_depth(e).alias("no_depth"),
        tagmaps.tag_is_branch(m).alias("branch"),
        tagmaps.tag_branch_parent(m).alias("parent"),
    ).first()
    assert row.set == [9, 9] and row.added == 4 and row.has and row.hit and not row.miss
    assert row.left == ["b", "c"] and row.depth == 3 and row.no_depth is None and row.branch
    assert row.parent == {"a": [1, 1], "c": [1, 2, 2, 1]}
