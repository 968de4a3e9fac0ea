import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import golden
from palimpsest.functions.versions import render_version
from palimpsest.operators.lookup import assign_branches, select_branch
from palimpsest.operators.tags import branch_tags
from palimpsest.sources import rlog

PARSED = ["path", "revision", "is_dead", "date", "author", "comment", "commit_id"]


def write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.rlog").write_text(text)
    return str(folder)


def as_set(df):
    df = df.withColumn("revision", render_version(F.col("revision"))).withColumn("date", F.col("date").cast("string"))
    return sorted(tuple(r) for r in df.select(PARSED).collect())


@pytest.mark.parametrize("module", ["subdirs", "spaces", "multi_branch", "vendor"])
@pytest.mark.parametrize("date_format", ["%Y-%m-%d %H:%M:%S +0000", "%Y/%m/%d %H:%M:%S"])
def test_golden_logs(spark, tmp_path, module, date_format):
    folder = write(tmp_path / "log", log=golden.log_text(module, date_format))
    parsed = rlog.parse_rlog(rlog.read_log(spark, folder), golden.ROOT, module)
    assert as_set(parsed) == as_set(golden.revisions(spark, module))


def test_tags_and_files(spark, tmp_path):
    module = "multi_branch"
    records = rlog.read_log(spark, write(tmp_path / "log", log=golden.log_text(module)))
    tags = rlog.parse_tags(records, golden.ROOT, module)
    assert sorted(map(tuple, tags.collect())) == sorted(map(tuple, golden.tags(spark, module).collect()))
    files = {r.path for r in rlog.file_list(records, golden.ROOT, module).collect()}
    assert files == {row[1] for row in golden.REVISIONS[module]}


def test_header_only_log(spark, tmp_path):
    module = "out_of_sync"
    text = golden.log_text(module)
    sections = [s.split("\n" + rlog.REVISION_SEPARATOR + "\n")[0] for s in text.split(rlog.FILE_SEPARATOR + "\n")]
    dump = (rlog.FILE_SEPARATOR + "\n").join(s + "\n" for s in sections if s)
    folder = write(tmp_path / "log", log=dump)
    for headers_only in (True, False):
        records = rlog.read_log(spark, folder, headers_only=headers_only)
        tags = rlog.parse_tags(records, golden.ROOT, module)
        assert sorted(map(tuple, tags.collect())) == sorted(map(tuple, golden.tags(spark, module).collect()))
        assert rlog.parse_rlog(records, golden.ROOT, module).count() == 0


def test_any_file_split(spark, tmp_path):
    """Sections cut anywhere by the splits of the source still find their header."""
    folder = write(
        tmp_path / "log",
        one=golden.log_text("multi_branch"),
        two=golden.log_text("subdir_delete"),
    )
    expected = as_set(
        rlog.parse_rlog(rlog.read_log(spark, folder), golden.ROOT)
    )
    assert len(expected) == 19
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (97, 331, 1000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            records = rlog.read_log(spark, folder)
            assert records.select("chunk").distinct().count() > 3
            assert as_set(rlog.parse_rlog(records, golden.ROOT)) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_log_in_pieces(spark, tmp_path):
    """Pieces of one log: a section goes on in the next file."""
    lines = golden.log_text("multi_branch").splitlines(keepends=True)
    marks = [i for i, line in enumerate(lines) if line.strip() in (rlog.REVISION_SEPARATOR, rlog.FILE_SEPARATOR)]
    cuts = [0, *marks[1:-1:2], len(lines)]
    parts = {f"p{n:03}": "".join(lines[a:b]) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    records = rlog.read_log(spark, write(tmp_path / "log", **parts), continuous=True)
    parsed = rlog.parse_rlog(records, golden.ROOT, "multi_branch")
    assert as_set(parsed) == as_set(golden.revisions(spark, "multi_branch"))


def log_of(*blocks, header="\nRCS file: /srv/root/m/a.txt,v\nsymbolic names:\nkeyword substitution: kv\ndescription:\n"):
    dash, equal = rlog.REVISION_SEPARATOR + "\n", rlog.FILE_SEPARATOR + "\n"
    return header + "".join(dash + block for block in blocks) + equal


LINE = "date: 2020/01/01 00:00:00;  author: me;  state: Exp;  lines: +1 -1\n"


def parse(spark, tmp_path, text, **options):
    records = rlog.read_log(spark, write(tmp_path / "log", log=text))
    return records, rlog.parse_rlog(records, "/srv/root", "m", **options)


def test_odd_blocks(spark, tmp_path):
    _, parsed = parse(
        spark,
        tmp_path,
        log_of(
            "revision 1.4\tlocked by: me;\n" + LINE + "key: value\nsecond\n",
            "revision 1.3\n" + LINE + "branches:  1.3.2;  1.3.4;\n  padded \n\n",
            "revision 1.2\n" + LINE,
            "revision 1.1\n" + LINE.replace("Exp", "dead") + "last\n",
        ),
    )
    rows = {tuple(r.revision): r for r in parsed.collect()}
    assert {k: r.comment for k, r in rows.items()} == {
        (1, 4): "key: value\nsecond", (1, 3): "padded", (1, 2): "", (1, 1): "last",
    }
    assert rows[1, 1].is_dead and not rows[1, 4].is_dead and rows[1, 4].commit_id is None


def test_separator_in_comment_is_counted(spark, tmp_path):
    text = log_of(
        "revision 1.2\n" + LINE + "before\n" + rlog.REVISION_SEPARATOR + "\nafter\n",
        "revision 1.1\n" + LINE + "x\n",
        rlog.REVISION_SEPARATOR + "\nrevision 1.0\n" + LINE + "double line\n",
        "revision 0.9\nauthor: me;  state: Exp;\nno date\n",
    )
    records, parsed = parse(spark, tmp_path, text)
    assert sorted(r.comment for r in parsed.collect()) == ["before", "double line", "x"]
    corrupt = rlog.corrupt_blocks(records, "/srv/root", "m").collect()
    assert sorted((r.path, r._corrupt.split("\n")[0]) for r in corrupt) == [("a.txt", "after"), ("a.txt", "revision 0.9")]
    with pytest.raises(PySparkException, match="malformed"):
        parse(spark, tmp_path, text, strict=True)[1].collect()


def test_only_symbolic_names_are_tags(spark, tmp_path):
    header = (
        "\nRCS file: /srv/root/m/Attic/a.txt,v\nlocks: strict\n\tme: 1.3\naccess list:\n\tsomebody\nsymbolic names:\n"
        "\tgood: 1.1\n\tbranch: 1.1.0.2\nkeyword substitution: kv\ndescription:\n\tnot_a_tag: 1.2\n"
    )
    records, _ = parse(spark, tmp_path, log_of("revision 1.1\n" + LINE, header=header))
    assert {(r.tag, r.path) for r in rlog.parse_tags(records, "/srv/root", "m").collect()} == {
        ("good", "a.txt"), ("branch", "a.txt"),
    }


def test_later_entry_of_a_path_wins(spark, tmp_path):
    header = "\nRCS file: /srv/root/m/{}a.txt,v\nsymbolic names:\n\tt: {}\nkeyword substitution: kv\ndescription:\n"
    text = log_of("revision 1.1\n" + LINE, header=header.format("Attic/", "1.5"))
    text += log_of("revision 1.1\n" + LINE, header=header.format("", "1.2"))
    records, _ = parse(spark, tmp_path, text)
    assert [tuple(r) for r in rlog.parse_tags(records, "/srv/root", "m").collect()] == [("t", "a.txt", [1, 2])]


def test_vendor_default_branch(spark, tmp_path):
    folder = write(tmp_path / "log", log=golden.log_text("vendor"))
    parsed = rlog.parse_rlog(rlog.read_log(spark, folder), golden.ROOT, "vendor")
    trunk = select_branch(parsed, branch_tags(golden.tags(spark, "vendor")))
    assert {(r.path, tuple(r.revision)) for r in trunk.collect()} == {
        ("txt1.txt", (1, 1)), ("txt1.txt", (1, 2)), ("txt2.txt", (1, 1, 1, 1)),
    }


def test_assign_branches(spark):
    rows = golden.revisions(spark, "multi_branch")
    assigned = assign_branches(rows, branch_tags(golden.tags(spark, "multi_branch")))
    counts = {r.branch: r["count"] for r in assigned.groupBy("branch").count().collect()}
    assert counts == {"master": 7, "opengl": 2, "directx": 1, "experiment": 3}
    one = select_branch(rows, branch_tags(golden.tags(spark, "multi_branch")), "experiment")
    assert {r.path for r in one.collect()} == {"awesome.txt", "cool.cpp", "main.cpp"}
