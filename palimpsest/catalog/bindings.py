"""Histories derived from the given tables.

The given tables hold no change log, so one is derived from each of them:
events become the trunk, orders eight branches, documents file contents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palimpsest.operators import ordered
from palimpsest.schema import TRUNK
from palimpsest.sources.rlog import FILE_SEPARATOR, REVISION_SEPARATOR

ROOT, MODULE = "/srv/root", "mod"
EPOCH = "2024-01-01"
TAG_DAYS = 3
BRANCHES = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _version(*parts) -> Column:
    return F.array(*(p if isinstance(p, Column) else F.lit(p) for p in parts)).cast("array<int>")


def trunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One revision per event; a user's events are the versions of one file."""
    user = F.col("user_id")
    path = (
        F.when(user % 3 == 0, F.concat(F.lit("f"), user, F.lit(".txt")))
        .when(user % 3 == 1, F.concat(F.lit("d"), user % 7, F.lit("/f"), user, F.lit(".txt")))
        .otherwise(
            F.concat(F.lit("d"), user % 7, F.lit("/s"), user % 5, F.lit("/f"), user, F.lit(".txt"))
        )
    )
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    numbered = ordered.position(events, ["user_id"], ["ts", "event_id"], "rn")
    return numbered.select(
        F.lit(TRUNK).alias("branch"),
        path.alias("path"),
        _version(1, F.col("rn")).alias("revision"),
        (F.col("event_type") == "error").alias("is_dead"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("date"),
        F.concat(F.lit("user"), user % 20).alias("author"),
        F.col("props").alias("comment"),
        F.col("event_id").cast("string").alias("commit_id"),
    )


def _odd_file() -> Column:
    return F.regexp_extract("path", r"f([0-9]+)\.txt$", 1).cast("long") % 2 == 1


def _period() -> Column:
    days = F.date_diff(F.col("date").cast("date"), F.lit(EPOCH).cast("date"))
    return F.floor(days / TAG_DAYS).cast("int")


def tag_count(rows: DataFrame) -> int:
    """The number of the last boundary, the first one after all rows."""
    last = rows.agg(F.max(_period())).first()[0]
    return 0 if last is None else last + 1


def _states(rows: DataFrame, first: Column, count: int) -> DataFrame:
    """The newest version of every file before each of the boundaries k >= first."""
    # By the number alone: an aggregate of arrays would sort its rows.
    newest = rows.groupBy("path", first.alias("first")).agg(F.max(F.element_at("revision", -1)).alias("rn"))
    return (
        newest.select("path", "rn", F.explode(F.sequence("first", F.lit(count))).alias("k"))
        .groupBy("path", "k")
        .agg(F.max("rn").alias("rn"))
        .select("path", "k", _version(1, F.col("rn")).alias("revision"))
    )


def _named(rows: DataFrame, *prefixes: str) -> DataFrame:
    """``rows`` once per prefix, made once."""
    names = F.array(*(F.concat(F.lit(prefix), "k") for prefix in prefixes))
    return rows.select(F.explode(names).alias("tag"), "path", "revision")


def start_tags(rows: DataFrame) -> DataFrame:
    """Those of the T tags of the trunk ``rows`` at which branches may start."""
    count = min(tag_count(rows), BRANCHES)
    known = rows.withColumn("first", _period() + 1).filter(F.col("first") <= count)
    return _named(_states(known, F.col("first"), count), "T")


def tags(rows: DataFrame) -> DataFrame:
    """Tags of the trunk ``rows``, up to the first boundary after the last of them.

    T: the state before day 3k.  X: odd files three days behind.  P: T and a
    file that does not exist.  N: only that file.
    """
    count = tag_count(rows)
    known = rows.withColumn("first", _period() + 1)
    state = _states(known, F.col("first"), count)
    behind = known.withColumn("first", F.col("first") + _odd_file().cast("int"))
    mixed = _states(behind.filter(F.col("first") <= count), F.col("first"), count)
    ghost = rows.sparkSession.range(1, count + 1).select(
        F.col("id").cast("int").alias("k"), F.lit("ghost.txt").alias("path"), _version(1, 1).alias("revision")
    )
    return (
        _named(state, "T", "P")
        .unionByName(_named(mixed, "X"))
        .unionByName(_named(ghost, "P", "N"))
    )


def branch_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own commits of the branches B1 to B8: the orders of a customer are versions of a file."""
    orders = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        .withColumn("k", (F.col("o_custkey") % BRANCHES + 1).cast("int"))
    )
    numbered = ordered.position(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "rn")
    return numbered.select(
        F.concat(F.lit("B"), "k").alias("branch"),
        F.concat(F.lit("o"), "o_custkey", F.lit(".txt")).alias("path"),
        _version(1, 1, F.col("k") * 2, F.col("rn")).alias("revision"),
        (F.col("o_orderstatus") == "P").alias("is_dead"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date"),
        F.lit("clerk").alias("author"),
        F.lit("").alias("comment"),
        F.col("o_orderkey").cast("string").alias("commit_id"),
    )


def branch_edits(trunk_rows: DataFrame) -> DataFrame:
    """Commits of the branches on files of the trunk: a fifth of its commits, half of them deletions.

    A file goes to one branch.  A third of the commits is 30 years old, so that
    some of a branch's commits lie before and some after the place where the
    next branch leaves it.
    """
    number = F.col("commit_id").cast("long")
    k = (F.regexp_extract("path", r"f([0-9]+)\.txt$", 1).cast("long") % BRANCHES + 1).cast("int")
    old = F.col("date") - F.make_dt_interval(F.lit(10957))
    edits = trunk_rows.filter(number % 5 == 0).withColumns({
        "branch": F.concat(F.lit("B"), k),
        "revision": F.concat("revision", F.array(k * 2, F.lit(1))),
        "is_dead": number % 10 == 0,
        "date": F.when(number % 3 == 0, old).otherwise(F.col("date")),
    })
    return edits.withColumn("comment", F.lit("")) if "comment" in edits.columns else edits


def branch_noise(own: DataFrame) -> DataFrame:
    """The dead first version on trunk of every file that began on a branch."""
    return (
        own.groupBy("path")
        .agg(F.min("date").alias("date"))
        .select(
            F.lit(TRUNK).alias("branch"),
            "path",
            _version(1, 1).alias("revision"),
            F.lit(True).alias("is_dead"),
            "date",
            F.lit("clerk").alias("author"),
            F.lit("").alias("comment"),
            F.lit(None).cast("string").alias("commit_id"),
        )
    )


def branch_entries(trunk_tags: DataFrame, own: DataFrame) -> DataFrame:
    """Magic numbers: odd k leaves trunk where T<k> is, even k leaves B<k-1> at its head."""
    state = trunk_tags.filter(F.col("tag").startswith("T"))
    k = F.substring("tag", 2, 9).cast("int")
    state = state.select(k.alias("k"), "path", "revision")
    heads = own.groupBy("branch", "path").agg(F.max(F.element_at("revision", -1)).alias("rn"))
    heads = heads.select(F.substring("branch", 2, 9).cast("int").alias("k"), "path", "rn")
    heads = heads.select("k", "path", _version(1, 1, F.col("k") * 2, F.col("rn")).alias("revision"))
    odd = F.col("k") % 2 == 1
    # Each side once: the states and heads are aggregates of all commits.
    below = F.when(odd & (F.col("k") < BRANCHES), F.array("k", F.col("k") + 1)).otherwise(F.array("k"))
    state = state.filter(odd & (F.col("k") <= BRANCHES)).select(F.explode(below).alias("k"), "path", "revision")
    start = F.struct(F.col("k").alias("k"), _version(1, 1).alias("revision"))
    behind = F.struct((F.col("k") + 1).alias("k"), F.col("revision").alias("revision"))
    starts = F.when(odd, F.array(start, behind)).otherwise(F.array(start))
    heads = heads.select("path", F.explode(starts).alias("start"))
    rows = state.unionByName(heads.select("start.k", "path", "start.revision"))
    return rows.select(
        F.concat(F.lit("B"), "k").alias("tag"),
        "path",
        F.concat("revision", _version(0, F.col("k") * 2)).alias("revision"),
    )


def _document_versions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Every document as a file with up to two versions.

    By ``doc_id % 5``: 0 and 1 are edited, 2 stays as it is, 3 is gone and 4
    appears with the second version.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", *columns)
    kind = F.col("doc_id") % 5
    versions = (
        F.when(kind == 3, F.array(F.lit(1))).when(kind == 4, F.array(F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2)))
    )
    path = F.concat(F.lit("p"), F.col("doc_id") % 7, F.lit("/"), "doc_id", F.lit(".txt"))
    return docs.select(
        "doc_id", *columns, path.alias("path"), F.explode(versions).alias("rn")
    ).withColumn("revision", _version(1, F.col("rn")))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of all document versions; the edit changes one word."""
    rows = _document_versions(spark, sf_dir, "text")
    edited = (F.col("rn") == 2) & (F.col("doc_id") % 5 < 2)
    text = F.when(edited, F.replace("text", F.lit(" a "), F.lit(" some "))).otherwise(F.col("text"))
    return rows.select("path", "revision", text.cast("binary").alias("content"))


def content_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of the document versions; some are dead."""
    return _document_versions(spark, sf_dir).select(
        F.lit(TRUNK).alias("branch"),
        "path",
        "revision",
        ((F.col("rn") == 2) & (F.col("doc_id") % 11 == 0)).alias("is_dead"),
    )


def edition(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Document versions as two branches: commits and contents.

    The trunk has the first versions; the branch ``edition``, made after all of
    them, edits, deletes and adds files.
    """
    rows = _document_versions(spark, sf_dir)
    edited = F.col("rn") == 2
    later = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("doc_id") % 86400).cast("decimal(18,6)"))
    day = F.when(edited, F.lit("2024-02-01")).otherwise(F.lit(EPOCH)).cast("timestamp_ntz")
    branch_version = _version(1, 1, 2, 1)
    columns = (
        F.when(edited, "edition").otherwise(TRUNK).alias("branch"), "path",
        F.when(edited, branch_version).otherwise(F.col("revision")).alias("revision"),
    )
    commits = rows.select(*columns, F.lit(False).alias("is_dead"), (day + later).alias("date"))
    gone = rows.filter(F.col("doc_id") % 5 == 3).select(
        F.lit("edition").alias("branch"), "path", branch_version.alias("revision"), F.lit(True).alias("is_dead"),
        F.lit("2024-02-03").cast("timestamp_ntz").alias("date"),
    )
    texts = contents(spark, sf_dir)
    second = F.element_at("revision", -1) == 2
    texts = texts.withColumn("revision", F.when(second, branch_version).otherwise(F.col("revision")))
    return commits.unionByName(gone), texts


def _archive(path: Column) -> Column:
    return F.concat(F.lit(f"{ROOT}/{MODULE}/"), path, F.lit(",v"))


def _header(path: Column, symbols: Column) -> Column:
    return F.concat(
        F.lit("\nRCS file: "), _archive(path),
        F.lit("\nhead: 1.1\nbranch:\nlocks: strict\naccess list:\nsymbolic names:\n"),
        symbols,
        F.lit("keyword substitution: kv\ntotal revisions: 0;\tselected revisions: 0\ndescription:"),
    )


def _block(broken: Column | None = None) -> Column:
    version = F.array_join(F.col("revision").cast("array<string>"), ".")
    when = F.concat(F.lit("date: "), F.col("date").cast("string"), F.lit(" +0000;  "))
    if broken is not None:
        when = F.when(broken, "").otherwise(when)
    state = F.when(F.col("is_dead"), "dead").otherwise("Exp")
    return F.concat(
        F.lit("revision "), version, F.lit("\n"), when,
        F.lit("author: "), F.col("author"), F.lit(";  state: "), state,
        F.lit(";  commitid: "), F.col("commit_id"), F.lit(";\n"), F.col("comment"),
    )


def log_lines(revisions: DataFrame, entries: DataFrame | None = None, broken: Column | None = None) -> DataFrame:
    """Text of a log in pieces: per file a header, then its revisions from the newest on.

    Columns ``path``, ``step`` (order inside the file, the header first) and
    ``value``.
    """
    blocks = revisions.select(
        "path",
        F.negative(F.element_at("revision", -1).cast("long")).alias("step"),
        _block(broken).alias("value"),
    )
    paths = revisions.select("path").distinct()
    if entries is None:
        headers = paths.withColumn("symbols", F.lit(""))
    else:
        # One entry per tag: a header lists them all, as the format demands.
        line = F.concat(
            F.lit("\t"), "tag", F.lit(": "), F.array_join(F.col("revision").cast("array<string>"), "."), F.lit("\n")
        )
        listed = entries.groupBy("path").agg(F.array_join(F.array_sort(F.collect_list(line)), "").alias("symbols"))
        headers = paths.join(listed, "path", "full_outer")
    header = _header(F.col("path"), F.coalesce("symbols", F.lit("")))
    return blocks.unionByName(
        headers.select("path", F.lit(-(2**40)).alias("step"), header.alias("value"))
    )


def log_records(lines: DataFrame) -> DataFrame:
    """The pieces of a log as the reader would return them, in chunks of 64 revisions."""
    return lines.select(
        F.concat(F.lit("log"), F.pmod(F.hash("path"), F.lit(5))).alias("source"),
        F.struct("path", F.floor(F.col("step") / 64).alias("start")).alias("chunk"),
        F.col("step").alias("pos"),
        "value",
    )


def log_files(lines: DataFrame, folder: str) -> str:
    """Write the log as text files; a file section may go on in the next one."""
    text = F.when(F.col("step") == -(2**40), F.concat(F.lit(f"{FILE_SEPARATOR}\n"), "value")).otherwise(
        F.concat(F.lit(f"{REVISION_SEPARATOR}\n"), "value")
    )
    (
        lines.repartitionByRange("path", "step")
        .sortWithinPartitions("path", "step")
        .select(text.alias("value"))
        .write.text(folder)
    )
    return folder
