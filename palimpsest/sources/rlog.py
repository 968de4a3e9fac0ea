"""Revision logs in text form.

A log is a sequence of file sections, each a header followed by one block per
revision.  The reader takes one *record* per revision block: the text source
cuts the file at the separator line, so a section of any length is read by many
tasks.  A record that ends a section also holds the header of the next one.
Blocks find their header by looking back: inside their file split with a
window, beyond it through a table with one row per split.

Records have the columns ``source`` (file), ``chunk`` (start of the split),
``pos`` (order inside the split) and ``value`` (text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from palimpsest.functions.dates import LOG_DATE_FORMATS, parse_date
from palimpsest.functions.paths import clean_path
from palimpsest.functions.versions import parse_version

# The separator lines and the marks inside headers.
FILE_SEPARATOR = "=" * 77
REVISION_SEPARATOR = "-" * 28
FILE_MARK = "RCS file: "
SYMBOLS_MARK = "symbolic names:"
SYMBOLS_END = "keyword substitution:"

RECORD = ("source", "chunk", "pos")


def read_log(
    spark: SparkSession, path: str | Sequence[str], headers_only: bool = False, continuous: bool = False
) -> DataFrame:
    """Records of log files below ``path``.

    ``headers_only`` is for logs without revisions: one record per file
    section.  ``continuous`` takes the files, in name order, for pieces of one
    log, so a section may go on in the next file.
    """
    separator = f"{FILE_SEPARATOR}\n" if headers_only else f"\n{REVISION_SEPARATOR}\n"
    lines = spark.read.text(path, lineSep=separator, recursiveFileLookup=True)
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    if continuous:
        order = F.struct(file.alias("file"), start.alias("start"))
        source = F.lit("")
    else:
        order = F.struct(F.lit("").alias("file"), start.alias("start"))
        source = file
    return lines.select(
        source.alias("source"),
        order.alias("chunk"),
        # Increases along a split; the split it belongs to is in ``chunk``.
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def _file_path(header: Column, root: str | None, module: str | None) -> Column:
    found = F.regexp_extract(header, f"(?m)^{FILE_MARK}([^:\\n]*)$", 1)
    return F.when(found != "", clean_path(found, root, module))


def _default_branch(header: Column) -> Column:
    found = F.regexp_extract(header, r"(?m)^branch:[ \t]*([0-9.]+)[ \t]*$", 1)
    return F.when(found != "", parse_version(found))


def _split_records(records: DataFrame, root: str | None, module: str | None) -> DataFrame:
    """Cut every record at separator lines into a ``block`` and the ``headers`` after it.

    Two separator lines in a row share a line end, so one of them may be left
    inside a record.  ``file`` is what the last header names, null without one.
    """
    pieces = F.split("value", f"(?m)^{REVISION_SEPARATOR}$\\n?")
    parts = F.split("piece", f"(?m)^{FILE_SEPARATOR}$\\n?")
    cut = records.select(*RECORD, F.posexplode(pieces).alias("sub", "piece")).select(
        *RECORD, "sub", parts.alias("parts")
    )
    # The text before the first separator of a log is a header, not a block.
    opens = F.element_at("parts", 1).rlike(f"^\\s*{FILE_MARK}")
    headers = F.when(opens, F.col("parts")).otherwise(
        F.slice("parts", F.lit(2), F.greatest(F.size("parts") - 1, F.lit(0)))
    )
    last = F.try_element_at(
        F.filter("headers", lambda header: header.rlike(f"(?m)^{FILE_MARK}")), F.lit(-1)
    )
    path = _file_path(last, root, module)
    return (
        cut.withColumn("headers", headers)
        .withColumn("block", F.when(~opens, F.element_at("parts", 1)))
        .withColumn(
            "file",
            F.when(
                path.isNotNull(),
                F.struct(path.alias("path"), _default_branch(last).alias("default_branch")),
            ),
        )
        .drop("parts")
    )


def rlog_blocks(records: DataFrame, root: str | None = None, module: str | None = None) -> DataFrame:
    """Revision blocks with the path and default branch of their file section."""
    cut = _split_records(records, root, module)
    in_chunk = Window.partitionBy("source", "chunk").orderBy("pos", "sub")
    above = in_chunk.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy("source", "chunk")
        .agg(F.max_by("file", F.when(F.col("file").isNotNull(), F.struct("pos", "sub"))).alias("last_file"))
        .select("source", "chunk", F.last("last_file", ignorenulls=True).over(earlier).alias("far"))
    )
    found = (
        cut.withColumn("near", F.last("file", ignorenulls=True).over(above))
        .filter(F.col("block").rlike("\\S"))
        .join(carried, ["source", "chunk"], "left")
        .withColumn("file", F.coalesce("near", "far"))
    )
    return found.select(*RECORD, "sub", "file.path", "file.default_branch", "block")


def _squeeze(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_blocks(blocks: DataFrame, date_formats: Sequence[str] = LOG_DATE_FORMATS) -> DataFrame:
    """Revision blocks to revision rows.

    A block without version, date or author, or outside any file section, keeps
    its text in ``_corrupt``.
    """

    def field(name: str) -> Column:
        found = F.regexp_extract(F.get("lines", F.lit(1)), f"(?:^|;)\\s*{name}: ([^;]*)(?:;|$)", 1)
        return F.when(found != "", F.trim(found))

    revision = F.regexp_extract(F.get("lines", F.lit(0)), r"^revision ([0-9.]+)", 1)
    has_branches = F.coalesce(F.get("lines", F.lit(2)).rlike(r"^branches:\s"), F.lit(False))
    skipped = F.when(has_branches, 3).otherwise(2)
    comment = F.slice("lines", skipped + 1, F.greatest(F.size("lines") - skipped, F.lit(0)))
    commit = F.struct(
        parse_version(revision).alias("revision"),
        F.coalesce(field("state") == "dead", F.lit(False)).alias("is_dead"),
        parse_date(field("date"), date_formats).alias("date"),
        field("author").alias("author"),
        _squeeze(F.array_join(comment, "\n")).alias("comment"),
        field("commitid").alias("commit_id"),
    )
    # Exploding an array of one keeps filters on the result from being pushed
    # below it, where they would parse every block a second time.
    rows = blocks.withColumn("lines", F.split("block", "\n")).select(
        *RECORD, "path", "default_branch", "block", F.explode(F.array(commit)).alias("commit")
    )
    complete = (
        F.col("path").isNotNull()
        & F.col("commit.revision").isNotNull()
        & F.col("commit.date").isNotNull()
        & F.col("commit.author").isNotNull()
    )
    return rows.select(
        *RECORD, "path", "default_branch", "commit.*", F.when(~complete, F.col("block")).alias("_corrupt")
    )


def parse_rlog(
    records: DataFrame,
    root: str | None = None,
    module: str | None = None,
    date_formats: Sequence[str] = LOG_DATE_FORMATS,
    strict: bool = False,
) -> DataFrame:
    """All revisions of a log, without their branch (see ``assign_branches``).

    Malformed blocks are left to :func:`corrupt_blocks`; ``strict`` raises an
    error on the first one instead.
    """
    rows = parse_blocks(rlog_blocks(records, root, module), date_formats)
    if strict:
        message = F.concat(F.lit("malformed revision block: "), F.col("_corrupt"))
        rows = rows.withColumn(
            "path", F.when(F.col("_corrupt").isNotNull(), F.raise_error(message)).otherwise(F.col("path"))
        )
    else:
        rows = rows.filter(F.col("_corrupt").isNull())
    return rows.drop(*RECORD, "_corrupt")


def corrupt_blocks(
    records: DataFrame,
    root: str | None = None,
    module: str | None = None,
    date_formats: Sequence[str] = LOG_DATE_FORMATS,
) -> DataFrame:
    """The blocks :func:`parse_rlog` leaves out."""
    rows = parse_blocks(rlog_blocks(records, root, module), date_formats)
    return rows.filter(F.col("_corrupt").isNotNull()).select(*RECORD, "path", "_corrupt")


def rlog_headers(records: DataFrame, root: str | None = None, module: str | None = None) -> DataFrame:
    """File sections: path, default branch and header text.  Needs no shuffle."""
    header = F.explode("headers").alias("header")
    return (
        _split_records(records.filter(F.col("value").contains(FILE_MARK)), root, module)
        .select(*RECORD, header)
        .filter(F.col("header").rlike(f"(?m)^{FILE_MARK}"))
        .select(
            *RECORD,
            _file_path(F.col("header"), root, module).alias("path"),
            _default_branch(F.col("header")).alias("default_branch"),
            "header",
        )
    )


def parse_tags(records: DataFrame, root: str | None = None, module: str | None = None) -> DataFrame:
    """``tags(tag, path, revision)`` from the symbolic names of the headers.

    Where a path has several sections, the later entry of a tag wins.
    """
    symbols = F.regexp_extract("header", f"(?ms)^{SYMBOLS_MARK}[^\\n]*\\n(.*?)(?=^{SYMBOLS_END}|\\z)", 1)
    entry = r"^\t([^:]+):\s*([0-9.]+)\s*$"
    entries = rlog_headers(records, root, module).select(
        *RECORD, "path", F.posexplode(F.split(symbols, "\n")).alias("line_no", "line")
    )
    parsed = entries.filter(F.col("line").rlike(entry)).select(
        F.trim(F.regexp_extract("line", entry, 1)).alias("tag"),
        "path",
        parse_version(F.regexp_extract("line", entry, 2)).alias("revision"),
        F.struct(*RECORD, "line_no").alias("at"),
    )
    return parsed.groupBy("tag", "path").agg(F.max_by("revision", "at").alias("revision"))


def file_list(records: DataFrame, root: str | None = None, module: str | None = None) -> DataFrame:
    return rlog_headers(records, root, module).select("path").distinct()
