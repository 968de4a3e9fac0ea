"""Exact dedup against a persistent digest index.

The index is a table with one row per distinct text: its SHA-256, the document that stays, the number of rows
seen when the text came in, and the batch it came with.  It is bucketed and sorted by digest, so a new batch is
compared by a sort-merge anti-join that shuffles and sorts the batch only, and then appended.  Texts never move:
only (id, digest) rows are shuffled, and copies are counted map-side before they meet, so a text that holds a
third of all rows costs one row per task.  Reporting joins every row to its group; there AQE may split the
partition of a hot digest, as the group side has one row per digest.

Defined cases: a null text is the empty text; of equal texts the largest id of the batch stays (a null id only
if there is no other); rows that repeat both id and text come out once, counted as often as they occur; an empty
batch gives an empty result; other columns are ignored.  A text that an earlier batch brought is never kept
again.  A batch that is run twice under one ``batch`` name changes nothing and reports the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.llm.common import documents_of, spare_name
from palimpsest.session import stored

SCHEMA = "digest binary, keep_id bigint, n bigint, batch string"


@dataclass(frozen=True)
class DigestIndex:
    """A catalog table; ``path`` places its files, ``buckets`` fixes its layout when it is made."""

    name: str
    path: str | None = None
    buckets: int = 64

    def rows(self, spark: SparkSession) -> DataFrame:
        if not spark.catalog.tableExists(self.name):
            return spark.createDataFrame([], SCHEMA)
        return spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        writer = rows.select("digest", "keep_id", "n", "batch").repartition(self.buckets, "digest").write
        writer = writer.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").mode("append")
        if self.path:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.name)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, n``: every (id, text) pair with the number of its rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents_of(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"))
    return rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def dedup(
    docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Append the new texts of ``docs`` to ``index``; one row per document with the document that stays.

    Columns: ``doc_id, keep_id, group_size, kept, text_sha256, n``.  ``group_size`` counts the rows of the batch
    with this text and those counted in the index.
    """
    spark = docs.sparkSession
    rows = stored(digests(docs, id_col, text_col), "digests")
    groups = stored(
        rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("n")), "digest-groups"
    )
    indexed = index.rows(spark)
    known = indexed.filter(F.col("batch") != batch).select(
        "digest", F.col("keep_id").alias("known_id"), F.col("n").alias("known_n")
    )
    new = groups.join(known.hint("merge"), "digest", "left_anti")
    seen = groups.join(known.hint("merge"), "digest").select(
        "digest", F.col("known_id").alias("keep_id"), (F.col("n") + F.col("known_n")).alias("n"), F.lit(True).alias("seen")
    )
    decided = stored(
        new.select("digest", "keep_id", "n", F.lit(False).alias("seen")).unionByName(seen), "digest-decisions"
    )
    index.append(
        decided.filter(~F.col("seen")).join(indexed.select("digest").hint("merge"), "digest", "left_anti")
        .withColumn("batch", F.lit(batch))
    )
    kept = ~F.col("seen") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.join(decided.withColumnRenamed("n", "group_size"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n",
    )


def keep(
    docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, all columns as they were.

    Rows meet their decision by digest and id together, so the copies of a hot text are spread over all tasks.
    """
    digest, place, other = (spare_name(docs, name) for name in ("digest_key", "id_key", "kept_id"))
    kept = dedup(docs, index, batch, id_col, text_col).filter("kept").select(
        F.col("text_sha256").alias(digest), F.xxhash64("doc_id").alias(place), F.col("doc_id").alias(other)
    )
    keyed = docs.withColumns(
        {
            digest: F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256),
            place: F.xxhash64(F.col(id_col).cast("long")),
        }
    )
    same = F.col(id_col).cast("long").eqNullSafe(F.col(other))
    return keyed.join(kept, [digest, place]).filter(same).dropDuplicates([digest, place]).select(*docs.columns)
