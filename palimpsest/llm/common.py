"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palimpsest.session import configure

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: A word: digits, letters a to z, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; of null, none."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that the operators read, so that no other column can clash with theirs."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def spare_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``frame`` has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, and record batches small enough for long texts."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def thrifty(run):
    """An Arrow function whose worker gives freed memory back when a partition is done.

    Spark keeps workers for later tasks, and an idle one would hold on to what
    its allocators keep for reuse.
    """

    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return task
