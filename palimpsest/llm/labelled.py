"""Bounded samples of labelled documents, the only rows that models are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.llm.common import documents_of


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``rows`` labelled documents for which ``train`` holds.

    The choice goes by a hash of the id.  At most ``rows`` ids are sent to the executors, so no text moves.
    Labels that are null or contradict each other are not used.
    """
    wanted = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & train)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter(F.col("label") == F.col("most"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        .select("doc_id", "label")
    )
    return documents_of(docs).join(F.broadcast(wanted), "doc_id")
