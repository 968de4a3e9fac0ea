"""Corpus pipeline: quality, exact dedup, near dedup, decontamination, packing.

Every stage reads the documents that its predecessor kept and, but for the last, returns their columns.  Stages
are written as Parquet below the shared folder, so a lost executor costs a part of one stage.

Nulls in any column are kept as they are: a null text counts as empty, a row without an id is a document of its
own.  Rows that repeat both id and text come out of exact dedup once.  An empty table gives empty stages.  Without
labels the quality stage keeps everything.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import decontamination, exact_dedup, near_dedup, packing, quality
from palimpsest.llm.common import prepared, table
from palimpsest.llm.labelled import fold_of
from palimpsest.llm.queries import tokenizer
from palimpsest.session import scratch_path, stored

THRESHOLD, END_ID, SEQUENCE = 0.7, 2, 1024


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels outside the held-out fold."""
    prepared(spark)
    machine = quality.train(docs, table(spark, sf_dir, "labels"), use=fold_of("doc_id", 4) != 2)
    return quality.keep(docs, machine, THRESHOLD)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text, the one with the largest id."""
    prepared(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = exact_dedup.DigestIndex(f"digests_{uuid4().hex}", scratch_path(spark, "digest-index"), buckets)
    return exact_dedup.keep(docs, index, batch="pipeline")


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest id, a null one coming last."""
    prepared(spark)
    return near_dedup.keep(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    prepared(spark)
    return decontamination.keep(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences."""
    prepared(spark)
    paths = tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken")
    return packing.pack_documents(docs, *paths, end_id=END_ID, size=SEQUENCE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", dissimilar_documents),
    ("decontamination", clean_documents),
    ("packing", packed_sequences),
]

#: The classifier's scores and the packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
