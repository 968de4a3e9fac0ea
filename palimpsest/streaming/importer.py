"""The incremental import as a stream of micro-batches.

A revision that arrives again soon is dropped by the stream itself, in keyed
state that a watermark on the time of arrival keeps bounded; one that arrives
again much later is known from the tables.  Each batch is compared with the
heads as they were before it.  A batch writes below directories named after its
id and replaces them when it runs again, so a restart repeats it without harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from palimpsest.operators.history import branch_heads
from palimpsest.operators.incremental import KEY, after_heads, late_rows
from palimpsest.operators.lookup import noise, useful


ARRIVED = "_arrived"


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def import_batch(batch: DataFrame, batch_id: int, folder: str) -> None:
    """Take one batch of revisions into the tables below ``folder``."""
    spark, schema = batch.sparkSession, batch.schema
    rows = batch.dropDuplicates(list(KEY))
    commits = useful(rows)
    empty = branch_heads(commits).limit(0)
    heads, history = empty, batch.limit(0)
    if batch_id > 0:
        # Each batch leaves the heads of all branches, so the last one is enough.
        heads = spark.read.schema(empty.schema).parquet(f"{folder}/heads/batch={batch_id - 1}")
        history = read_imported(spark, folder, schema, before=batch_id)
    aside = noise(rows)
    if batch_id > 0:
        aside = aside.join(_read(spark, folder, "noise", schema, batch_id).select(*KEY), list(KEY), "left_anti")
    _write(aside, f"{folder}/noise", batch_id)
    _write(after_heads(commits, heads), f"{folder}/revisions", batch_id)
    late = late_rows(commits, heads, history)
    if batch_id > 0:
        late = late.join(_read(spark, folder, "late", schema, batch_id).select(*KEY), list(KEY), "left_anti")
    _write(late, f"{folder}/late", batch_id)
    written = spark.read.schema(schema).parquet(f"{folder}/revisions/batch={batch_id}")
    moved = heads.unionByName(branch_heads(written)).groupBy("branch").agg(F.max("ord").alias("ord"))
    _write(moved, f"{folder}/heads", batch_id)


def start_import(stream: DataFrame, folder: str, checkpoint: str, memory: str = "1 hour", **trigger) -> StreamingQuery:
    """Start the import of a stream of revision rows.

    By default it takes everything available and stops; pass for instance
    ``processingTime='1 minute'`` to go on.  ``memory`` is how long a revision
    stays in the state that drops its repeats.
    """
    # By arrival, not by the revision's own date: a late revision is no repeat and must not be dropped.
    arrived = stream.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, memory)
    once = arrived.dropDuplicatesWithinWatermark(list(KEY)).drop(ARRIVED)
    return (
        once.writeStream.foreachBatch(lambda batch, batch_id: import_batch(batch, batch_id, folder))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_imported(spark: SparkSession, folder: str, schema: StructType, before: int | None = None) -> DataFrame:
    """All revisions taken so far, or those of earlier batches."""
    return _read(spark, folder, "revisions", schema, before)


def read_rows(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Everything that arrived, with its ``kind``: commit, noise or late."""
    parts = {"commit": "revisions", "noise": "noise", "late": "late"}
    rows = [_read(spark, folder, name, schema).withColumn("kind", F.lit(kind)) for kind, name in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _read(spark: SparkSession, folder: str, name: str, schema: StructType, before: int | None = None) -> DataFrame:
    rows = spark.read.schema(StructType([*schema, StructField("batch", LongType())])).parquet(f"{folder}/{name}")
    if before is not None:
        rows = rows.filter(F.col("batch") < before)
    return rows.drop("batch")
