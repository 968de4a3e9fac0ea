"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

SCRATCH_COMMIT = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}

#: Folders of local sessions, kept until the process ends.
_local_folders: list[tempfile.TemporaryDirectory] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only where nothing is set and
    the master is local, as in tests, a folder of this process is taken; it goes
    when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if root is None:
        root = sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.TemporaryDirectory(prefix="palimpsest-", ignore_cleanup_errors=True)
        _local_folders.append(folder)
        root = folder.name
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df, name: str = "step"):
    """Write ``df`` once below the shared folder and read it from there.

    Cuts the lineage like a reliable checkpoint, and does more: the readers get
    column pruning, pushdown and true sizes to choose their joins by, and a
    lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    # Nobody reads the folder before this returns, so tasks may move their files there one by one.
    df.write.options(**SCRATCH_COMMIT).parquet(path)
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    frame.scratch_path = path
    return frame


def discard(frame) -> None:
    """Delete a ``stored`` table that no later step reads, so that the shared folder does not fill up."""
    spark = frame.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
