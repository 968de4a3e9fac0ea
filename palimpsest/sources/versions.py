"""Versions of a folder of tables.

A save writes its data into directories of its own, which nobody reads yet, and then publishes a manifest: the list of
directories that make up each table.  The manifest is written aside and renamed to the next number, which either
happens or does not; readers take the highest number.  A save that dies before leaves directories without a manifest
behind, and of two saves from the same version only one can get the next number.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_versions"


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


@dataclass
class Version:
    """What a folder holds: for every table the directories of its parts, the oldest first."""

    spark: SparkSession
    folder: str
    number: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame | None:
        """A table, or nothing where it was never written."""
        parts = self.tables.get(name)
        if not parts:
            return None
        base = f"{self.folder}/{name}"
        return self.spark.read.option("basePath", base).parquet(*(f"{base}/{part}" for part in parts)).drop("save")

    def next(self) -> NextVersion:
        return NextVersion(self)


class NextVersion:
    """A version in the making, invisible until it is published."""

    def __init__(self, before: Version):
        self.before, self.part = before, f"save=s{uuid.uuid4().hex}"
        self.tables = {name: list(parts) for name, parts in before.tables.items()}

    def write(self, rows: DataFrame, name: str, replace: bool = False, by: tuple[str, ...] = ()) -> None:
        """Write rows of a table: a further part, or all of it.  ``by`` names the columns to partition by."""
        writer = rows.write.partitionBy(*by) if by else rows.write
        writer.parquet(f"{self.before.folder}/{name}/{self.part}")
        self.tables[name] = [*([] if replace else self.tables.get(name, [])), self.part]

    def publish(self) -> Version:
        spark, folder, number = self.before.spark, self.before.folder, self.before.number + 1
        fs, path = _files(spark, folder), spark._jvm.org.apache.hadoop.fs.Path
        aside = path(f"{folder}/{MANIFESTS}/.{self.part}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(self.tables, indent=1).encode()))
        out.close()
        final = path(f"{folder}/{MANIFESTS}/{number:09d}.json")
        if fs.exists(final) or not fs.rename(aside, final):
            fs.delete(aside, False)
            raise FileExistsError(f"version {number} of {folder} was published by someone else")
        return Version(spark, folder, number, self.tables)


def current(spark: SparkSession, folder: str) -> Version:
    """The newest published version; number 0 where there is none."""
    fs, path = _files(spark, folder), spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFESTS}")
    if not fs.exists(path):
        return Version(spark, folder)
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if n.endswith(".json") and n[0] != ".")
    if not names:
        return Version(spark, folder)
    text = spark.read.text(f"{folder}/{MANIFESTS}/{names[-1]}", wholetext=True).first()[0]
    return Version(spark, folder, int(names[-1].partition(".")[0]), json.loads(text))
