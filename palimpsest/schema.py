"""Table schemas and the names shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

TRUNK = "master"
BRANCH_POINT_SUFFIX = ".branch_point"

VERSION = T.ArrayType(T.IntegerType())

REVISIONS = T.StructType(
    [
        T.StructField("branch", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("revision", VERSION),
        T.StructField("is_dead", T.BooleanType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("author", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("commit_id", T.StringType()),
    ]
)

TAGS = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("revision", VERSION),
    ]
)

CONTENTS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("revision", VERSION),
        T.StructField("content", T.BinaryType()),
    ]
)

# The commit order.  A struct compares field by field, so one column is enough
# for max(), lead() and range filters, and no global row number is needed.
ORDER = ("date", "path_depth", "path", "revision")
# Enough among the versions of one path.
FILE_ORDER = ("date", "revision")


def path_depth(path: Column | str = "path") -> Column:
    """Number of directories above the file."""
    return F.size(F.split(F.col(path) if isinstance(path, str) else path, "/")) - 1


def ord_struct() -> Column:
    """Order key of a revision row: date, then depth, then path, then version."""
    return F.struct(
        F.col("date"),
        path_depth("path").alias("path_depth"),
        F.col("path"),
        F.col("revision"),
    )
