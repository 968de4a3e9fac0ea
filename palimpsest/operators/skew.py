"""Joins that spread a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 32
SALT = "_salt"


def salted_join(
    rows: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread: Column,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join many rows per key to a side with few rows per key.

    ``small`` is repeated once per salt; the rows of one key go to as many
    tasks as there are salts.  ``spread`` should differ among a key's rows.
    """
    salted = rows.withColumn(SALT, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, SALT], how).drop(SALT)
