"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palimpsest.session import stored

MAX_ROUNDS = 60
LINKS_PER_TASK = 1 << 17


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node in ``links`` (columns ``a, b``), a component being its smallest node.

    Every round hangs all larger neighbours of a node, then all smaller ones, on the smallest known node.  Links
    are written once per round, never collected; a node with very many links meets one row in a join, so AQE can
    split it.
    """
    pairs = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(pairs.distinct(), "links")
    spark, name = links.sparkSession, "spark.sql.shuffle.partitions"
    given = spark.conf.get(name)
    # Rounds are many and links few next to documents: their shuffles are as wide as the links need.
    spark.conf.set(name, str(max(1, min(int(given), -(-edges.count() // LINKS_PER_TASK)))))
    try:
        edges = _settled(edges)
    finally:
        spark.conf.set(name, given)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _settled(edges: DataFrame) -> DataFrame:
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "small-stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges
        before = state
    raise RuntimeError("components did not settle")
