"""Which intervals hold at which points, for many of both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from palimpsest.operators import ordered
from palimpsest.session import stored

#: Bins of one key.  As long as a key has no more points than bins, every bin is one point.
BINS = 4096
#: As many points of a key are compared with a span one by one in less time than a bin is found.
FEW = 64


def spans_at(
    spans: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    start: str = "ord",
    end: str = "next_ord",
    at: str = "at",
    bins: int = BINS,
    hot_rows: int = ordered.HOT_ROWS,
    few: int = 0,
) -> DataFrame:
    """Pairs of a span and a point of the same key with ``start <= at < end``.

    A null start or end is open.  A binned join: the points of a key are cut
    into ranges of equal size, at most ``bins``; a span is copied to the bins it
    reaches into, found by bisection in the key's bounds, and meets the points of
    a bin in an equi-join.  A bin in the middle of a span belongs to the result
    whole, so beyond the result there are at most two bins' points per span.
    Where no key has more than ``few`` points, a span meets all of its key.
    The columns of both sides must differ but for the keys.
    """
    keys = list(keys)
    holds = (F.col(start).isNull() | (F.col(start) <= F.col(at))) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    if few and points.groupBy(*keys).count().filter(F.col("count") > few).isEmpty():
        return spans.join(points, keys).filter(holds)
    numbered = ordered.position(points, keys, [at], "_pos", hot_rows)
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    width = F.ceil(F.col("_n") / bins)
    binned = numbered.join(sizes, keys).withColumn("_bin", F.floor((F.col("_pos") - 1) / width).cast("int"))
    binned = stored(binned.drop("_pos", "_n"), "binned-points")
    firsts = binned.groupBy(*keys, "_bin").agg(F.min(at).alias("_first"))
    # The bounds between the bins: all firsts but the smallest.
    bounds = firsts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("_bin") > 0, F.col("_first")))).alias("_bounds"))
    # A point that equals a bound may lie on either side of it.
    low = F.when(F.col(start).isNull(), 0).otherwise(ordered.rank_in(F.col("_bounds"), F.col(start), below=True))
    high = F.when(F.col(end).isNull(), F.size("_bounds")).otherwise(ordered.rank_in(F.col("_bounds"), F.col(end), below=True))
    copies = spans.join(stored(bounds, "bin-bounds"), keys).withColumn("_bin", F.explode(F.sequence(low, F.greatest(low, high))))
    return copies.drop("_bounds").join(binned, [*keys, "_bin"]).filter(holds).drop("_bin")
