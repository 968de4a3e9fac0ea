"""A fold that stops early."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.operators import ordered
from palimpsest.session import stored


def fold_while(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    proceed: Callable[[Column], Column],
    how: str = "sum",
    start: Column | None = None,
    hot_rows: int = ordered.HOT_ROWS,
) -> DataFrame:
    """Fold each group in order while ``proceed(accumulator)`` holds.

    The row that makes the condition fail is still folded in.  The result is
    the accumulator at the first such row, or at the last row of the group.
    """
    start = F.lit(0).cast("long") if start is None else start
    combine = {"sum": lambda a: start + a, "min": lambda a: F.least(start, a), "max": lambda a: F.greatest(start, a)}
    folded = ordered.running(df, keys, order, value, "_acc", how, hot_rows).withColumn(
        "_acc", combine[how](F.col("_acc"))
    )
    at = F.struct(*order)
    stop = F.struct(at.alias("at"), F.col("_acc"))
    stopped = F.min(F.when(~proceed(F.col("_acc")), stop))
    last = F.max(stop)
    result = folded.groupBy(*keys).agg(stopped.alias("_stopped"), last.alias("_last"))
    return result.select(
        *keys,
        F.when(~proceed(start), start)
        .otherwise(F.coalesce("_stopped._acc", "_last._acc", start))
        .alias("folded"),
    )


def fold_while_composed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Column,
    compose: Callable[[Column, Column], Column],
    apply: Callable[[Column, Column], Column],
    proceed: Callable[[Column], Column],
    start: Column,
    cell_rows: int = 1 << 12,
) -> DataFrame:
    """``fold_while`` for steps of any kind that can be composed.

    ``step`` describes what a row does to the accumulator, such as a struct of
    factors; ``apply(step, acc)`` does it, and ``compose(first, then)`` is the
    step that does both, which must be associative and of the type of ``step``.
    Groups are cut into cells of about ``cell_rows`` rows.  Every cell is
    composed into one step, cells of cells likewise until one is left, and the
    accumulators go back down to the cells, which fold their rows from there.
    The result does not depend on the cells.
    """
    keys = list(keys)
    rows, _ = ordered.split_hot(df.withColumn("_step", step), keys, order, cell_rows)
    placed = F.struct(F.struct(*order).alias("at"), F.col("_step").alias("step"))
    steps = F.transform(F.array_sort(F.collect_list(placed)), lambda x: x["step"])
    cells = rows.groupBy(*keys, F.coalesce(ordered.CELL, F.lit(0)).alias("cell")).agg(steps.alias("steps"))
    cells = stored(cells, "cells")
    begins = _begins(cells.select(*keys, "cell", _whole(F.col("steps"), compose).alias("whole")), keys, compose, apply, start, cell_rows)

    def on(acc: Column, x: Column) -> Column:
        # Once it has stopped the accumulator stays as it is.
        going = proceed(acc)
        return F.when(going, apply(x, acc)).otherwise(acc)

    kind = begins.schema["begin"].dataType
    ended = cells.join(begins, [*keys, "cell"]).select(*keys, "cell", F.aggregate("steps", F.col("begin").cast(kind), on).cast(kind).alias("acc"))
    stopped = F.min_by("acc", F.when(~proceed(F.col("acc")), F.col("cell")))
    return ended.groupBy(*keys).agg(stopped.alias("_stopped"), F.max_by("acc", "cell").alias("_last")).select(
        *keys, F.when(~proceed(start), start).otherwise(F.coalesce("_stopped", "_last")).alias("folded")
    )


def _whole(steps: Column, compose: Callable[[Column, Column], Column]) -> Column:
    return F.aggregate(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), F.get(steps, 0), compose)


def _begins(cells: DataFrame, keys: list[str], compose, apply, start: Column, width: int) -> DataFrame:
    """``keys, cell, begin``: the accumulator before every cell (``keys, cell, whole``)."""
    width = max(2, width)
    listed = F.array_sort(F.collect_list(F.struct("cell", "whole")))
    groups = cells.groupBy(*keys, F.floor(F.col("cell") / width).cast("int").alias("_group")).agg(listed.alias("cells"))
    highest = cells.agg(F.max("cell")).first()[0]
    if highest is None or highest < width:
        groups = groups.withColumn("begin", start)
    else:
        wholes = F.transform("cells", lambda c: c["whole"])
        upper = stored(groups.select(*keys, F.col("_group").alias("cell"), _whole(wholes, compose).alias("whole")), "cells-of-cells")
        above = _begins(upper, keys, compose, apply, start, width).withColumnRenamed("cell", "_group")
        groups = groups.join(above, [*keys, "_group"])
    # The accumulators before the first cell, the second and so on.
    first = F.struct(F.col("begin").alias("acc"), F.array(F.col("begin")).alias("all"))

    def further(state: Column, cell: Column) -> Column:
        acc = apply(cell["whole"], state["acc"])
        return F.struct(acc.alias("acc"), F.concat(state["all"], F.array(acc)).alias("all"))

    walked = groups.withColumn("accs", F.aggregate("cells", first, further, lambda state: state["all"]))
    return walked.select(*keys, F.explode(F.arrays_zip(F.transform("cells", lambda c: c["cell"]).alias("cell"), F.slice("accs", F.lit(1), F.size("cells")).alias("begin"))).alias("x")).select(
        *keys, F.col("x.cell").alias("cell"), F.col("x.begin").alias("begin")
    )
