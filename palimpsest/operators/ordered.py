"""Ordered operators that split large groups.

A plain window sends a whole group to one task.  Groups of ordinary size are left to it: one shuffle, nothing else.
A group of more than ``hot_rows`` rows is cut into *cells*, ranges of its order with about that many rows each, whose
bounds come from a sample of the group's own keys; so they are even whatever the order looks like, also if all rows
carry one instant.  The window runs inside a cell, and a summary with one row per cell of a hot group carries what has
to cross from cell to cell.  The result does not depend on where the bounds lie.

The rows are read once for the sizes of the groups, and once more per hot pass for sample and summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from palimpsest.session import stored

CELL, ALL = "_cell", "_all"
#: Rows of one group that a single task may get.
HOT_ROWS = 1 << 20
#: The same for a table that is one group as a whole, so that it is not left to a single task.
TABLE_ROWS = 1 << 16
#: Sampled keys per cell.
SAMPLES = 16
#: A sorted array is searched in this many steps: enough for any array that fits a row.
STEPS = 26


def rank_in(bounds: Column, value: Column, below: bool = False) -> Column:
    """How many elements of the sorted array ``bounds`` are at most ``value`` (or ``below`` it), by bisection."""

    def step(found: Column, jump: Column) -> Column:
        ahead = found + jump
        # Beyond the end there is no element: null, which is not reached.
        element = F.get(bounds, ahead - 1)
        reached = F.coalesce(element < value if below else element <= value, F.lit(False))
        return F.when(reached, ahead).otherwise(found)

    jumps = F.filter(F.array(*(F.lit(1 << k) for k in range(STEPS - 1, -1, -1))), lambda jump: jump <= F.size(bounds))
    return F.aggregate(jumps, F.lit(0), step)


def split_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int = HOT_ROWS, among: Column | None = None
) -> tuple[DataFrame, bool]:
    """``df`` with a column ``_cell``, null in groups that need no cells, and whether there are others.

    ``among`` tells the rows of groups that may be large, where that is known; only these are counted.
    """
    suspects = df if among is None else df.filter(among)
    sizes = suspects.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = stored(sizes.filter(F.col("_rows") > hot_rows).select(*keys), "hot-groups")
    if hot.isEmpty():
        return df.withColumn(CELL, F.lit(None).cast("int")), False
    place = F.struct(*order)
    # Equal places are never apart, so a hash of the place is as good as a random number, and the same in every run.
    drawn = F.pmod(F.xxhash64(*order), F.lit(max(1, hot_rows // SAMPLES))) == 0
    sample = df.filter(drawn).select(*keys, place.alias("_place")).join(hot, list(keys))
    every = F.filter(F.array_sort(F.collect_list("_place")), lambda _, i: i % SAMPLES == SAMPLES - 1)
    bounds = stored(sample.groupBy(*keys).agg(every.alias("_bounds")), "cell-bounds")
    rows = df.join(hot.withColumn("_hot", F.lit(True)), list(keys), "left").join(bounds, list(keys), "left")
    cell = F.when(F.col("_hot"), F.coalesce(rank_in(F.col("_bounds"), place), F.lit(0)))
    return rows.withColumn(CELL, cell).drop("_hot", "_bounds"), True


def _grouped(df: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, list[str], int]:
    return (df, list(keys), hot_rows) if keys else (df.withColumn(ALL, F.lit(0)), [ALL], min(hot_rows, TABLE_ROWS))


def _neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    wanted: Sequence[tuple[Sequence[str], str, bool]],
    outside: DataFrame | None = None,
    opens: str | None = None,
    hot_rows: int = HOT_ROWS,
    among: Column | None = None,
) -> DataFrame:
    """Structs of the neighbours' columns, ``(columns, into, ahead)``, all from one pass."""
    df, group, hot_rows = _grouped(df, keys, hot_rows)
    rows, split = split_hot(df, group, order, hot_rows, among)
    inside = Window.partitionBy(*group, *([CELL] if split else [])).orderBy(*order)
    found = rows
    for columns, into, ahead in wanted:
        step = F.lead if ahead else F.lag
        # Column by column, so that the shuffle does not carry a copy of them.
        near = F.when(
            step(columns[0]).over(inside).isNotNull(),
            F.struct(*(step(name).over(inside).alias(name) for name in columns)),
        )
        found = found.withColumn(into, near)
    if opens:
        found = found.withColumn(opens, F.row_number().over(inside) == 1)
    if split:
        across = Window.partitionBy(*group).orderBy(CELL)
        picked = [
            (F.min_by if ahead else F.max_by)(F.struct(*columns), F.struct(*order)).alias(f"_edge_{into}")
            for columns, into, ahead in wanted
        ]
        far = {f"_far_{into}": (F.lead if ahead else F.lag)(f"_edge_{into}").over(across) for _, into, ahead in wanted}
        edges = (
            rows.filter(F.col(CELL).isNotNull())
            .groupBy(*group, CELL)
            .agg(*picked)
            .withColumns(far | {"_first_cell": F.row_number().over(across) == 1})
            .drop(*(f"_edge_{into}" for _, into, _ in wanted))
        )
        found = found.join(edges, [*group, CELL], "left")
        for _, into, _ in wanted:
            found = found.withColumn(into, F.coalesce(into, f"_far_{into}"))
        found = found.drop(*far)
        if opens:
            found = found.withColumn(opens, F.col(opens) & F.coalesce("_first_cell", F.lit(True)))
    if outside is not None:
        # One row per group.
        found = found.join(outside.toDF(*group, "_outside"), group, "left")
        for _, into, _ in wanted:
            found = found.withColumn(into, F.coalesce(into, "_outside"))
    return found.drop(CELL, ALL, "_first_cell", "_outside")


def next_row(
    df, keys, order, columns: Sequence[str], into: str, opens: str | None = None, hot_rows: int = HOT_ROWS,
    before: Sequence[str] = (),
) -> DataFrame:
    """``columns`` of the following row of the group as a struct, null after the last.

    The first of the columns must not be null.  ``opens`` names a flag to add
    that marks the first row of the group.  ``before`` names columns of the
    preceding row that come along as ``_before``, as from ``previous_row``.
    """
    wanted = [(columns, into, True), *([(before, "_before", False)] if before else [])]
    return _neighbour(df, keys, order, wanted, opens=opens, hot_rows=hot_rows)


def previous_row(
    df, keys, order, columns: Sequence[str], into: str, outside: DataFrame | None = None, hot_rows: int = HOT_ROWS,
    among: Column | None = None,
) -> DataFrame:
    """``columns`` of the preceding row of the group as a struct.

    The first of the columns must not be null.  ``outside``, the keys and such a
    struct, tells what precedes the first row.
    """
    return _neighbour(df, keys, order, [(columns, into, False)], outside=outside, hot_rows=hot_rows, among=among)


_COMBINE = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    into: str,
    how: str = "sum",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running sum, min or max from the first row of the group to this one.

    Rows of equal order are taken one after another.
    """
    return running_all(df, keys, order, {into: (value, how)}, hot_rows)


def running_all(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, tuple[Column, str]],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Several running values, ``{into: (value, how)}``, in one pass."""
    df, group, hot_rows = _grouped(df, keys, hot_rows)
    rows, split = split_hot(df, group, order, hot_rows)
    within = Window.partitionBy(*group, *([CELL] if split else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumns({into: _COMBINE[how][0](value).over(within) for into, (value, how) in values.items()})
    if split:
        before = Window.partitionBy(*group).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
        carried = {into: f"_carried_{k}" for k, into in enumerate(values)}
        totals = rows.filter(F.col(CELL).isNotNull()).groupBy(*group, CELL).agg(
            *(_COMBINE[how][0](value).alias(carried[into]) for into, (value, how) in values.items())
        )
        earlier = totals.select(
            *group, CELL, *(_COMBINE[how][0](carried[into]).over(before).alias(carried[into]) for into, (_, how) in values.items())
        )
        found = found.join(earlier, [*group, CELL], "left")
        for into, (_, how) in values.items():
            both = _COMBINE[how][1](F.col(carried[into]), F.col(into))
            found = found.withColumn(into, F.when(F.col(carried[into]).isNull(), F.col(into)).otherwise(both))
        found = found.drop(*carried.values())
    return found.drop(CELL, ALL)


def position(df, keys, order, into: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """1-based position in the group."""
    return running(df, keys, order, F.lit(1), into, hot_rows=hot_rows)
