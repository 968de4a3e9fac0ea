"""Splitting a group into cells must not change any result."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from palimpsest.operators import ordered
from palimpsest.operators.fold import fold_while, fold_while_composed
from palimpsest.operators.skew import salted_join


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    start = dt.datetime(2020, 1, 1)
    # A third of all rows belongs to one key; many rows share their second.
    data = [
        (
            "hot" if i % 3 == 0 else f"k{rng.randrange(40)}",
            start + dt.timedelta(hours=rng.randrange(400), seconds=rng.randrange(3)),
            i,
            rng.randrange(-5, 9),
        )
        for i in range(3000)
    ]
    return spark.createDataFrame(data, "key string, date timestamp, id long, v long").cache()


@pytest.mark.parametrize("hot_rows", [1, 20, 400, ordered.HOT_ROWS])
def test_same_as_plain_windows(rows, hot_rows):
    keys, order = ["key"], ["date", "id"]
    df = ordered.next_row(rows, keys, order, ["id", "v"], "nxt", hot_rows=hot_rows)
    df = ordered.previous_row(df, keys, order, ["id", "v"], "prv", hot_rows=hot_rows)
    df = ordered.position(df, keys, order, "pos", hot_rows)
    values = {how: (F.col("v"), how) for how in ("sum", "min", "max")}
    df = ordered.running_all(df, keys, order, values, hot_rows)
    plain_window = Window.partitionBy("key").orderBy("date", "id")
    upto = plain_window.rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.select(
        *rows.columns,
        F.lead("id").over(plain_window).alias("nxt"),
        F.lag("id").over(plain_window).alias("prv"),
        F.row_number().over(plain_window).cast("long").alias("pos"),
        F.sum("v").over(upto).alias("sum"),
        F.min("v").over(upto).alias("min"),
        F.max("v").over(upto).alias("max"),
    )
    assert df.filter("nxt.v is null and nxt is not null").isEmpty()
    df = df.withColumn("nxt", F.col("nxt.id")).withColumn("prv", F.col("prv.id"))
    mine = sorted(tuple(r) for r in df.select(plain.columns).collect())
    assert mine == sorted(tuple(r) for r in plain.collect())


@pytest.mark.parametrize("hot_rows", [50, ordered.HOT_ROWS])
def test_first_row_follows_outside_value(spark, rows, hot_rows):
    outside = spark.createDataFrame([("hot", (-1,))], "key string, at struct<id:bigint>")
    df = ordered.previous_row(rows, ["key"], ["date", "id"], ["id"], "prv", outside, hot_rows)
    missing = df.filter("prv is null").select("key").collect()
    assert "hot" not in {r.key for r in missing} and len(missing) == df.select("key").distinct().count() - 1
    assert df.filter("prv.id = -1").count() == 1


def test_cells_of_one_instant_are_even(rows):
    piled = rows.withColumn("date", F.lit("2020-01-01").cast("timestamp"))
    laid, split = ordered.split_hot(piled, ["key"], ["date", "id"], 100)
    assert split
    cells = {(r.key, r[ordered.CELL]): r["count"] for r in laid.groupBy("key", ordered.CELL).count().collect()}
    hot = [n for (key, _), n in cells.items() if key == "hot"]
    assert sum(hot) == 1000 and len(hot) > 5 and max(hot) < 300
    assert all(cell is None for key, cell in cells if key != "hot")
    df = ordered.position(piled, [], ["date", "id"], "pos", 100)
    assert df.filter(F.col("pos") != F.col("id") + 1).count() == 0
    assert df.columns == [*piled.columns, "pos"]


def test_rank_in_sorted_array(spark):
    bounds = [2, 3, 3, 7]
    frame = spark.createDataFrame([(bounds, v) for v in range(9)] + [([], 1), (None, 1)], "b array<int>, v int")
    got = [r[0] for r in frame.select(ordered.rank_in(F.col("b"), F.col("v"))).collect()]
    assert got == [sum(x <= v for x in bounds) for v in range(9)] + [0, 0]


def test_salted_join_keeps_every_row(spark, rows):
    small = rows.groupBy("key").agg(F.count("*").alias("n")).filter("key <> 'k1'")
    joined = salted_join(rows, small, ["key"], F.col("id"), "left")
    assert joined.count() == rows.count()
    assert joined.filter("n is null").select("key").distinct().collect()[0].key == "k1"


@pytest.mark.parametrize(
    ("values", "limit", "result"),
    [([5] * 10, 40, 40), ([5] * 10, 31, 35), ([1, 2, 3, 4, 5], 100, 15), ([7, 7], 0, 0), ([50, -45, 9], 40, 50)],
)
def test_fold_while(spark, values, limit, result):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(values)], "g string, i int, v long")
    for hot_rows in (1, 2, 100):
        folded = fold_while(df, ["g"], ["i"], F.col("v"), lambda acc: acc < limit, hot_rows=hot_rows)
        assert folded.first().folded == result


@pytest.mark.parametrize("cell_rows", [1, 2, 7, 5000])
def test_fold_with_affine_steps(spark, cell_rows):
    """Balances with interest: every row multiplies, then adds."""
    rng = random.Random(4)
    data = [(f"g{k % 3 if k % 2 else 0}", k, rng.choice([1, 1, 2, -1]), rng.randrange(-3, 6)) for k in range(60)]
    df = spark.createDataFrame(data, "g string, i long, a long, b long")
    folded = fold_while_composed(
        df, ["g"], ["i"], F.struct("a", "b"),
        compose=lambda f, g: F.struct((g["a"] * f["a"]).alias("a"), (g["a"] * f["b"] + g["b"]).alias("b")),
        apply=lambda f, acc: f["a"] * acc + f["b"],
        proceed=lambda acc: F.abs(acc) < 40,
        start=F.lit(1).cast("long"),
        cell_rows=cell_rows,
    )
    expected = {}
    for g in {r[0] for r in data}:
        acc = 1
        for _, _, a, b in sorted(r for r in data if r[0] == g):
            acc = a * acc + b if abs(acc) < 40 else acc
        expected[g] = acc
    assert {r.g: r.folded for r in folded.collect()} == expected


def test_fold_of_nothing(spark):
    df = spark.createDataFrame([], "g string, i int, v long")
    assert fold_while(df, [], ["i"], F.col("v"), lambda acc: acc < 9).first().folded == 0


def test_whole_table_is_cut_finer_than_a_group(spark, monkeypatch):
    """A window without keys does not leave the table, and all that follows, to one task."""
    monkeypatch.setattr(ordered, "TABLE_ROWS", 100)
    frame = spark.range(1000).select("id", (F.col("id") * 7 % 1000).alias("n"))
    found = ordered.previous_row(frame, [], ["n"], ["n"], "before")
    assert {(r.n, r.before and r.before.n) for r in found.collect()} == {(n, n - 1 if n else None) for n in range(1000)}
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
