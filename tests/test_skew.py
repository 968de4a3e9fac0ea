"""A third of all rows in one key: no task may get a third of the work."""

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import history, rollup, tags
from palimpsest.session import stored


@pytest.fixture(scope="module")
def log(spark):
    """60,000 commits; every third one is of the same file."""
    n = F.col("id")
    hot = n % 3 == 0
    rows = spark.range(60_000).select(
        F.lit("master").alias("branch"),
        F.when(hot, "hot.txt").otherwise(F.concat(F.lit("d"), n % 50, F.lit("/f"), n % 5000, F.lit(".txt"))).alias("path"),
        F.array(F.lit(1), (n + 1).cast("int")).alias("revision"),
        (n % 17 == 0).alias("is_dead"),
        F.timestamp_seconds(1_600_000_000 + n * 7).alias("date"),
    )
    return stored(rows, "log")


def shares_of_tasks(spark, run):
    """Of every shuffle that ``run`` reads, the share of its records that the largest task got, with its records."""
    store = spark.sparkContext._jsc.sc().statusStore()
    seq = spark._jvm.scala.jdk.javaapi.CollectionConverters
    group = f"shares-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.sparkContext._jsc.clearJobGroup()
    shares = []
    for job in spark.sparkContext.statusTracker().getJobIdsForGroup(group):
        for stage in spark.sparkContext.statusTracker().getJobInfo(job).stageIds:
            try:
                attempt = store.lastStageAttempt(stage).attemptId()
            except Exception:  # a stage that was skipped
                continue
            reads = []
            for task in seq.asJava(store.taskList(stage, attempt, 1000)):
                if task.taskMetrics().isDefined():
                    reads.append(task.taskMetrics().get().shuffleReadMetrics().recordsRead())
            if sum(reads):
                shares.append((max(reads) / sum(reads), sum(reads)))
    return shares


@pytest.fixture
def many_tasks(spark):
    names = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


OPERATORS = {
    "intervals": history.file_intervals,
    "positions": history.commit_positions,
    "parents": lambda rows, hot_rows: history.parent_links(rows, hot_rows=hot_rows),
    "counts": history.live_file_counts,
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("instant", [False, True])
def test_no_task_gets_the_hot_group(spark, log, many_tasks, name, instant):
    """Tasks of the operators' own plans, with a third of all rows in one path, all in one branch, or all in one instant."""
    rows = log.withColumn("date", F.lit("2020-01-01").cast("timestamp")) if instant else log

    def largest(hot_rows):
        made = OPERATORS[name](rows, hot_rows)
        found = shares_of_tasks(spark, lambda: made.write.format("noop").mode("overwrite").save())
        return max(share for share, records in found if records >= 60_000)

    assert largest(1_000_000) > 0.33
    assert largest(2_000) < 0.2


@pytest.mark.parametrize("hot_rows", [1_000, 1_000_000])
def test_results_under_skew(log, hot_rows):
    spans = stored(history.file_intervals(log, hot_rows))
    assert spans.count() == 60_000
    # Every version but the last of each file has a successor, the next higher one.
    assert spans.filter("next_ord is null").count() == log.select("path").distinct().count()
    assert spans.filter(F.col("next_ord.revision") <= F.col("revision")).isEmpty()
    assert spans.filter("opens").count() == log.select("path").distinct().count()
    last = history.commit_positions(log, hot_rows).agg(F.max("position"), F.count_distinct("position")).first()
    assert tuple(last) == (60_000, 60_000)
    live = history.live_file_counts(log, hot_rows).orderBy(F.desc("date")).first().live_files
    end = history.snapshot_asof(log, F.lit("2100-01-01").cast("timestamp"))
    assert live == end.count()


def test_big_tag_and_big_directory(spark, log):
    newest = log.groupBy("path").agg(F.max("revision").alias("revision"))
    big = newest.select(F.lit("big").alias("tag"), "path", "revision")
    small = newest.filter(F.col("path").startswith("d1/")).select(F.lit("small").alias("tag"), "path", "revision")
    located = {r.tag: r.status for r in tags.tag_locate(big.unionByName(small), log).collect()}
    assert located == {"big": "FOUND", "small": "FOUND"}
    files = newest.select("path", F.lit("x").alias("id"))
    assert rollup.dir_digests(files).count() == 51
