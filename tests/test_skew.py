"""A key holding a third of all rows is folded before the shuffle, not sent whole to one task.

The evidence is the exchange's own ``shuffleRecordsWritten`` metric after
the query ran: it must stay near the number of distinct groups (plus one
folded row per map task), far below the input row count.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import gold
from strata.operators.rules import Dedup, deduplicate

ROWS = 30_000
MAPS = 8


def shuffled_records(df):
    """Records written by each shuffle exchange of an executed query, in plan order."""
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        ch = node.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


@pytest.fixture(scope="module")
def reviews(spark):
    """Reviews where business 'hot' and review id 'dup' each hold a third of all rows."""
    i = F.col("id")
    df = spark.range(ROWS, numPartitions=MAPS).select(
        F.when(i % 3 == 0, F.lit("dup")).otherwise(i.cast("string")).alias("review_id"),
        F.lit("u").alias("user_id"),
        F.when(i % 3 == 1, F.lit("hot")).otherwise(F.concat(F.lit("b"), (i % 500).cast("string"))).alias("business_id"),
        (i % 5).cast("double").alias("stars"),
        (i % 7).cast("int").alias("useful"),
        (i % 2).cast("int").alias("funny"),
        F.lit(None).cast("int").alias("cool"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (i % 70).cast("int")).alias("review_date"),
        F.concat(F.lit("text "), i.cast("string")).alias("review_text"),
    )
    return df.cache()


def test_hot_duplicate_key_folded_before_shuffle(reviews):
    out = deduplicate(reviews, Dedup(("review_id",)))
    rows = out.collect()
    distinct = ROWS - ROWS // 3 + 1
    assert len(rows) == distinct
    # The survivor of 'dup' is the first by payload order, whatever the partitioning.
    dup = [r for r in rows if r.review_id == "dup"][0]
    assert dup.user_id == "u" and dup.business_id == "b0" and dup.stars == 0.0
    (records,) = [n for n in shuffled_records(out) if n != ROWS] or [None]
    assert records is not None and records <= distinct + MAPS


def test_hot_business_folded_before_weekly_shuffle(reviews):
    out = gold.weekly_agg(reviews)
    rows = out.collect()
    hot = [r for r in rows if r.business_id == "hot"]
    assert sum(r.review_count_weekly for r in hot) == ROWS // 3
    # The hot third arrives as at most one row per (week, map task); the
    # other rows are nearly all distinct groups and pass as they are.
    assert max(shuffled_records(out)) <= (ROWS - ROWS // 3) + len(hot) * MAPS


def test_hot_business_folded_before_checkin_count(spark):
    i = F.col("id")
    checkins = spark.range(ROWS, numPartitions=MAPS).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("b"), (i % 100).cast("string"))).alias("business_id"),
        F.timestamp_seconds(i).alias("checkin_timestamp"),
    )
    out = gold.checkin_counts(checkins)
    counts = {r.business_id: r.total_checkins for r in out.collect()}
    assert counts["hot"] == ROWS // 3
    assert max(shuffled_records(out)) <= len(counts) * MAPS


def test_hot_partition_value_spread_over_writers(spark):
    import os

    from strata.plans.session import scratch_path
    from strata.sources.sinks import write_partitioned

    i = F.col("id")
    df = spark.range(ROWS, numPartitions=MAPS).select(
        F.when(i % 3 == 0, F.lit(2020)).otherwise((2000 + i % 5).cast("int")).alias("review_year"),
        F.concat(F.lit("b"), i.cast("string")).alias("business_id"),
        F.concat(F.lit("payload "), i.cast("string")).alias("payload"),
    )
    path = scratch_path(spark, "test-hot-partition")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "32k")
    try:
        assert write_partitioned(df, path, ("review_year",), ("business_id",)) == ROWS
    finally:
        spark.conf.unset(key)
    hot_dir = path.removeprefix("file:") + "/review_year=2020"
    files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(files) > 1  # split over several writing tasks
    assert spark.read.parquet(path).filter("review_year = 2020").count() == ROWS // 3


def test_one_big_raw_file_is_read_by_many_tasks(spark):
    """A single JSON dump holding every row is split by byte ranges, not read by one task."""
    from strata.plans.layers import Layout, RunSpec, run_bronze
    from strata.plans.session import SPLIT_BYTES, layer_session, scratch_path
    from strata.sources.raw import RAW_SCHEMAS, read_raw

    root = scratch_path(spark, "test-big-file")
    i = F.col("id")
    spark.range(200_000, numPartitions=1).select(
        i.cast("string").alias("review_id"), F.lit("u").alias("user_id"), F.lit("b").alias("business_id"),
        (i % 5).cast("double").alias("stars"), F.lit("2019-01-01 10:00:00").alias("date"),
        F.concat(F.lit("text "), i.cast("string")).alias("text"),
    ).coalesce(1).write.json(f"{root}/raw/yelp_academic_dataset_review.json")
    lay = Layout(root=root, raw=f"{root}/raw")
    small = layer_session(spark, {SPLIT_BYTES: str(2 * 1024 * 1024)})
    df = read_raw(small, lay.raw_file("review"), RAW_SCHEMAS["review"])
    assert df.rdd.getNumPartitions() >= 4  # ~20 MB file, 2 MiB splits, any core count
    # Every row lands once, however the file was cut.
    counts = run_bronze(spark, lay, RunSpec(datasets=("review",), raw_split_bytes=1024 * 1024))
    assert counts == {"review": 200_000}
    assert spark.read.parquet(lay.bronze("review")).select("review_id").distinct().count() == 200_000
