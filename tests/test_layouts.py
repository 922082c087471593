"""Layouts, caching and footer counts: what the plans no longer do."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import gold, state
from strata.plans import layers
from strata.plans.layers import RunSpec, layer_counts, persisted, run_layers
from strata.plans.session import scratch_path
from strata.registry import silver, write_raw_files
from strata.sources.layouts import ordered_files, read_bucketed, read_ordered, write_bucketed, write_ordered
from conftest import SMALL


def scratch(spark):
    return scratch_path(spark, "test-layouts")


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def layout(spark):
    lay = write_raw_files(spark, SMALL, f"{scratch(spark)}/raw")
    run_layers(spark, lay, RunSpec())
    return lay


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_an_exchange(spark, layout):
    sums, business = f"{scratch(spark)}/sums", f"{scratch(spark)}/business"
    reviews, companies = spark.read.parquet(layout.silver("review")), spark.read.parquet(layout.silver("business"))
    n = write_bucketed(gold.weekly_sums(reviews), sums, "business_id", 4)
    assert write_bucketed(companies, business, "business_id", 4) == companies.count() and n == gold.weekly_sums(reviews).count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for again in (False, True):
            got = state.weekly_stars(read_bucketed(spark, sums), read_bucketed(spark, business))
            assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got) and "SelectedBucketsCount: 4 out of 4" in plan(got)
            assert rows(got) == rows(gold.weekly_stars(reviews, companies))
            merged = state.merged(read_bucketed(spark, sums), state.CHECKIN_KEYS + gold.WEEK_KEYS[1:])
            assert "Exchange" not in plan(merged)  # sums of later batches add up without one, too
            if not again:  # a session whose catalog does not know the tables finds them by their paths
                for t in spark.catalog.listTables():
                    if t.name.startswith("strata_buckets_"):
                        spark.sql(f"drop table {t.name}")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_business_is_few_rows_in_its_bucket(spark):
    i = F.col("id")
    reviews = spark.range(30_000, numPartitions=8).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(i.cast("string")).alias("business_id"), F.lit(4.0).alias("stars"),
        *[F.lit(1).alias(c) for c in ("useful", "funny", "cool")], F.date_add(F.lit("2020-01-01").cast("date"), (i % 70).cast("int")).alias("review_date"),
    )
    path = f"{scratch(spark)}/hot"
    write_bucketed(gold.weekly_sums(reviews), path, "business_id", 4)
    per_file = read_bucketed(spark, path).groupBy(F.input_file_name()).count().agg(F.max("count"), F.min("count")).first()
    assert per_file[0] < 1.2 * per_file[1]
    # A second write replaces the first, buckets included.
    write_bucketed(gold.weekly_sums(reviews.limit(10)), path, "business_id", 2)
    assert read_bucketed(spark, path).count() <= 10


def test_files_in_order_are_the_table_in_order(spark, layout):
    weekly = gold.weekly_stars(spark.read.parquet(layout.silver("review")), spark.read.parquet(layout.silver("business")))
    want = [tuple(r) for r in gold.sort_weekly(weekly).collect()]
    path = scratch(spark)
    assert write_ordered(weekly, path, gold.WEEK_KEYS, 5) == len(want)
    assert len(ordered_files(spark, path)) == 5
    got = read_ordered(spark, path)
    assert "Sort" not in plan(got) and "Exchange" not in plan(got)
    assert [tuple(r) for r in got.collect()] == want
    one = [tuple(r) for r in read_ordered(spark, path, 1).collect()]
    assert one == want[: len(one)] and 0 < len(one) < len(want)


def test_hot_first_key_is_spread(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([("hot" if k % 3 else f"b{k}", rnd.random()) for k in range(9000)], "a string, b double").repartition(6)
    path = scratch(spark)
    write_ordered(df, path, ("a", "b"), 6)
    sizes = [spark.read.parquet(f).count() for f in ordered_files(spark, path)]
    assert max(sizes) < 2 * 9000 / 6
    assert [tuple(r) for r in read_ordered(spark, path).collect()] == [tuple(r) for r in df.orderBy("a", "b").collect()]


def test_counts_come_from_footers(spark, layout):
    counts = layer_counts(spark, layout)
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)]") == 12 and "ReadSchema: struct<count(*):bigint>" in text
    assert {(r.layer, r.dataset): r.row_count for r in counts.collect()}["silver", "tip"] == spark.read.parquet(layout.silver("tip")).count()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # the caller's session is as it was


def test_business_kept_for_both_gold_tables(spark, layout, monkeypatch):
    seen = []
    build = layers.build_weekly_stars
    monkeypatch.setattr(layers, "build_weekly_stars", lambda *a: (seen.append(plan(build(*a))), build(*a))[1])
    want = {g: rows(spark.read.parquet(layout.gold(g))) for g in layers.GOLD_TABLES}
    layers.run_gold(spark, layout, RunSpec(cache_business=True))
    assert "InMemoryTableScan" in seen[0]
    assert {g: rows(spark.read.parquet(layout.gold(g))) for g in layers.GOLD_TABLES} == want
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_persist_is_bounded_and_ends(spark):
    df = spark.range(10)
    with persisted(df, 1 << 60) as out:  # too large
        assert out is df and not out.is_cached
    with persisted(df, None) as out:
        assert not out.is_cached
    with pytest.raises(ValueError), persisted(df, 100) as out:
        assert out.is_cached
        raise ValueError
    assert not df.is_cached


def test_silver_has_what_gold_reads(spark):
    assert set(layers.BUSINESS_COLUMNS) <= set(silver(spark, SMALL, "business").columns)
