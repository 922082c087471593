"""Physical plan shapes that the design relies on."""

import re

import pytest

from conftest import SMALL
from strata.operators import gold
from strata.operators.rules import clean
from strata.operators.silver import SPECS
from strata.plans.session import scratch_path
from strata.sources.fixtures import raw
from strata.sources.sinks import write_partitioned


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark):
    root = scratch_path(spark, "test-plans")
    for n in ("business", "review", "checkin"):
        raw(spark, SMALL, n).write.parquet(f"{root}/bronze/{n}")
        clean(spark.read.parquet(f"{root}/bronze/{n}"), SPECS[n]).write.parquet(f"{root}/silver/{n}")
    return root


def test_dedup_folds_before_the_shuffle(spark, bronze):
    df = clean(spark.read.parquet(f"{bronze}/bronze/review"), SPECS["review"])
    p = plan(df)
    # A partial top-1 per key sits below the one exchange: a hot key is cut before shuffling.
    exch = p.index("Exchange hashpartitioning(review_id")
    below = p[exch:]
    assert "WindowGroupLimit [review_id" in below and "Partial" in below
    assert p.count("Exchange") == 1


@pytest.mark.parametrize("key,value", [
    ("spark.sql.optimizer.windowGroupLimitThreshold", "-1"),
    ("spark.sql.optimizer.excludedRules", "org.apache.spark.sql.catalyst.optimizer.InferWindowGroupLimit"),
])
def test_dedup_without_window_group_limit_aggregates_partially(spark, bronze, key, value):
    bronze_review = spark.read.parquet(f"{bronze}/bronze/review")
    by_window = clean(bronze_review, SPECS["review"]).collect()
    spark.conf.set(key, value)
    try:
        df = clean(bronze_review, SPECS["review"])
        p = plan(df)
        exch = p.index("Exchange hashpartitioning(review_id")
        assert "partial_min" in p[exch:] and "Window" not in p
        # Same survivors either way.
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, by_window))
    finally:
        spark.conf.unset(key)


def test_range_filter_pushed_and_columns_pruned(spark, bronze):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        df = clean(spark.read.parquet(f"{bronze}/bronze/review"), SPECS["review"])
        p = plan(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = p[p.index("PushedFilters: [") :].split("]")[0]
    for f in ("IsNotNull(review_id)", "IsNotNull(user_id)", "IsNotNull(business_id)", "IsNotNull(stars)",
              "GreaterThanOrEqual(stars,0.0)"):
        assert f in pushed
    w = gold.weekly_stars(spark.read.parquet(f"{bronze}/silver/review"), spark.read.parquet(f"{bronze}/silver/business"))
    scan = [ln for ln in plan(w).splitlines() if "FileScan parquet [review_id" in ln][0]
    assert "review_text" not in scan


def test_weekly_aggregates_partially_before_exchange(spark, bronze):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = gold.weekly_stars(
            spark.read.parquet(f"{bronze}/silver/review"), spark.read.parquet(f"{bronze}/silver/business")
        )
        p = plan(w)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "partial_avg" in p and "partial_count" in p
    assert "SortMergeJoin" in p
    # review side: one exchange for the group-by, one for the join; business side: one.
    assert p.count("Exchange hashpartitioning") == 3


def test_checkin_dedup_is_a_hash_aggregate(spark, bronze):
    df = clean(spark.read.parquet(f"{bronze}/bronze/checkin"), SPECS["checkin"])
    p = plan(df)
    assert "HashAggregate" in p and "Window" not in p


def test_partitioned_write_rebalances(spark, bronze):
    w = gold.weekly_stars(spark.read.parquet(f"{bronze}/silver/review"), spark.read.parquet(f"{bronze}/silver/business"))
    laid = w.hint("rebalance", "review_week").sortWithinPartitions("review_week", "business_id")
    assert "REBALANCE_PARTITIONS_BY_COL" in laid._jdf.queryExecution().optimizedPlan().toString() or \
        "RebalancePartitions" in laid._jdf.queryExecution().optimizedPlan().toString()
    path = scratch_path(spark, "test-rebalance")
    write_partitioned(w, path, ("review_week",), ("business_id",))
    assert spark.read.parquet(path).count() == w.count()


def test_top_k_is_fused(spark, bronze):
    from strata.operators import analyses as A

    w = gold.weekly_stars(spark.read.parquet(f"{bronze}/silver/review"), spark.read.parquet(f"{bronze}/silver/business"))
    p = plan(A.top_businesses_by_year(w, 1998))
    assert "TakeOrderedAndProject" in p
    # The year filter reaches the review scan.
    scan = [ln for ln in p.splitlines() if "FileScan parquet [review_id" in ln][0]
    assert "1998" in scan


def _scan_rows(df):
    """Rows the Parquet scan handed on after row-group filtering (query runs first)."""
    df.collect()
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            out.append(node.metrics().apply("numOutputRows").value())
        ch = node.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(out)


def test_bloom_filter_skips_row_groups(spark):
    from pyspark.sql import functions as F

    from strata.sources.sinks import bloom_filter_options, write_table

    # Ids shuffled inside each file: the min/max statistics of a row group span
    # its file's whole id block, and with dictionaries off only a bloom filter
    # can rule an id out.
    df = spark.range(200_000, numPartitions=4).select(
        F.concat(F.lit("id"), F.col("id").cast("string")).alias("business_id"), F.rand(7).alias("r")
    ).sortWithinPartitions("r")
    paths = {}
    for label, cols in (("plain", ()), ("bloom", ("business_id",))):
        paths[label] = scratch_path(spark, f"test-bloom-{label}")
        df.write.option("parquet.block.size", 64 * 1024).option("parquet.enable.dictionary", "false").options(
            **bloom_filter_options(cols)
        ).parquet(paths[label])
    absent = F.col("business_id") == "id1234x"  # inside the min/max range of two of the four files
    plain = _scan_rows(spark.read.parquet(paths["plain"]).filter(absent))
    bloom = _scan_rows(spark.read.parquet(paths["bloom"]).filter(absent))
    assert plain >= 50_000
    assert bloom < plain / 10
    present = spark.read.parquet(paths["bloom"]).filter(F.col("business_id") == "id1234")
    assert present.count() == 1
    assert write_table(df, scratch_path(spark, "test-bloom-sink"), bloom_filter_columns=("business_id",)) == 200_000


def test_row_count_spares_the_id_column(spark, bronze):
    reviews = spark.read.parquet(f"{bronze}/silver/review")
    business = spark.read.parquet(f"{bronze}/silver/business")
    by_rows = gold.weekly_stars(reviews, business, count_column=None)
    scan = [ln for ln in plan(by_rows).splitlines() if "FileScan parquet" in ln and "review_date" in ln][0]
    assert "review_id" not in scan and "review_text" not in scan
    # Silver review ids are never NULL, so both counts agree row for row.
    by_ids = gold.weekly_stars(reviews, business)
    assert by_rows.exceptAll(by_ids).count() == 0 and by_ids.exceptAll(by_rows).count() == 0


def test_checkin_row_count_reads_business_id_only(spark, bronze):
    checkins = spark.read.parquet(f"{bronze}/silver/checkin")
    business = spark.read.parquet(f"{bronze}/silver/business")
    by_rows = gold.checkins_vs_stars(checkins, business, count_column=None)
    scans = [ln for ln in plan(by_rows).splitlines() if "FileScan parquet" in ln]
    # The check-in scan reads one column; the business scan reads its six.
    assert any(re.search(r"FileScan parquet \[business_id#\d+\] ", ln) for ln in scans)
    assert not any("checkin_timestamp" in ln for ln in scans)
    by_ts = gold.checkins_vs_stars(checkins, business)
    assert by_rows.exceptAll(by_ts).count() == 0 and by_ts.exceptAll(by_rows).count() == 0
