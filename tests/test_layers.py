"""The full bronze -> silver -> gold run over JSON dumps built from the driver tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from strata.plans.layers import Layout, RunSpec, layer_counts, run_bronze, run_layers, run_silver
from strata.plans.session import scratch_path
from strata.registry import write_raw_files


@pytest.fixture(scope="module")
def layout(spark):
    root = scratch_path(spark, "test-layers")
    lay = write_raw_files(spark, SMALL, f"{root}/raw")
    counts = run_layers(spark, lay, RunSpec(declared_schemas=True))
    return lay, counts


def test_counts_reported(spark, layout):
    lay, counts = layout
    assert set(counts) == {"bronze", "silver", "gold"}
    table = {(r.layer, r.dataset): r.row_count for r in layer_counts(spark, lay).collect()}
    for layer, per in counts.items():
        for name, n in per.items():
            assert table[(layer, name)] == n


def test_silver_keys_unique(spark, layout):
    lay, _ = layout
    for name, keys in {"business": ["business_id"], "review": ["review_id"], "user": ["user_id"],
                       "checkin": ["business_id", "checkin_timestamp"]}.items():
        df = spark.read.parquet(lay.silver(name))
        assert df.count() == df.select(*keys).distinct().count(), name


def test_weekly_counts_cover_in_scope_reviews(spark, layout):
    lay, _ = layout
    reviews = spark.read.parquet(lay.silver("review"))
    business = spark.read.parquet(lay.silver("business"))
    in_scope = reviews.join(business.select("business_id"), "business_id", "left_semi").count()
    weekly = spark.read.parquet(lay.gold("weekly_stars"))
    assert weekly.agg(F.sum("review_count_weekly")).first()[0] == in_scope
    cvs = spark.read.parquet(lay.gold("checkins_vs_stars"))
    assert cvs.count() == business.count()


def test_partitioned_layout_prunes(spark, layout):
    lay, _ = layout
    weekly = spark.read.parquet(lay.gold("weekly_stars"))
    assert weekly.columns[-1] == "review_year"
    plan = weekly.filter(F.col("review_year") == 1998)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(review_year" in plan


def test_week_layout_prunes_on_week(spark, layout):
    lay, _ = layout
    other = Layout(root=scratch_path(spark, "test-week"), raw=lay.raw)
    run_layers(spark, other, RunSpec(declared_schemas=True, weekly_partition_by=("review_week",)))
    weekly = spark.read.parquet(other.gold("weekly_stars"))
    assert weekly.columns[-1] == "review_week"
    q = weekly.filter(F.col("review_week") == F.lit("1998-01-05 00:00:00").cast("timestamp"))
    assert "PartitionFilters: [isnotnull(review_week" in q._jdf.queryExecution().executedPlan().toString()
    year = spark.read.parquet(lay.gold("weekly_stars"))
    assert weekly.count() == year.count()
    assert weekly.exceptAll(year.select(*weekly.columns)).count() == 0


def test_declared_schema_matches_inferred(spark, layout):
    lay, _ = layout
    inferred = Layout(root=scratch_path(spark, "test-infer"), raw=lay.raw)
    counts = run_layers(spark, inferred, RunSpec(datasets=("business", "review"), concurrent=False))
    for name in ("business", "review"):
        a = spark.read.parquet(lay.silver(name))
        b = spark.read.parquet(inferred.silver(name))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        assert counts["silver"][name] == a.count()


def test_resume_from_silver_gives_the_same_gold(spark, layout):
    lay, counts = layout
    resumed = Layout(root=scratch_path(spark, "test-resume"), raw=lay.raw, bronze_root=f"{lay.root}/bronze")
    again = run_layers(spark, resumed, RunSpec(declared_schemas=True), layers=("silver", "gold"))
    assert set(again) == {"silver", "gold"}
    assert again["silver"] == counts["silver"] and again["gold"] == counts["gold"]
    for g in ("weekly_stars", "checkins_vs_stars"):
        a, b = spark.read.parquet(lay.gold(g)), spark.read.parquet(resumed.gold(g))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_raw_split_size_applies_to_bronze_only(spark, layout):
    import os

    lay, _ = layout
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)

    def files(root):
        d = Layout(root=root, raw=lay.raw).bronze("review").removeprefix("file:")
        return len([f for f in os.listdir(d) if f.endswith(".parquet")])

    small = scratch_path(spark, "test-split-small")
    run_bronze(spark, Layout(root=small, raw=lay.raw), RunSpec(datasets=("review",), raw_split_bytes=64 * 1024))
    assert spark.conf.get(key) == before  # restored
    default = scratch_path(spark, "test-split-default")
    run_bronze(spark, Layout(root=default, raw=lay.raw), RunSpec(datasets=("review",)))
    assert spark.conf.get(key) == before
    assert files(small) > files(default)


def test_silver_split_size_stays_in_its_layer(spark, layout):
    from strata.plans.layers import _sized
    from strata.plans.session import SPLIT_BYTES

    lay, counts = layout
    before = spark.conf.get(SPLIT_BYTES)
    assert _sized(spark, RunSpec(), "silver", [], 16384).conf.get(SPLIT_BYTES) == "16384"
    assert _sized(spark, RunSpec(), "gold", []) is spark
    for split in (16384, None):
        again = Layout(root=scratch_path(spark, "test-silver-split"), raw=lay.raw, bronze_root=f"{lay.root}/bronze")
        got = run_silver(spark, again, RunSpec(datasets=("review",), silver_split_bytes=split))
        assert got == {"review": counts["silver"]["review"]}
    assert spark.conf.get(SPLIT_BYTES) == before


def test_written_gold_equals_oracle(spark, layout):
    """The tables the layered run writes (partitioned, row-counted, bloom-filtered) equal the oracle."""
    import datetime as dt
    import math

    import duckdb

    from conftest import TABLES
    from strata import oracle

    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")

    def canon(cols, rows):
        def norm(v):
            if isinstance(v, float):
                return "nan" if math.isnan(v) else repr(round(v, 9))
            if isinstance(v, (dt.date, dt.datetime)):
                return v.isoformat()
            return repr(v)

        order = sorted(cols)
        idx = [cols.index(c) for c in order]
        return order, sorted(tuple(norm(r[i]) for i in idx) for r in rows)

    lay, _ = layout
    weekly = spark.read.parquet(lay.gold("weekly_stars")).withColumn("review_week", F.to_date("review_week"))
    want = duck.sql(oracle.with_ctes(f"select {oracle.WEEKLY_OUT} from weekly_stars", ("weekly_stars",)))
    assert canon(weekly.columns, weekly.collect()) == canon(want.columns, want.fetchall())
    cvs = spark.read.parquet(lay.gold("checkins_vs_stars"))
    want = duck.sql(oracle.with_ctes("select * from checkins_vs_stars", ("checkins_vs_stars",)))
    assert canon(cvs.columns, cvs.collect()) == canon(want.columns, want.fetchall())
    # Silver as written, after the raw JSON round trip and bronze.
    for name in ("business", "review", "checkin", "user", "tip"):
        got = spark.read.parquet(lay.silver(name))
        want = duck.sql(oracle.with_ctes(f"select * from silver_{name}", (f"silver_{name}",)))
        assert canon(got.columns, got.collect()) == canon(want.columns, want.fetchall()), name


def test_jobs_are_labelled_per_table(spark):
    from concurrent.futures import ThreadPoolExecutor

    from strata.plans.layers import _labelled

    sc = spark.sparkContext
    seen = _labelled(spark, "silver", lambda item: sc.getLocalProperty("spark.job.description"))("review")
    assert seen == "strata silver review"
    assert sc.getLocalProperty("spark.job.description") is None
    # A caller's description and job group carry into worker threads and survive the run.
    sc.setJobGroup("nightly", "nightly reviews")
    try:
        probe = _labelled(spark, "gold", lambda item: (sc.getLocalProperty("spark.jobGroup.id"),
                                                        sc.getLocalProperty("spark.job.description")))
        with ThreadPoolExecutor(1) as pool:
            assert pool.submit(probe, "weekly_stars").result() == ("nightly", "nightly reviews: strata gold weekly_stars")
        assert probe("weekly_stars")[1] == "nightly reviews: strata gold weekly_stars"
        assert sc.getLocalProperty("spark.job.description") == "nightly reviews"
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
        sc.setLocalProperty("spark.job.interruptOnCancel", None)
