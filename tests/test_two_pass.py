"""The two-pass dedup keeps what one pass keeps, and moves only rows that may have a copy."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import two_pass
from strata.operators.rules import Dedup, clean, deduplicate
from strata.operators.silver import SPECS
from strata.operators.two_pass import bitmap_bits, clean_two_pass, deduplicate_two_pass, repeated_hashes
from strata.plans.session import scratch_path
from strata.sources.fixtures import raw

RULE = Dedup(("id", "kind"))


def scratch(spark):
    return scratch_path(spark, "test-two-pass")


def table(spark, n, ids, parts, seed):
    rnd = random.Random(seed)
    some = lambda *v: rnd.choice(v)
    rows = [(some(None, *range(ids)), some("a", "b", None), some(None, "x", "y", ""), some(1.5, -0.0, None)) for _ in range(n)]
    return spark.createDataFrame(rows, "id long, kind string, text string, value double").repartition(parts)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("ids", [3, 60, 5000])
@pytest.mark.parametrize("parts", [1, 7])
def test_same_survivors_as_one_pass(spark, ids, parts):
    df = table(spark, 400, ids, parts, ids + parts)
    got = deduplicate_two_pass(df, RULE, scratch(spark))
    assert got.columns == df.columns
    assert rows(got) == rows(deduplicate(df, RULE))


def test_keys_that_share_hashes_or_bits(spark, monkeypatch):
    df = table(spark, 500, 90, 3, 1)
    monkeypatch.setattr(two_pass, "key_hash", lambda keys: F.pmod(F.xxhash64(*keys), F.lit(40)))
    assert rows(deduplicate_two_pass(df, RULE, scratch(spark))) == rows(deduplicate(df, RULE))
    monkeypatch.setattr(two_pass, "key_hash", lambda keys: F.pmod(F.xxhash64(*keys), F.lit(1 << 20)) * F.lit(1 << 15))
    assert rows(deduplicate_two_pass(df, RULE, scratch(spark))) == rows(deduplicate(df, RULE))


def test_many_rows_of_the_bitmap(spark):
    i = F.col("id")
    df = spark.range(120_000).select((i % 90_000).alias("id"), F.lit("k").alias("kind"), (-i).alias("text"))
    got = deduplicate_two_pass(df, RULE, scratch(spark))  # 30,000 repeated hashes: 16 rows of 4 KiB
    assert bitmap_bits(30_000) == 16 * two_pass.ROW_BITS
    assert got.agg(F.count("*"), F.sum("text")).first() == deduplicate(df, RULE).agg(F.count("*"), F.sum("text")).first()


def test_bits():
    assert bitmap_bits(1) == bitmap_bits(2048) == two_pass.ROW_BITS and bitmap_bits(2049) == 2 * two_pass.ROW_BITS
    assert bitmap_bits(1 << 27) == bitmap_bits(1 << 31) == two_pass.MOST_BITS and bitmap_bits((1 << 31) + 1) is None


def test_other_rules_take_one_pass(spark):
    df = table(spark, 200, 20, 2, 5)
    for rule in (Dedup(("id", "kind"), "any"), Dedup(("value",))):
        plan = deduplicate_two_pass(df, rule, scratch(spark))._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" not in plan
    many = deduplicate_two_pass(df, RULE, scratch(spark), most_bits=8)
    assert "Union" not in many._jdf.queryExecution().optimizedPlan().toString() and rows(many) == rows(deduplicate(df, RULE))


def exchanges(df, metric):
    """The metric of each shuffle exchange of an executed query."""
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply(metric).value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


@pytest.fixture(scope="module")
def wide(spark):
    """100,000 reviews of some 500 bytes, one in a hundred a copy of another with a later text."""
    path = scratch_path(spark, "test-two-pass-wide")
    i = F.col("id")
    text = F.concat_ws(" ", *[F.sha2(F.concat(i.cast("string"), F.lit(f"/{k}")), 256) for k in range(8)])
    one = F.when(i % 100 == 99, i - 50).otherwise(i)
    spark.range(100_000, numPartitions=8).select(one.alias("id"), F.lit("k").alias("kind"), text.alias("text")).write.parquet(path)
    return spark.read.parquet(path)


def test_single_rows_never_move(spark, wide):
    digest = lambda df: df.select(F.xxhash64(*df.columns).alias("h"))
    once, first = digest(deduplicate(wide, RULE)), repeated_hashes(wide, RULE.keys)
    twice = digest(deduplicate_two_pass(wide, RULE, scratch(spark)))
    assert sorted(once.collect()) == sorted(twice.collect()) and len(first.collect()) == 1000
    records = exchanges(twice, "shuffleRecordsWritten")
    # 2,000 rows have a copy; of the others one in sixteen may share a bit. The bitmap's own rows are counted too.
    assert max(records) <= 2000 + 98_000 // 16
    moved = sum(exchanges(first, "shuffleBytesWritten")) + sum(exchanges(twice, "shuffleBytesWritten"))
    assert 10 * moved < sum(exchanges(once, "shuffleBytesWritten"))


def test_no_copies_no_second_pass(spark, wide):
    got = deduplicate_two_pass(wide.where("id % 100 > 49"), RULE, scratch(spark))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == wide.where("id % 100 > 49").count()


def test_silver_tables(spark, tmp_path):
    from conftest import SMALL

    for name in ("business", "review", "checkin", "user", "tip"):
        df = raw(spark, SMALL, name)
        assert rows(clean_two_pass(df, SPECS[name], scratch(spark))) == rows(clean(df, SPECS[name])), name


def test_layers_take_two_passes_from_a_size_on(spark):
    from conftest import SMALL

    from strata.plans.layers import RunSpec, run_bronze, run_silver
    from strata.registry import write_raw_files

    layout = write_raw_files(spark, SMALL, f"{scratch(spark)}/raw")
    run_bronze(spark, layout)
    counts = run_silver(spark, layout, RunSpec(two_pass_bytes=None))
    tables = {n: rows(spark.read.parquet(layout.silver(n))) for n in counts}
    assert run_silver(spark, layout, RunSpec(two_pass_bytes=0)) == counts
    assert {n: rows(spark.read.parquet(layout.silver(n))) for n in counts} == tables
