"""Batches merged into silver and gold give what a full rebuild gives, and touch what they must."""

import datetime as dt
import os
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_two_pass import exchanges

from strata.operators import gold, state
from strata.operators.rules import Dedup, clean, deduplicate
from strata.operators.silver import SPECS
from strata.operators.two_pass import merge
from strata.plans import incremental
from strata.plans.incremental import Ledger, apply_reviews, refresh_weekly, touched, weekly_ledger
from strata.plans.layers import Layout, RunSpec
from strata.plans.session import scratch_path
from strata.sources.sinks import replace_partitions, write_partitioned, write_table
from strata.sources.versions import read_table

REVIEW = ("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "date", "text")
BUSINESS = (
    "business_id string, business_name string, address string, city string, state string, postal_code string, latitude double, "
    "longitude double, stars double, review_count int, is_open int, categories string"
)


def scratch(spark):
    return scratch_path(spark, "test-incremental")


def rows(df):
    return sorted(map(repr, df.collect()))


def raw_reviews(spark, data):
    """Raw rows (all text, as declared) from ``(id, business, stars, date, useful)``."""
    full = [(i, "u", b, s, u, None, "1", d, f"text {i}") for i, b, s, d, u in data]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in REVIEW)).repartition(3)


def started(spark, data, businesses="abcd", by="review_year"):
    layout = Layout(root=scratch(spark), raw="")
    spec = RunSpec(weekly_partition_by=(by,))
    business = spark.createDataFrame([(b, b.upper(), None, "c", "s", None, None, None, 4.0, 1, 1, None) for b in businesses], BUSINESS)
    write_table(business, layout.silver("business"))
    write_table(clean(raw_reviews(spark, data), SPECS["review"]), layout.silver("review"))
    w = gold.weekly_stars(read_table(spark, layout.silver("review")), business)
    write_partitioned(w, layout.gold("weekly_stars"), spec.weekly_partition_by)
    return layout, spec


def rebuilt(spark, layout, data):
    return rows(gold.weekly_stars(clean(raw_reviews(spark, data), SPECS["review"]), spark.read.parquet(layout.silver("business"))))


def stored(spark, layout):
    return rows(read_table(spark, layout.gold("weekly_stars")).select(*gold.WEEKLY_STARS_COLUMNS))


def files(path):
    return {
        (d.name, f.name): f.stat().st_mtime_ns
        for d in os.scandir(path.removeprefix("file:"))
        if d.is_dir()
        for f in os.scandir(d.path)
        if f.name.endswith(".parquet")
    }


FIRST = [
    ("r1", "a", "4.5", "2018-03-01 10:00:00", "1"), ("r2", "a", "3.1", "2018-03-02 10:00:00", "2"), ("r3", "b", "1.7", "2019-12-31 10:00:00", None),
    ("r4", "b", "2", "2020-01-01 10:00:00", "x"), ("r5", "zz", "2", "2020-01-01 10:00:00", "3"), ("r6", "a", "5", "2021-06-01 10:00:00", "0"),
]
SECOND = [
    ("r7", "c", "3.3", "2019-05-01 10:00:00", "4"),  # the first review of a business
    ("r2", "a", "2.1", "2018-03-02 10:00:00", "2"),  # replaces a review: it comes first by its stars
    ("r6", "a", "5", "2021-06-01 10:00:00", "0"),  # the same again
    ("r1", "a", "4.9", "2018-03-01 10:00:00", "1"),  # does not replace one
    ("r8", "b", "1", "no date", "1"),
]
THIRD = [("r9", "d", "4", "2020-01-02 10:00:00", "1"), ("r3", "b", "1.6", "2022-02-02 10:00:00", "9"), ("r8", "b", "0.5", "2020-01-03 10:00:00", "1")]


@pytest.mark.parametrize("by", ["review_year", "review_week"])
def test_batches_equal_a_rebuild(spark, by):
    layout, spec = started(spark, FIRST, by=by)
    path = layout.gold("weekly_stars")
    before = files(path)
    apply_reviews(spark, layout, "one", raw_reviews(spark, SECOND), spec)
    assert stored(spark, layout) == rebuilt(spark, layout, FIRST + SECOND)
    after = files(path)
    # 2018 (a replaced review), 2019 (a first one) and the sentinel partition are new; the others keep their files.
    kept = {k: t for k, t in before.items() if not k[0].startswith((f"{by}=2018", f"{by}=9999")) and (by == "review_week" or k[0] != f"{by}=2019")}
    assert kept and kept.items() <= after.items()
    assert not set(k for k in before if k[0].startswith((f"{by}=2018", f"{by}=9999"))) & set(after)
    apply_reviews(spark, layout, "two", raw_reviews(spark, THIRD), spec)
    want = rebuilt(spark, layout, FIRST + SECOND + THIRD)
    assert stored(spark, layout) == want
    # Every business has a dated review now and none is undated: the sentinel partition is gone.
    assert not [d for d in os.listdir(path.removeprefix("file:")) if "9999" in d]
    assert rows(read_table(spark, layout.silver("review"))) == rows(clean(raw_reviews(spark, FIRST + SECOND + THIRD), SPECS["review"]))
    incremental.rebuild_weekly(spark, layout, spec)
    assert stored(spark, layout) == want


@pytest.mark.parametrize("step", ["publish", "refresh_weekly"])
def test_a_batch_that_failed_half_way_is_repeated(spark, monkeypatch, step):
    layout, spec = started(spark, FIRST)

    def lost(*a, **k):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(incremental, step, lost)
    with pytest.raises(RuntimeError, match="lost driver"):
        apply_reviews(spark, layout, "one", raw_reviews(spark, SECOND), spec)
    monkeypatch.undo()
    for _ in range(2):  # and once more for nothing
        apply_reviews(spark, layout, "one", raw_reviews(spark, SECOND), spec)
        assert stored(spark, layout) == rebuilt(spark, layout, FIRST + SECOND)


def test_empty_batch(spark):
    layout, spec = started(spark, FIRST)
    before = stored(spark, layout)
    apply_reviews(spark, layout, "none", raw_reviews(spark, FIRST).limit(0), spec)
    assert stored(spark, layout) == before


def test_merge_equals_dedup_of_both(spark):
    rnd = random.Random(2)
    row = lambda: (rnd.choice([None, *"abcdefgh"]), rnd.choice(["x", "y", None]), rnd.choice([1, 2, None]))
    schema, rule = "k string, v string, n int", Dedup(("k",))
    for size in (0, 1, 30):
        table = deduplicate(spark.createDataFrame([row() for _ in range(15)], schema), rule)
        path = scratch(spark)
        table.write.parquet(path)
        table, batch = spark.read.parquet(path), spark.createDataFrame([row() for _ in range(size)], schema)
        for most in (1 << 30, 8):
            m = merge(table, batch, rule, scratch(spark), most)
            want = rows(deduplicate(table.unionByName(batch), rule))
            assert rows(m.result) == want
            old = rows(table)
            assert rows(m.added) == sorted(set(want) - set(old)) and rows(m.removed) == sorted(set(old) - set(want))


def test_merge_moves_no_other_rows(spark):
    path = scratch(spark)
    spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 50).alias("v")).write.parquet(path)
    m = merge(spark.read.parquet(path), spark.createDataFrame([("7", "a"), ("new", "b")], "k string, v string"), Dedup(("k",)), scratch(spark))
    assert len(m.untouched.collect()) > 49_900 and sum(exchanges(m.untouched, "shuffleRecordsWritten")) < 10  # the bitmap's
    assert m.result.count() == 50_001
    assert [r.v for r in m.result.where("k = '7'").collect()] == ["a"]


def test_sums_do_not_depend_on_partitions_or_batches(spark):
    """Stars in steps of 0.1, whose double sums differ with the order of addition."""
    i = F.col("id")
    reviews = spark.range(20_000).select(
        F.concat(F.lit("b"), (i % 40).cast("string")).alias("business_id"), (F.pmod(F.xxhash64(i), F.lit(51)) / 10).alias("stars"),
        (i % 7).cast("int").alias("useful"), F.lit(None).cast("int").alias("funny"), F.when(i % 5 > 0, -(i % 3)).cast("int").alias("cool"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (i % 30).cast("int")).alias("review_date"), i.alias("review_id"),
    )
    results = [rows(gold.weekly_agg(reviews.repartition(n))) for n in (1, 7, 200)]
    assert results[0] == results[1] == results[2]
    parts = [gold.weekly_sums(reviews.where(f"review_id % 3 = {k}")) for k in range(3)]
    sums = state.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), state.WEEKLY_KEYS)
    assert rows(gold.weekly_averages(sums)) == results[0]
    text = reviews.selectExpr("business_id b", "year(review_date) y", "weekofyear(review_date) w", "cast(stars as string) s").collect()
    exact = defaultdict(list)
    for r in text:
        exact[r.b, r.y, r.w].append(Decimal(r.s))
    for r in gold.weekly_agg(reviews).collect():
        total, n = sum(exact[r.business_id, r.review_year, r.review_week_number]), r.review_count_weekly
        assert r.avg_stars_weekly == float((200 * total + n) // (2 * n)) / 100


def test_ledger(spark):
    ledger = Ledger(spark, scratch(spark), ("k",))
    part = lambda *r: spark.createDataFrame(list(r), "k string, n long, m long").withColumn("m", F.col("m").cast("decimal(38,17)"))
    with pytest.raises(ValueError, match="no batch"):
        ledger.read()
    assert ledger.commit("2024/01 *", part(("a", 1, 1), (None, 2, 2))) and not ledger.commit("2024/01 *", part(("a", 100, 1)))
    assert ledger.commit("b", part(("a", -1, -1), ("c", 5, 0)))
    want = rows(part(("a", 0, 0), (None, 2, 2), ("c", 5, 0)))
    assert rows(ledger.read()) == want
    assert ledger.compact() == 2
    want = [r for r in want if "k='a'" not in r]
    assert rows(ledger.read()) == want and not ledger.commit("b", part(("a", 9, 9)))
    assert ledger.commit("d", part((None, 1, 1))) and ledger.compact() == 1
    assert ledger.batch("b") is None and ledger.batch("d") is not None
    assert not ledger.commit("b", part(("a", 9, 9))) and not ledger.commit("2024/01 *", part(("a", 9, 9)))
    assert {r.k: r.n for r in ledger.read().collect()} == {None: 3, "c": 5}


def test_a_lost_commit_leaves_no_batch(spark):
    ledger = Ledger(spark, scratch(spark), ("k",))
    ledger.commit("one", spark.createDataFrame([("a", 1)], "k string, n long"))
    broken = spark.range(5).select(F.lit("a").alias("k"), F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.lit(1)).cast("long").alias("n"))
    with pytest.raises(Exception, match="lost"):
        ledger.commit("two", broken)
    assert not ledger.has("two") and ledger.read().first().n == 1


def test_replaced_partitions(spark):
    path = scratch(spark)
    frame = lambda data: spark.createDataFrame(data, "p string, v int")
    write_partitioned(frame([("x", 1), ("y", 2), ("a/b c", 3), ("z", 4)]), path, ("p",))
    before = files(path)
    # Rows of other partitions are not written; a named one without rows goes.
    assert replace_partitions(frame([("x", 7), ("x", 8), ("y", 9)]), path, "p", ["x", "a/b c"]) == 2
    assert sorted((r.p, r.v) for r in spark.read.parquet(path).collect()) == [("x", 7), ("x", 8), ("y", 2), ("z", 4)]
    same = {k: t for k, t in before.items() if k[0] in ("p=y", "p=z")}
    assert len(same) == 2 and same.items() <= files(path).items()
    assert replace_partitions(frame([("x", 7)]), path, "p", []) == 0
    assert replace_partitions(frame([]), path, "p", ["x", "none"]) == 0
    assert sorted(r.p for r in spark.read.parquet(path).collect()) == ["y", "z"]
    with pytest.raises(Exception, match="lost"):
        replace_partitions(frame([("y", 1)]).withColumn("v", F.raise_error(F.lit("lost")).cast("int")), path, "p", ["y"])
    assert sorted(r.p for r in spark.read.parquet(path).collect()) == ["y", "z"]


def test_partitions_pruned_in_the_refresh(spark):
    layout, spec = started(spark, FIRST)
    apply_reviews(spark, layout, "one", raw_reviews(spark, SECOND), spec)
    ledger = weekly_ledger(spark, layout)
    assert touched(ledger.batch("one"), "review_year") == ["2018", "2019", "9999"]
    assert touched(ledger.batch("one"), "review_week") == ["2018-02-26 00:00:00", "2019-04-29 00:00:00", "9999-01-01 00:00:00"]
    assert refresh_weekly(spark, layout, ledger.read(), ["2019"], spec) == 4  # b and c in 2019, d silent, b undated


def test_a_batch_is_computed_once(spark):
    """Its rows are read once, however often the merge's parts are used; a repeated batch writes no silver table."""
    layout, spec = started(spark, FIRST)
    read = spark.sparkContext.accumulator(0)

    def counted(it):
        for x in it:
            read.add(x.num_rows)
            yield x

    batch = raw_reviews(spark, SECOND)
    batch = batch.mapInArrow(counted, batch.schema)
    apply_reviews(spark, layout, "one", batch, spec)
    assert read.value == len(SECOND)
    before = read_table(spark, layout.silver("review")).inputFiles()
    apply_reviews(spark, layout, "one", batch, spec)
    assert read_table(spark, layout.silver("review")).inputFiles() == before
    assert stored(spark, layout) == rebuilt(spark, layout, FIRST + SECOND)


def test_sums_need_not_be_added_up_before_the_refresh(spark):
    layout, spec = started(spark, FIRST)
    apply_reviews(spark, layout, "one", raw_reviews(spark, SECOND), spec)
    ledger, business = weekly_ledger(spark, layout), spark.read.parquet(layout.silver("business"))
    assert ledger.parts().count() > ledger.read().count()
    assert rows(state.without_reviews(ledger.parts(), business)) == rows(state.without_reviews(ledger.read(), business))


def test_a_declared_line_is_parsed_once(spark):
    from strata.sources.raw import RAW_SCHEMAS, read_declared

    path = scratch(spark)
    spark.createDataFrame([('{"review_id": "r", "stars": 4}',)], "value string").write.text(path)
    plan = read_declared(spark, path, RAW_SCHEMAS["review"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2  # the record, and the map of other keys
