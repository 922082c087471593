"""Raw-shaped inputs derived from the driver's TPC-H-like tables.

The layers read five JSON dumps, which are not shipped here. These adapters
rebuild their shape from the given tables, with deliberate dirt (NULLs,
padded ids, duplicates with differing payload, out-of-range stars, dates
that do not parse, bad list items, non-numeric counts), so that every
cleaning branch is exercised. Each adapter reads its whole source table:
nothing is filtered away, dirt is injected by CASE expressions.

The same rows are produced by the DuckDB text in :mod:`strata.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_TS = "yyyy-MM-dd HH:mm:ss"
TEXT_DAY = "yyyy-MM-dd"
DAY_ZERO = "2010-01-01"
# Most check-in times in one raw list (consecutive event ids per chunk).
CHECKIN_CHUNK = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _day_text(n: Column) -> Column:
    return F.date_format(F.date_add(F.lit(DAY_ZERO).cast("date"), n.cast("int")), TEXT_TS)


def raw_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From ``part``: every part twice, the second copy a near duplicate."""
    original, copy = raw_business_arrivals(spark, sf_dir)
    return original.unionByName(copy)


def raw_business_arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two halves of :func:`raw_business`: original records, then their near copies."""
    part = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")

    def shape(business_id: Column, name: Column, stars: Column) -> DataFrame:
        return part.select(
            business_id.alias("business_id"),
            name.alias("name"),
            F.concat(_s(F.col("p_size")), F.lit(" Main St")).alias("address"),
            F.col("p_brand").alias("city"),
            F.col("p_type").alias("state"),
            F.lpad(_s(F.col("p_size")), 5, "0").alias("postal_code"),
            (F.col("p_retailprice") / 100).alias("latitude"),
            (-F.col("p_retailprice") / 10).alias("longitude"),
            stars.alias("stars"),
            (k % 7).alias("review_count"),
            (k % 2).alias("is_open"),
            F.concat(F.col("p_brand"), F.lit(", "), F.col("p_type")).alias("categories"),
        )

    original = shape(
        F.concat(F.lit(" b"), _s(k), F.lit(" ")),
        F.when(k % 19 == 0, F.lit(None)).otherwise(F.concat(F.col("p_name"), F.lit(" "))),
        F.when(k % 17 == 0, F.lit(None)).otherwise((k % 13).cast("double") / 2),
    )
    copy = shape(
        F.concat(F.lit("b"), _s(k)),
        F.when(k % 10 == 0, F.lit("zz dup"))
        .when(k % 19 == 0, F.lit(None))
        .otherwise(F.concat(F.col("p_name"), F.lit(" "))),
        (k % 11).cast("double") / 2,
    )
    return original, copy


def raw_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From ``lineitem``: one review per line; (orderkey, linenumber) repeats with other payloads."""
    li = _table(spark, sf_dir, "lineitem")
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return li.select(
        F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber"))).alias("review_id"),
        F.concat(F.lit("u"), _s(supp)).alias("user_id"),
        F.when(part % 11 == 0, F.concat(F.lit("x"), _s(part)))
        .when(supp % 3 == 0, F.concat(F.lit("b"), _s(part), F.lit(" ")))
        .otherwise(F.concat(F.lit("b"), _s(part)))
        .alias("business_id"),
        F.col("l_linenumber").cast("double").alias("stars"),
        F.col("l_quantity").cast("bigint").alias("useful"),
        (F.col("l_quantity").cast("bigint") % 3).alias("funny"),
        F.when(part % 5 == 0, F.lit(None)).otherwise(F.col("l_linenumber").cast("bigint")).alias("cool"),
        F.when(supp % 23 == 0, F.lit("bad"))
        .when(supp % 29 == 0, F.date_format("l_shipdate", TEXT_DAY))
        .otherwise(F.date_format("l_shipdate", TEXT_TS))
        .alias("date"),
        F.col("l_returnflag").alias("text"),
    )


def raw_checkin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From ``events``: one row per (user, day, event-id chunk) listing those event times.

    ``event_id`` is unique, so a chunk of :data:`CHECKIN_CHUNK` consecutive ids
    holds at most that many event times, however many events one user has in
    one day. Some lists get a bad item, some are repeated in full (duplicate
    check-ins), so a list has at most ``2 * CHECKIN_CHUNK + 1`` items.
    """
    ev = _table(spark, sf_dir, "events")
    u = F.col("user_id")
    chunk = F.call_function("div", F.col("event_id"), F.lit(CHECKIN_CHUNK)).alias("chunk")
    days = ev.groupBy(u, F.to_date("ts").alias("day"), chunk).agg(
        F.concat_ws(", ", F.transform(F.sort_array(F.collect_list("ts")), lambda t: F.date_format(t, TEXT_TS))).alias(
            "items"
        )
    )
    items = F.col("items")
    return days.select(
        F.concat(F.lit("b"), _s(u)).alias("business_id"),
        F.concat(
            items,
            F.when(u % 7 == 0, F.lit(", bad")).otherwise(F.lit("")),
            F.when(u % 5 == 0, F.concat(F.lit(", "), items)).otherwise(F.lit("")),
        ).alias("date"),
    )


def raw_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From ``customer``: every customer twice, the copy a near duplicate."""
    cu = _table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def shape(user_id: Column, name: Column, fans: Column) -> DataFrame:
        return cu.select(
            user_id.alias("user_id"),
            name.alias("name"),
            k.alias("review_count"),
            _day_text(k).alias("yelping_since"),
            (k % 4).alias("useful"),
            (k % 3).alias("funny"),
            (k % 2).alias("cool"),
            fans.alias("fans"),
            (F.col("c_acctbal") / 2000).alias("average_stars"),
        )

    nation = F.col("c_nationkey").cast("bigint")
    original = shape(
        F.when(k % 29 == 0, F.lit(None)).otherwise(F.concat(F.lit(" u"), _s(k))),
        F.col("c_name"),
        nation,
    )
    copy = shape(
        F.concat(F.lit("u"), _s(k)),
        F.when(k % 10 == 0, F.lit("zz dup")).otherwise(F.col("c_name")),
        nation + 1,
    )
    return original.unionByName(copy)


def raw_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From ``conversations``: counts arrive as text, some of it not numeric."""
    cv = _table(spark, sf_dir, "conversations")
    t = F.col("turn")
    return cv.select(
        F.concat(F.lit("u"), _s(F.col("conv_id"))).alias("user_id"),
        F.when(t % 5 == 4, F.lit(None)).otherwise(F.concat(F.lit("b"), _s(t))).alias("business_id"),
        F.when(t % 3 == 2, F.lit(None)).otherwise(F.col("text")).alias("text"),
        _day_text(F.col("conv_id")).alias("date"),
        F.when(t % 4 == 0, _s(t))
        .when(t % 4 == 2, F.concat(_s(t), F.lit(".7")))
        .otherwise(F.lit("n/a"))
        .alias("compliment_count"),
    )


ADAPTERS = {
    "business": raw_business,
    "review": raw_review,
    "checkin": raw_checkin,
    "user": raw_user,
    "tip": raw_tip,
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ADAPTERS[name](spark, sf_dir)
