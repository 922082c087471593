"""Property tests: random dirty raw rows, Spark chain == DuckDB oracle text."""

import datetime as dt
import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from strata import oracle
from strata.operators import gold, silver

ids = st.sampled_from(["a", " a", "a ", "b", "  ", "c1", None])
stars = st.sampled_from([None, 0.0, 1.0, 2.5, 4.0, 5.0, 5.5, -1.0, float("nan")])
counts = st.one_of(st.none(), st.integers(min_value=-3, max_value=5), st.just(3_000_000_000))
dates = st.sampled_from(
    [
        None, "bad", "", "2018-12-31 10:00:00", "2019-01-01 00:00:00", "2021-01-01 23:59:59",
        "2019-01-01", "2019-1-1 1:2:3", " 2019-01-02 00:00:00", "2019-01-02 00:00:00.5",
        "2020-02-29 12:00:00", "2019-02-29 12:00:00", "2018-07-07 22:09:11",
    ]
)
texts = st.sampled_from([None, "", "x", "y z"])

review_rows = st.lists(
    st.tuples(ids, ids, ids, stars, counts, counts, counts, dates, texts), min_size=0, max_size=25
)
business_rows = st.lists(st.tuples(ids, st.sampled_from([None, "n", " n ", "m"]), stars, counts), max_size=8)

RAW_REVIEW = (
    "review_id string, user_id string, business_id string, stars double, useful bigint, funny bigint, "
    "cool bigint, date string, text string"
)
RAW_BUSINESS = (
    "business_id string, name string, address string, city string, state string, postal_code string, "
    "latitude double, longitude double, stars double, review_count bigint, is_open bigint, categories string"
)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def _canon(cols, rows):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


def _duck_frame(rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    df = pd.DataFrame(rows, columns=names)
    for c, spec in zip(names, schema.split(", ")):
        if spec.endswith("bigint"):
            df[c] = df[c].astype("Int64")
        elif spec.endswith("double"):
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].astype("object")
    return df


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(reviews=review_rows, businesses=business_rows)
def test_weekly_stars_matches_oracle(spark, reviews, businesses):
    import duckdb

    b_rows = [(bid, name, "a", "c", "s", "p", 1.0, 2.0, s, n, 1, "k") for bid, name, s, n in businesses]
    raw_b = spark.createDataFrame(b_rows, RAW_BUSINESS)
    raw_r = spark.createDataFrame(reviews, RAW_REVIEW)
    sb, sr = silver.clean_business(raw_b), silver.clean_review(raw_r)
    got = {
        "silver_review": sr,
        "silver_business": sb,
        "weekly_stars": gold.weekly_stars(sr, sb).withColumn("review_week", F.to_date("review_week")),
    }

    con = duckdb.connect()
    con.register("raw_business", _duck_frame(b_rows, RAW_BUSINESS))
    con.register("raw_review", _duck_frame(reviews, RAW_REVIEW))
    provided = ("raw_business", "raw_review")
    sql = {
        "silver_review": oracle.with_ctes("select * from silver_review", ("silver_review",), provided),
        "silver_business": oracle.with_ctes("select * from silver_business", ("silver_business",), provided),
        "weekly_stars": oracle.with_ctes(f"select {oracle.WEEKLY_OUT} from weekly_stars", ("weekly_stars",), provided),
    }
    for key, df in got.items():
        res = con.sql(sql[key])
        assert _canon(df.columns, df.collect()) == _canon(res.columns, res.fetchall()), key


items = st.sampled_from(
    ["2019-01-01 10:00:00", "2019-01-01 10:00:01", "2020-03-08 02:30:00", "bad", "", "2019-1-1 1:2:3",
     "2019-01-01 10:00:00,2019-01-01 11:00:00", " 2019-01-01 10:00:00"]
)
checkin_rows = st.lists(
    st.tuples(ids, st.one_of(st.none(), st.lists(items, min_size=1, max_size=5).map(", ".join))), max_size=12
)
RAW_CHECKIN = "business_id string, date string"


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(checkins=checkin_rows, businesses=business_rows)
def test_checkins_vs_stars_matches_oracle(spark, checkins, businesses):
    import duckdb

    b_rows = [(bid, name, "a", "c", "s", "p", 1.0, 2.0, s, n, 1, "k") for bid, name, s, n in businesses]
    raw_b = spark.createDataFrame(b_rows, RAW_BUSINESS)
    raw_c = spark.createDataFrame(checkins, RAW_CHECKIN)
    sb, sc = silver.clean_business(raw_b), silver.clean_checkin(raw_c)
    got = {"silver_checkin": sc, "checkins_vs_stars": gold.checkins_vs_stars(sc, sb)}

    con = duckdb.connect()
    con.register("raw_business", _duck_frame(b_rows, RAW_BUSINESS))
    con.register("raw_checkin", _duck_frame(checkins, RAW_CHECKIN))
    provided = ("raw_business", "raw_checkin")
    for key, df in got.items():
        res = con.sql(oracle.with_ctes(f"select * from {key}", (key,), provided))
        assert _canon(df.columns, df.collect()) == _canon(res.columns, res.fetchall()), key


counts_text = st.sampled_from([None, "0", "7", "3.7", "-2.5", "n/a", "", "3000000000"])
user_rows = st.lists(
    st.tuples(ids, st.sampled_from([None, "n", " n "]), counts, dates, counts, st.sampled_from([None, 1.5, 4.25])),
    max_size=12,
)
tip_rows = st.lists(st.tuples(ids, ids, texts, dates, counts_text), max_size=12)
RAW_USER = (
    "user_id string, name string, review_count bigint, yelping_since string, useful bigint, funny bigint, "
    "cool bigint, fans bigint, average_stars double"
)
RAW_TIP = "user_id string, business_id string, text string, date string, compliment_count string"


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(users=user_rows, tips=tip_rows)
def test_user_and_tip_match_oracle(spark, users, tips):
    import duckdb

    u_rows = [(uid, name, rc, since, fans, 0, 1, fans, avg) for uid, name, rc, since, fans, avg in users]
    got = {
        "silver_user": silver.clean_user(spark.createDataFrame(u_rows, RAW_USER)),
        "silver_tip": silver.clean_tip(spark.createDataFrame(tips, RAW_TIP)),
    }
    con = duckdb.connect()
    con.register("raw_user", _duck_frame(u_rows, RAW_USER))
    con.register("raw_tip", _duck_frame(tips, RAW_TIP))
    provided = ("raw_user", "raw_tip")
    for key, df in got.items():
        res = con.sql(oracle.with_ctes(f"select * from {key}", (key,), provided))
        assert _canon(df.columns, df.collect()) == _canon(res.columns, res.fetchall()), key


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(reviews=review_rows)
def test_both_dedup_plans_pick_the_same_survivor(spark, reviews):
    from strata.operators.rules import Dedup, deduplicate, project

    typed = project(spark.createDataFrame(reviews, RAW_REVIEW), silver.REVIEW).filter("review_id is not null")
    by_window = _canon(typed.columns, deduplicate(typed, Dedup(("review_id",))).collect())
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(key, "-1")
    try:
        by_min = _canon(typed.columns, deduplicate(typed, Dedup(("review_id",))).collect())
    finally:
        spark.conf.unset(key)
    assert by_window == by_min
