"""Silver layer: typed, filtered and deduplicated tables, one spec per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.rules import Between, Dedup, Explode, Field, TableSpec, clean

# Fixed value: the accepted star range, inclusive at both ends.
STARS = Between("stars", 0, 5)

BUSINESS = TableSpec(
    name="business",
    fields=(
        Field("business_id", trim=True),
        Field("name", "business_name", trim=True),
        Field("address"),
        Field("city"),
        Field("state"),
        Field("postal_code"),
        Field("latitude", type="double"),
        Field("longitude", type="double"),
        Field("stars", type="double"),
        Field("review_count", type="int"),
        Field("is_open", type="int"),
        Field("categories"),
    ),
    required=("business_id", "business_name", "stars"),
    ranges=(STARS,),
    dedup=Dedup(("business_id",)),
    notes="the nested `attributes` struct is dropped: it has no stable shape",
)

REVIEW = TableSpec(
    name="review",
    fields=(
        Field("review_id", trim=True),
        Field("user_id", trim=True),
        Field("business_id", trim=True),
        Field("stars", type="double"),
        Field("useful", type="int"),
        Field("funny", type="int"),
        Field("cool", type="int"),
        Field("date", "review_date", type="date"),
        Field("text", "review_text"),
    ),
    required=("review_id", "user_id", "business_id", "stars"),
    ranges=(STARS,),
    dedup=Dedup(("review_id",)),
    notes="a review whose date does not parse is kept with a NULL review_date",
)

CHECKIN = TableSpec(
    name="checkin",
    explode=Explode("date", "checkin_time"),
    fields=(
        Field("business_id", trim=True),
        Field("checkin_time", "checkin_timestamp", type="timestamp"),
        Field("checkin_time", "checkin_date", type="date"),
    ),
    required=("business_id", "checkin_timestamp"),
    # checkin_date follows from the timestamp: nothing to choose between copies.
    dedup=Dedup(("business_id", "checkin_timestamp"), survivor="any"),
)

USER = TableSpec(
    name="user",
    fields=(
        Field("user_id", trim=True),
        Field("name", "user_name", trim=True),
        Field("review_count", type="int"),
        Field("yelping_since", type="date"),
        Field("useful", type="int"),
        Field("funny", type="int"),
        Field("cool", type="int"),
        Field("fans", type="int"),
        Field("average_stars", type="double"),
    ),
    required=("user_id",),
    dedup=Dedup(("user_id",)),
)

TIP = TableSpec(
    name="tip",
    fields=(
        Field("user_id", trim=True),
        Field("business_id", trim=True),
        Field("text", "tip_text"),
        Field("date", "tip_date", type="date"),
        Field("compliment_count", type="int"),
    ),
    required=("user_id", "business_id", "tip_text"),
    notes="no dedup: a user may tip one business many times and tips carry no id",
)

SPECS: dict[str, TableSpec] = {s.name: s for s in (BUSINESS, REVIEW, CHECKIN, USER, TIP)}


def clean_business(df: DataFrame) -> DataFrame:
    return clean(df, BUSINESS)


def clean_review(df: DataFrame) -> DataFrame:
    return clean(df, REVIEW)


def clean_checkin(df: DataFrame) -> DataFrame:
    return clean(df, CHECKIN)


def clean_user(df: DataFrame) -> DataFrame:
    return clean(df, USER)


def clean_tip(df: DataFrame) -> DataFrame:
    return clean(df, TIP)
