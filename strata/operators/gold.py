"""Gold layer: weekly star ratings per business and check-ins against stars.

Both tables aggregate first and join second. The aggregation runs partially
on the map side, so a business holding a large share of all reviews or
check-ins is folded to a handful of rows per task before any shuffle; after
it, a business has at most one row per week (or exactly one row), so the join
on ``business_id`` cannot be skewed whatever the input looks like.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import scalars as S

WEEK_KEYS = ("business_id", "review_year", "review_week_number", "review_week")

WEEKLY_STARS_COLUMNS = (
    "business_id",
    "business_name",
    "city",
    "state",
    "overall_stars",
    "review_week",
    "review_year",
    "review_week_number",
    "avg_stars_weekly",
    "review_count_weekly",
    "avg_useful",
    "avg_funny",
    "avg_cool",
)

CHECKINS_VS_STARS_COLUMNS = (
    "business_id",
    "business_name",
    "city",
    "state",
    "stars",
    "review_count",
    "total_checkins",
    "checkins_per_review",
    "star_category",
)


MEASURES = ("stars", "useful", "funny", "cool")
#: How the weekly average of a measure is called.
AVERAGES = {"stars": "avg_stars_weekly", "useful": "avg_useful", "funny": "avg_funny", "cool": "avg_cool"}


def _by_week(reviews: DataFrame):
    d = F.col("review_date")
    return reviews.groupBy(
        "business_id",
        S.calendar_year(d).alias("review_year"),
        S.iso_week(d).alias("review_week_number"),
        S.week_start(d).alias("review_week"),
    )


def weekly_agg(reviews: DataFrame, count_column: str | None = "review_id") -> DataFrame:
    """Reviews per (business, calendar year, ISO week number, week start).

    ``review_week`` is part of the key on purpose: the week holding 1 January
    splits over two calendar years, and (year, week number) alone can name
    two different weeks. Undated reviews form one NULL-keyed group per
    business.

    ``review_count_weekly`` counts non-NULL ``count_column`` values;
    ``count_column=None`` counts rows. For silver reviews, whose review_id is
    required, the two agree, and counting rows spares the scan the id column
    (a third of the bytes the aggregate reads).

    Stars are summed exactly, so their average does not depend on the order of
    addition whatever decimals they have; sums of whole numbers are exact anyway.
    """
    counted = F.count(F.lit(1)) if count_column is None else F.count(count_column)
    stars = S.exact_sums("stars", "stars", reviews.schema["stars"].dataType)
    grouped = _by_week(reviews).agg(
        *[c.alias(k) for k, c in stars.items()],
        counted.alias("review_count_weekly"),
        S.round2(F.avg("useful")).alias("avg_useful"),
        S.round2(F.avg("funny")).alias("avg_funny"),
        S.round2(F.avg("cool")).alias("avg_cool"),
    )
    return grouped.select(
        *WEEK_KEYS, S.exact_mean2("stars").alias("avg_stars_weekly"), "review_count_weekly", "avg_useful", "avg_funny", "avg_cool"
    )


def weekly_sums(reviews: DataFrame, sign: int = 1) -> DataFrame:
    """What :func:`weekly_agg` is made from, as sums that add up over batches: ``n`` rows and per measure its exact sums.

    ``sign=-1`` takes reviews out. See :mod:`strata.operators.state`.
    """
    sums: dict[str, Column] = {}
    for m in MEASURES:
        sums |= S.exact_sums(m, m, reviews.schema[m].dataType, sign)
    return _by_week(reviews).agg((F.count(F.lit(1)) * sign).alias("n"), *[c.alias(k) for k, c in sums.items()])


def weekly_averages(sums: DataFrame) -> DataFrame:
    """:func:`weekly_agg` from added-up sums: rounded here and nowhere before."""
    return sums.select(
        *WEEK_KEYS,
        S.exact_mean2("stars").alias("avg_stars_weekly"),
        F.col("n").alias("review_count_weekly"),
        *[S.exact_mean2(m).alias(AVERAGES[m]) for m in MEASURES[1:]],
    )


def with_business(weekly: DataFrame, business: DataFrame, how: str = "left") -> DataFrame:
    """Every silver business with its weekly figures; see :func:`weekly_stars`. ``how="inner"``: only those that have some."""
    zero = F.lit(0)
    return business.join(weekly, "business_id", how).select(
        "business_id",
        "business_name",
        "city",
        "state",
        F.col("stars").alias("overall_stars"),
        F.coalesce("review_week", S.no_review_week()).alias("review_week"),
        F.coalesce("review_year", F.lit(S.NO_REVIEW_YEAR)).alias("review_year"),
        F.coalesce("review_week_number", F.lit(S.NO_REVIEW_WEEK_NUMBER)).alias("review_week_number"),
        F.coalesce("avg_stars_weekly", zero).alias("avg_stars_weekly"),
        F.coalesce("review_count_weekly", zero).alias("review_count_weekly"),
        F.coalesce("avg_useful", zero).alias("avg_useful"),
        F.coalesce("avg_funny", zero).alias("avg_funny"),
        F.coalesce("avg_cool", zero).alias("avg_cool"),
    )


def weekly_stars(
    reviews: DataFrame,
    business: DataFrame,
    count_column: str | None = "review_id",
    stage: Callable[[DataFrame], DataFrame] = lambda weekly: weekly,
) -> DataFrame:
    """Every silver business with its weekly review figures.

    LEFT join: a business without reviews keeps one row with the sentinel
    keys (9999-01-01, 9999, 0) and zero metrics; aggregates of businesses
    missing from silver are dropped. Undated reviews get the same sentinel
    keys but a non-zero count. ``count_column`` as in :func:`weekly_agg`;
    ``stage`` may keep the weekly figures somewhere before they are joined.
    """
    return with_business(stage(weekly_agg(reviews, count_column)), business)


def sort_weekly(weekly: DataFrame) -> DataFrame:
    """Total order for reading weekly_stars: business, year, week number, week."""
    return weekly.orderBy(*WEEK_KEYS)


def checkin_counts(checkins: DataFrame, count_column: str | None = "checkin_timestamp") -> DataFrame:
    """Check-ins per business: non-NULL ``count_column`` values, or rows when None.

    Silver check-ins always have a timestamp (a required field), so for them
    both counts agree and counting rows reads only ``business_id``.
    """
    counted = F.count(F.lit(1)) if count_column is None else F.count(count_column)
    return checkins.groupBy("business_id").agg(counted.alias("total_checkins"))


def checkins_vs_stars(
    checkins: DataFrame, business: DataFrame, count_column: str | None = "checkin_timestamp"
) -> DataFrame:
    """One row per silver business: check-ins, check-ins per review, star bucket.

    ``review_count`` is the business record's own field. The ratio is NULL
    when it is 0 or NULL. ``count_column`` as in :func:`checkin_counts`.
    """
    return with_checkins(checkin_counts(checkins, count_column), business)


def with_checkins(counts: DataFrame, business: DataFrame) -> DataFrame:
    """Every silver business with its check-in count; see :func:`checkins_vs_stars`."""
    return (
        business.join(counts, "business_id", "left")
        .select(
            "business_id",
            "business_name",
            "city",
            "state",
            "stars",
            "review_count",
            F.coalesce("total_checkins", F.lit(0).cast("bigint")).alias("total_checkins"),
        )
        .withColumns(
            {
                "checkins_per_review": S.round2(S.safe_ratio("total_checkins", "review_count")),
                "star_category": S.star_category("stars"),
            }
        )
    )


def sort_checkins(cvs: DataFrame) -> DataFrame:
    """Most check-ins first; ties broken by business_id."""
    return cvs.orderBy(F.col("total_checkins").desc(), "business_id")
