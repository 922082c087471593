"""Analytical queries over the gold tables.

Every sort that feeds a limit ends with a unique key, so a top-k is the same
set of rows on every run and every partitioning. Inputs are selected by column
name, so a weekly_stars read back from its partitioned layout (where the
partition column moves to the end) works unchanged.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import scalars as S
from strata.operators.gold import checkin_counts as _checkin_counts


def top_businesses_by_year(weekly: DataFrame, year: int, n: int = 10) -> DataFrame:
    """Best businesses of a calendar year.

    The mean is over the year's weekly averages, unweighted by the number of
    reviews in each week; ties go to more reviews, then to business_id.
    """
    avg_name = f"avg_stars_{year}"
    return (
        weekly.filter(F.col("review_year") == year)
        .groupBy("business_id", "business_name", "city", "state")
        .agg(
            S.avg_hundredths_rounded("avg_stars_weekly").alias(avg_name),
            F.sum("review_count_weekly").alias("total_reviews"),
        )
        .orderBy(F.col(avg_name).desc(), F.col("total_reviews").desc(), "business_id")
        .limit(n)
    )


def weekly_multi_review(weekly: DataFrame, more_than: int = 1) -> DataFrame:
    """Weeks in which a business got more than ``more_than`` reviews."""
    return weekly.filter(F.col("review_count_weekly") > more_than)


def quality_summary(weekly: DataFrame, cvs: DataFrame) -> DataFrame:
    """Row count of weekly_stars and number of businesses with a check-in.

    Two global counts stacked as (metric, value) rows; no cross join.
    """
    return weekly.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("weekly_records").alias("metric"), "value"
    ).unionByName(
        cvs.filter("total_checkins > 0")
        .agg(F.count(F.lit(1)).alias("value"))
        .select(F.lit("businesses_with_checkins").alias("metric"), "value")
    )


def weekly_trend(weekly: DataFrame, year: int) -> DataFrame:
    """Mean of the weekly star averages per week start, over all rows of a year, in week order."""
    return (
        weekly.filter(F.col("review_year") == year)
        .groupBy("review_week")
        .agg(
            S.avg_hundredths("avg_stars_weekly").alias("avg_stars"),
            F.count(F.lit(1)).alias("business_weeks"),
        )
        .orderBy("review_week")
    )


def checkin_scatter(cvs: DataFrame, below: int = 20000, n: int = 1000) -> DataFrame:
    """Data behind the check-ins vs stars scatter: top ``n`` by check-ins under a cap."""
    return (
        cvs.filter(F.col("total_checkins") < below)
        .orderBy(F.col("total_checkins").desc(), "business_id")
        .limit(n)
        .select("business_id", "stars", "total_checkins", "checkins_per_review")
    )


def top_checkins(cvs: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` businesses with most check-ins."""
    return cvs.orderBy(F.col("total_checkins").desc(), "business_id").limit(n)


def business_history(weekly: DataFrame, name: str) -> DataFrame:
    """All weekly rows of the businesses with this exact name, busiest week first."""
    return weekly.filter(F.col("business_name") == name).orderBy(
        F.col("review_count_weekly").desc(), "business_id", "review_week", "review_year", "review_week_number"
    )


def checkin_counts(checkins: DataFrame) -> DataFrame:
    """Check-ins per business over silver check-ins (all businesses, not just silver ones)."""
    return _checkin_counts(checkins)


def same_week_yoy(weekly: DataFrame, week: int, years: Iterable[int]) -> DataFrame:
    """One ISO week number across several calendar years."""
    return weekly.filter((F.col("review_week_number") == week) & F.col("review_year").isin(list(years)))
