"""ANSI-safe scalar expressions (trim, tolerant casts, strict parsing, week parts)."""

from strata.functions.scalars import (
    HIGH_STARS,
    LIST_SEPARATOR,
    MEDIUM_STARS,
    NO_REVIEW_WEEK,
    NO_REVIEW_WEEK_NUMBER,
    NO_REVIEW_YEAR,
    STAR_LABELS,
    TIMESTAMP_FORMAT,
    ascii_trim,
    avg_hundredths,
    avg_hundredths_rounded,
    calendar_year,
    iso_week,
    no_review_week,
    parse_date,
    parse_timestamp,
    round2,
    safe_ratio,
    split_list,
    star_category,
    tolerant_cast,
    week_start,
)

__all__ = [
    "HIGH_STARS",
    "LIST_SEPARATOR",
    "MEDIUM_STARS",
    "NO_REVIEW_WEEK",
    "NO_REVIEW_WEEK_NUMBER",
    "NO_REVIEW_YEAR",
    "STAR_LABELS",
    "TIMESTAMP_FORMAT",
    "ascii_trim",
    "avg_hundredths",
    "avg_hundredths_rounded",
    "calendar_year",
    "iso_week",
    "no_review_week",
    "parse_date",
    "parse_timestamp",
    "round2",
    "safe_ratio",
    "split_list",
    "star_category",
    "tolerant_cast",
    "week_start",
]
