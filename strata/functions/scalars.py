"""Scalar column expressions shared by every layer.

Everything here is a built-in Spark function, so it stays inside whole-stage
codegen. Everything is safe under ANSI mode (the Spark 4 default): text that
does not parse, numbers that overflow and divisions by zero give NULL rather
than failing the job, which is what a tolerant silver layer needs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. The layers and the analyses must agree on these.
# ---------------------------------------------------------------------------
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
LIST_SEPARATOR = ", "
NO_REVIEW_WEEK = "9999-01-01 00:00:00"
NO_REVIEW_YEAR = 9999
NO_REVIEW_WEEK_NUMBER = 0
HIGH_STARS = 4.0
MEDIUM_STARS = 2.5
STAR_LABELS = ("High", "Medium", "Low")

def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Sign, integer part and fraction of plain decimal text with a digit somewhere; control characters and spaces around it.
DECIMAL_TEXT = r"^[\x00-\x20]*([+-]?[0-9]*)(?:(?<=[0-9])\.[0-9]*|\.[0-9]+|(?<=[0-9]))[\x00-\x20]*$"


def ascii_trim(c: str | Column) -> Column:
    """Strip ASCII spaces at both ends; tabs and newlines stay, '' stays ''."""
    return F.trim(_c(c))


def tolerant_cast(c: str | Column, target: str, source_type: T.DataType | None = None) -> Column:
    """Cast that yields NULL instead of failing.

    Text bound for an integer must be a plain decimal number; its integer part
    is cast straight to the target, so ``'3.7'`` becomes 3 (truncation, as a
    non-ANSI cast gives) and no digit of a wide number is lost, while
    ``'abc'``, ``'1e3'``, ``'5d'`` and values out of range become NULL.
    """
    col = _c(c)
    if target in ("int", "bigint", "smallint", "tinyint") and isinstance(source_type, T.StringType):
        whole = F.regexp_extract(col, DECIMAL_TEXT, 1)
        plain = col.rlike(DECIMAL_TEXT)
        return F.when(plain & whole.rlike("[0-9]"), whole.try_cast(target)).when(plain, F.lit(0).cast(target))
    if source_type is not None and target == "string" and isinstance(source_type, T.StringType):
        return col
    return col.try_cast(target)


def parse_timestamp(c: str | Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Strict pattern parse to a session-zone timestamp; anything else is NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def parse_date(c: str | Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Date part of :func:`parse_timestamp`."""
    return F.to_date(parse_timestamp(c, fmt))


def split_list(c: str | Column, separator: str = LIST_SEPARATOR) -> Column:
    """Split on a literal separator; items are not trimmed, '' gives ['']."""
    return F.split(_c(c), re.escape(separator))


def week_start(d: str | Column) -> Column:
    """Monday 00:00 of the ISO week, as a timestamp."""
    return F.date_trunc("week", _c(d))


def calendar_year(d: str | Column) -> Column:
    """Calendar year, deliberately not the ISO week-based year."""
    return F.year(_c(d))


def iso_week(d: str | Column) -> Column:
    """ISO-8601 week number, 1 to 53."""
    return F.weekofyear(_c(d))


def round2(c: str | Column) -> Column:
    """HALF_UP rounding to two digits of the value's decimal text."""
    return F.round(_c(c), 2)


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator as double; NULL for a zero or NULL divisor."""
    return F.try_divide(_c(numerator), _c(denominator))


def star_category(stars: str | Column) -> Column:
    """High from 4.0, Medium from 2.5, otherwise Low (NULL falls to Low)."""
    s = _c(stars)
    high, medium, low = STAR_LABELS
    return F.when(s >= HIGH_STARS, high).when(s >= MEDIUM_STARS, medium).otherwise(low)


def no_review_week() -> Column:
    """Sentinel week for a business without dated reviews (session zone)."""
    return F.lit(NO_REVIEW_WEEK).cast("timestamp")


def _hundredths(c: str | Column) -> Column:
    # Values already rounded to two digits, as exact integers.
    return F.round(_c(c) * 100).cast("bigint")


def avg_hundredths_rounded(c: str | Column) -> Column:
    """``round(avg(c), 2)`` for values that already carry two digits, exactly.

    A double sum of such values depends on the order of addition, so the
    plain form can change with the partitioning. Summing integer hundredths
    and rounding HALF_UP in integer arithmetic gives one answer everywhere.
    NULL inputs are skipped; an all-NULL group gives NULL.
    """
    s = F.sum(_hundredths(c))
    n = F.count(_c(c))
    # |s| / n rounded half up is (2|s| + n) div 2n; the sign goes back on after.
    magnitude = F.call_function("div", 2 * F.abs(s) + n, 2 * n)
    rounded = F.when(s < 0, -magnitude).otherwise(magnitude)
    return F.when(n > 0, rounded.cast("double") / 100)


def avg_hundredths(c: str | Column) -> Column:
    """Unrounded mean of two-digit values, independent of summation order."""
    n = F.count(_c(c))
    return F.when(n > 0, F.sum(_hundredths(c)).cast("double") / (n * 100))


# ---------------------------------------------------------------------------
# Means that do not depend on the order of addition: exact sums first, one
# division and rounding at the end.
# ---------------------------------------------------------------------------
REST_DIGITS = 15  # digits after the point that a value's decimal text is summed with


def exact_sums(c: str, prefix: str, source_type: T.DataType, sign: int = 1) -> dict[str, Column]:
    """Aggregates that add up exactly, all bigint: ``<prefix>_n`` (non-NULL values), ``<prefix>_h`` (hundredths) and ``<prefix>_r``.

    Whole numbers and values of at most two decimals, which ratings are, are
    summed as hundredths. Of other values, what their decimal text (15 digits
    after the point) has beyond hundredths is summed in ``<prefix>_r``, in units
    of 10 ** -15. NaN, infinite values and those of 10 ** 15 or more count as
    NULL; a sum too large for a bigint is an error. ``sign=-1`` takes rows out again.
    """
    v, n, none = F.col(c), F.lit(sign), F.lit(0).cast("bigint")
    total = lambda x: F.coalesce(F.sum(x), none) * n
    if isinstance(source_type, T.IntegralType):
        return {f"{prefix}_n": F.count(v) * n, f"{prefix}_h": total(v.cast("bigint") * 100), f"{prefix}_r": none}
    known = F.when(F.abs(v) < 1e15, v)
    h = F.rint(known * 100)
    text = known.cast(f"decimal(38,{REST_DIGITS})")
    rest = ((text - (h / 100).cast(f"decimal(38,{REST_DIGITS})")) * 10**REST_DIGITS).cast("bigint")
    return {
        f"{prefix}_n": F.count(known) * n,
        f"{prefix}_h": total(h.cast("bigint")),
        f"{prefix}_r": total(F.when(h / 100 == v, none).otherwise(rest)),
    }


def exact_mean2(prefix: str) -> Column:
    """The mean of what :func:`exact_sums` summed, HALF_UP to two digits; NULL without values."""
    n, h, r = (F.col(f"{prefix}_{x}") for x in "nhr")
    # (2 |s| + n) div 2n is |s| / n rounded half up, in whole hundredths or in decimals.
    plain = F.call_function("div", 2 * F.abs(h) + n, 2 * n)
    sum_ = h.cast("decimal(38,0)") * 10 ** (REST_DIGITS - 2) + r
    unit = (2 * n).cast("decimal(38,0)") * 10 ** (REST_DIGITS - 2)
    exact = F.call_function("div", 2 * F.abs(sum_) + unit / 2, unit)
    size = F.when(r == 0, plain).otherwise(exact)
    return F.when(n > 0, F.when(F.when(r == 0, h < 0).otherwise(sum_ < 0), -size).otherwise(size).cast("double") / 100)
