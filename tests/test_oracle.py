"""Every registered query against its DuckDB oracle (smallest tables unless STRATA_ORACLE_SF is set)."""

import datetime as dt
import decimal
import math

import pytest

import __spark_entry__ as E
from strata.registry import QUERIES
from conftest import ORACLE_DIR


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def _canon(cols, rows):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return order, sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) >= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, ORACLE_DIR)
    s_cols, s_rows = _canon(df.columns, df.collect())
    res = duck.sql(E.oracle_sql()[key])
    o_cols, o_rows = _canon(res.columns, res.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["business_id", "business_name", "city", "state", "avg_stars_1998", "total_reviews"]


@pytest.mark.parametrize("key", ["scalar_cast", "scalar_parse_ts", "silver_review", "silver_tip", "checkins_vs_stars"])
def test_same_results_with_ansi_off(spark, duck, key):
    """Tolerant conversions go through try_*, so a non-ANSI caller session gets the same rows."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = E.queries()[key](spark, ORACLE_DIR)
        s_cols, s_rows = _canon(df.columns, df.collect())
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    res = duck.sql(E.oracle_sql()[key])
    assert (s_cols, s_rows) == _canon(res.columns, res.fetchall())


@pytest.mark.parametrize("key", ["top_businesses_by_year", "weekly_trend", "checkin_scatter", "top_checkins", "business_history"])
def test_sorted_results_come_in_the_oracles_order(spark, duck, key):
    df = E.queries()[key](spark, ORACLE_DIR)
    res = duck.sql(E.oracle_sql()[key])
    at = [res.columns.index(c) for c in df.columns]
    assert [tuple(map(_norm, r)) for r in df.collect()] == [tuple(_norm(r[i]) for i in at) for r in res.fetchall()]
