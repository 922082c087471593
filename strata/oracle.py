"""DuckDB SQL that computes the same results as the Spark operators.

Used only as the correctness oracle: the driver registers the given tables as
views and runs these strings next to the Spark queries. The text is written
independently of the Spark code (plain SQL over the same driver tables), so
an agreement is evidence, not an echo.

Where the two engines differ on their own, the SQL spells out the Spark
semantics:

* rounding: Spark rounds HALF_UP on the double's decimal text, so the oracle
  rounds ``x::varchar::decimal(38,20)``;
* strict timestamp parsing: DuckDB's ``try_strptime`` also accepts one-digit
  fields, so a full-match regex guards it;
* text to int: Spark truncates through double, DuckDB's cast rounds, so the
  oracle truncates first;
* integer widths: ``year``/``weekofyear`` are BIGINT and sums HUGEINT in
  DuckDB, so they are cast back.
"""

from __future__ import annotations

from strata.sources.fixtures import CHECKIN_CHUNK

TS_TEXT = "'%Y-%m-%d %H:%M:%S'"
TS_REGEX = r"'^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$'"


def _parse_ts(x: str) -> str:
    return f"(case when regexp_matches({x}, {TS_REGEX}) then try_strptime({x}, {TS_TEXT}) end)"


def _parse_date(x: str) -> str:
    return f"cast({_parse_ts(x)} as date)"


def _round2(x: str) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,20)), 2) as double)"


def _int(x: str) -> str:
    return f"try_cast({x} as integer)"


def _int_from_text(x: str) -> str:
    return (
        f"case when regexp_full_match({x}, '[+-]?[0-9]+([.][0-9]*)?') then try_cast(string_split({x}, '.')[1] as integer) "
        f"when regexp_full_match({x}, '[+-]?[.][0-9]+') then 0 end"
    )


def _day_text(n: str) -> str:
    return f"strftime(date '2010-01-01' + cast({n} as integer), {TS_TEXT})"


def _first_per_key(source: str, key: str, columns: list[str]) -> str:
    payload = [c for c in columns if c != key]
    order = ", ".join(f"{c} asc nulls last" for c in payload)
    cols = ", ".join(columns)
    return (
        f"select {cols} from (select {cols}, row_number() over "
        f"(partition by {key} order by {order}) as rn from {source}) where rn = 1"
    )


# name -> (dependencies, select text)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    _CTES[name] = (deps, sql)


# ---------------------------------------------------------------- raw adapters
def _business_shape(business_id: str, name: str, stars: str) -> str:
    return f"""
    select {business_id} as business_id, {name} as name,
           concat(p_size, ' Main St') as address, p_brand as city, p_type as state,
           lpad(cast(p_size as varchar), 5, '0') as postal_code,
           p_retailprice / 100 as latitude, -p_retailprice / 10 as longitude,
           {stars} as stars, p_partkey % 7 as review_count, p_partkey % 2 as is_open,
           concat(p_brand, ', ', p_type) as categories
    from part"""


_cte(
    "raw_business",
    (),
    _business_shape(
        "concat(' b', p_partkey, ' ')",
        "case when p_partkey % 19 = 0 then null else concat(p_name, ' ') end",
        "case when p_partkey % 17 = 0 then null else cast(p_partkey % 13 as double) / 2 end",
    )
    + "\n    union all"
    + _business_shape(
        "concat('b', p_partkey)",
        "case when p_partkey % 10 = 0 then 'zz dup' when p_partkey % 19 = 0 then null "
        "else concat(p_name, ' ') end",
        "cast(p_partkey % 11 as double) / 2",
    ),
)

_cte(
    "raw_review",
    (),
    f"""
    select concat(l_orderkey, '-', l_linenumber) as review_id,
           concat('u', l_suppkey) as user_id,
           case when l_partkey % 11 = 0 then concat('x', l_partkey)
                when l_suppkey % 3 = 0 then concat('b', l_partkey, ' ')
                else concat('b', l_partkey) end as business_id,
           cast(l_linenumber as double) as stars,
           cast(l_quantity as bigint) as useful,
           cast(l_quantity as bigint) % 3 as funny,
           case when l_partkey % 5 = 0 then null else cast(l_linenumber as bigint) end as cool,
           case when l_suppkey % 23 = 0 then 'bad'
                when l_suppkey % 29 = 0 then strftime(l_shipdate, '%Y-%m-%d')
                else strftime(l_shipdate, {TS_TEXT}) end as date,
           l_returnflag as text
    from lineitem""",
)

_cte(
    "raw_checkin",
    (),
    f"""
    select concat('b', user_id) as business_id,
           concat(items,
                  case when user_id % 7 = 0 then ', bad' else '' end,
                  case when user_id % 5 = 0 then concat(', ', items) else '' end) as date
    from (select user_id, string_agg(strftime(ts, {TS_TEXT}), ', ' order by ts) as items
          from events group by user_id, cast(ts as date), event_id // {CHECKIN_CHUNK})""",
)


def _user_shape(user_id: str, name: str, fans: str) -> str:
    return f"""
    select {user_id} as user_id, {name} as name, c_custkey as review_count,
           {_day_text("c_custkey")} as yelping_since,
           c_custkey % 4 as useful, c_custkey % 3 as funny, c_custkey % 2 as cool,
           {fans} as fans, c_acctbal / 2000 as average_stars
    from customer"""


_cte(
    "raw_user",
    (),
    _user_shape(
        "case when c_custkey % 29 = 0 then null else concat(' u', c_custkey) end",
        "c_name",
        "cast(c_nationkey as bigint)",
    )
    + "\n    union all"
    + _user_shape(
        "concat('u', c_custkey)",
        "case when c_custkey % 10 = 0 then 'zz dup' else c_name end",
        "cast(c_nationkey as bigint) + 1",
    ),
)

_cte(
    "raw_tip",
    (),
    f"""
    select concat('u', conv_id) as user_id,
           case when turn % 5 = 4 then null else concat('b', turn) end as business_id,
           case when turn % 3 = 2 then null else text end as text,
           {_day_text("conv_id")} as date,
           case when turn % 4 = 0 then cast(turn as varchar)
                when turn % 4 = 2 then concat(turn, '.7')
                else 'n/a' end as compliment_count
    from conversations""",
)

# ---------------------------------------------------------------- silver
BUSINESS_COLS = [
    "business_id", "business_name", "address", "city", "state", "postal_code",
    "latitude", "longitude", "stars", "review_count", "is_open", "categories",
]
REVIEW_COLS = [
    "review_id", "user_id", "business_id", "stars", "useful", "funny", "cool",
    "review_date", "review_text",
]
USER_COLS = [
    "user_id", "user_name", "review_count", "yelping_since", "useful", "funny", "cool",
    "fans", "average_stars",
]

_cte(
    "business_typed",
    ("raw_business",),
    f"""
    select trim(business_id) as business_id, trim(name) as business_name, address, city, state,
           postal_code, latitude, longitude, stars, {_int("review_count")} as review_count,
           {_int("is_open")} as is_open, categories
    from raw_business""",
)
_cte(
    "business_valid",
    ("business_typed",),
    """
    select * from business_typed
    where business_id is not null and business_name is not null and stars is not null
      and stars between 0 and 5""",
)
_cte("silver_business", ("business_valid",), _first_per_key("business_valid", "business_id", BUSINESS_COLS))

_cte(
    "review_typed",
    ("raw_review",),
    f"""
    select trim(review_id) as review_id, trim(user_id) as user_id, trim(business_id) as business_id,
           stars, {_int("useful")} as useful, {_int("funny")} as funny, {_int("cool")} as cool,
           {_parse_date("date")} as review_date, text as review_text
    from raw_review""",
)
_cte(
    "review_valid",
    ("review_typed",),
    """
    select * from review_typed
    where review_id is not null and user_id is not null and business_id is not null
      and stars is not null and stars between 0 and 5""",
)
_cte("silver_review", ("review_valid",), _first_per_key("review_valid", "review_id", REVIEW_COLS))

_cte(
    "checkin_items",
    ("raw_checkin",),
    "select business_id, unnest(string_split(date, ', ')) as checkin_time from raw_checkin",
)
_cte(
    "silver_checkin",
    ("checkin_items",),
    f"""
    select distinct business_id, checkin_timestamp, cast(checkin_timestamp as date) as checkin_date
    from (select trim(business_id) as business_id, {_parse_ts("checkin_time")} as checkin_timestamp
          from checkin_items)
    where business_id is not null and checkin_timestamp is not null""",
)

_cte(
    "user_valid",
    ("raw_user",),
    f"""
    select * from (
      select trim(user_id) as user_id, trim(name) as user_name, {_int("review_count")} as review_count,
             {_parse_date("yelping_since")} as yelping_since, {_int("useful")} as useful,
             {_int("funny")} as funny, {_int("cool")} as cool, {_int("fans")} as fans,
             average_stars
      from raw_user)
    where user_id is not null""",
)
_cte("silver_user", ("user_valid",), _first_per_key("user_valid", "user_id", USER_COLS))

_cte(
    "silver_tip",
    ("raw_tip",),
    f"""
    select * from (
      select trim(user_id) as user_id, trim(business_id) as business_id, text as tip_text,
             {_parse_date("date")} as tip_date, {_int_from_text("compliment_count")} as compliment_count
      from raw_tip)
    where user_id is not null and business_id is not null and tip_text is not null""",
)

# ---------------------------------------------------------------- gold
_cte(
    "weekly_agg",
    ("silver_review",),
    f"""
    select business_id,
           cast(year(review_date) as integer) as review_year,
           cast(weekofyear(review_date) as integer) as review_week_number,
           cast(date_trunc('week', review_date) as timestamp) as review_week,
           {_round2("avg(stars)")} as avg_stars_weekly,
           count(review_id) as review_count_weekly,
           {_round2("avg(useful)")} as avg_useful,
           {_round2("avg(funny)")} as avg_funny,
           {_round2("avg(cool)")} as avg_cool
    from silver_review
    group by 1, 2, 3, 4""",
)
_cte(
    "weekly_stars",
    ("silver_business", "weekly_agg"),
    """
    select b.business_id, b.business_name, b.city, b.state, b.stars as overall_stars,
           coalesce(w.review_week, timestamp '9999-01-01 00:00:00') as review_week,
           coalesce(w.review_year, 9999) as review_year,
           coalesce(w.review_week_number, 0) as review_week_number,
           coalesce(w.avg_stars_weekly, 0) as avg_stars_weekly,
           cast(coalesce(w.review_count_weekly, 0) as bigint) as review_count_weekly,
           coalesce(w.avg_useful, 0) as avg_useful,
           coalesce(w.avg_funny, 0) as avg_funny,
           coalesce(w.avg_cool, 0) as avg_cool
    from silver_business b left join weekly_agg w on b.business_id = w.business_id""",
)
_cte(
    "checkin_counts",
    ("silver_checkin",),
    "select business_id, count(checkin_timestamp) as total_checkins from silver_checkin group by business_id",
)
_cte(
    "checkins_vs_stars",
    ("silver_business", "checkin_counts"),
    f"""
    select b.business_id, b.business_name, b.city, b.state, b.stars, b.review_count,
           cast(coalesce(c.total_checkins, 0) as bigint) as total_checkins,
           {_round2("coalesce(c.total_checkins, 0) / nullif(b.review_count, 0)")} as checkins_per_review,
           case when b.stars >= 4.0 then 'High' when b.stars >= 2.5 then 'Medium' else 'Low' end
             as star_category
    from silver_business b left join checkin_counts c on b.business_id = c.business_id""",
)

WEEKLY_OUT = (
    "business_id, business_name, city, state, overall_stars, cast(review_week as date) as review_week, "
    "review_year, review_week_number, avg_stars_weekly, review_count_weekly, avg_useful, avg_funny, avg_cool"
)


def with_ctes(final: str, needs: tuple[str, ...], provided: tuple[str, ...] = ()) -> str:
    """``WITH`` every CTE ``final`` needs (transitively, in dependency order).

    Names in ``provided`` are expected to exist as tables and are not defined.
    """
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n in provided:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} as ({_CTES[n][1]}\n)" for n in order)
    return f"with {body}\n{final}"


def _hundredths_rounded(s: str, n: str) -> str:
    return f"cast(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) as double) / 100"


def _drift() -> str:
    """Rows per key that the narrow schemas of the query lack (a null is no key of the line), and lines cut off."""
    lacking = {
        "business": "address city state postal_code latitude longitude review_count is_open categories".split(),
        "review": "stars useful funny cool text".split(),
    }
    parts = [
        f"select '{name}' as dataset, 'undeclared' as problem, '{key}' as key, count(*) as rows from raw_{name} "
        f"where {key} is not null and not ends_with(coalesce(business_id, ''), '7')"
        for name, keys in lacking.items()
        for key in keys
    ]
    parts += [
        f"select '{name}', 'corrupt', null, count(*) from raw_{name} where ends_with(business_id, '7')" for name in lacking
    ]
    return f"select * from ({' union all '.join(parts)}) where rows > 0"


def queries(params: dict) -> dict[str, str]:
    """Oracle text for every registered key. ``params`` are the analysis arguments."""
    year = params["year"]
    trend_year = params["trend_year"]
    week = params["week"]
    years = ", ".join(str(y) for y in params["years"])
    name = params["business_name"].replace("'", "''")
    below = params["scatter_below"]
    scatter_n = params["scatter_n"]
    top_n = params["top_n"]
    checkins_n = params["checkins_n"]
    more_than = params["more_than"]

    counts = " union all ".join(
        f"select '{d}' as dataset, count(*) as row_count from raw_{d}"
        for d in ("business", "review", "user", "checkin", "tip")
    )
    layers = " union all ".join(
        [f"select 'bronze' as layer, '{d}' as dataset, count(*) as row_count from raw_{d}"
         for d in ("business", "review", "user", "checkin", "tip")]
        + [f"select 'silver' as layer, '{d}' as dataset, count(*) as row_count from silver_{d}"
           for d in ("business", "review", "user", "checkin", "tip")]
        + ["select 'gold' as layer, 'weekly_stars' as dataset, count(*) as row_count from weekly_stars",
           "select 'gold' as layer, 'checkins_vs_stars' as dataset, count(*) as row_count from checkins_vs_stars"]
    )
    all_raw = ("raw_business", "raw_review", "raw_user", "raw_checkin", "raw_tip")
    all_layers = all_raw + (
        "silver_business", "silver_review", "silver_user", "silver_checkin", "silver_tip",
        "weekly_stars", "checkins_vs_stars",
    )

    q = {
        # bronze and sinks
        "json_scan": ("select * from raw_review", ("raw_review",)),
        "bronze_metadata": (
            "select *, 'business.json' as source_file, true as ingested from raw_business",
            ("raw_business",),
        ),
        "bronze_load": ("select * from raw_business", ("raw_business",)),
        "bronze_declared": ("select * from raw_business", ("raw_business",)),
        "bronze_counts": (counts, all_raw),
        "bronze_incremental": ("select * from raw_business", ("raw_business",)),
        "bronze_drift": (_drift(), ("raw_business", "raw_review")),
        "parquet_roundtrip": ("select * from silver_business", ("silver_business",)),
        "versioned_publish": ("select * from silver_business", ("silver_business",)),
        "layer_counts": (layers, all_layers),
        # silver
        "silver_business": ("select * from silver_business", ("silver_business",)),
        "silver_review": ("select * from silver_review", ("silver_review",)),
        "silver_review_two_pass": ("select * from silver_review", ("silver_review",)),
        "silver_checkin": ("select * from silver_checkin", ("silver_checkin",)),
        "silver_user": ("select * from silver_user", ("silver_user",)),
        "silver_tip": ("select * from silver_tip", ("silver_tip",)),
        # scalars and filters
        "filter_star_range": (
            "select business_id, stars from raw_business where stars between 0 and 5",
            ("raw_business",),
        ),
        "scalar_trim": (
            "select business_id as raw_business_id, trim(business_id) as business_id, "
            "name as raw_name, trim(name) as business_name from raw_business",
            ("raw_business",),
        ),
        "scalar_cast": (
            f"select user_id, compliment_count as raw_compliment_count, "
            f"{_int_from_text('compliment_count')} as compliment_count from raw_tip",
            ("raw_tip",),
        ),
        "scalar_parse_ts": (
            f"select review_id, date as raw_date, {_parse_ts('date')} as review_ts, "
            f"{_parse_date('date')} as review_date from raw_review",
            ("raw_review",),
        ),
        "explode_list": ("select * from checkin_items", ("checkin_items",)),
        "week_parts": (
            "select review_id, review_date, cast(date_trunc('week', review_date) as date) as review_week, "
            "cast(year(review_date) as integer) as review_year, "
            "cast(weekofyear(review_date) as integer) as review_week_number from silver_review",
            ("silver_review",),
        ),
        "star_category": (
            "select business_id, stars, case when stars >= 4.0 then 'High' when stars >= 2.5 then 'Medium' "
            "else 'Low' end as star_category from silver_business",
            ("silver_business",),
        ),
        # gold
        "weekly_agg": (
            "select business_id, review_year, review_week_number, cast(review_week as date) as review_week, "
            "avg_stars_weekly, review_count_weekly, avg_useful, avg_funny, avg_cool from weekly_agg",
            ("weekly_agg",),
        ),
        "weekly_stars": (f"select {WEEKLY_OUT} from weekly_stars", ("weekly_stars",)),
        "weekly_partitioned": (f"select {WEEKLY_OUT} from weekly_stars", ("weekly_stars",)),
        "checkin_counts": ("select * from checkin_counts", ("checkin_counts",)),
        "checkins_vs_stars": ("select * from checkins_vs_stars", ("checkins_vs_stars",)),
        "end_to_end_weekly": (f"select {WEEKLY_OUT} from weekly_stars", ("weekly_stars",)),
        "weekly_incremental": (f"select {WEEKLY_OUT} from weekly_stars", ("weekly_stars",)),
        "weekly_from_sums": (f"select {WEEKLY_OUT} from weekly_stars", ("weekly_stars",)),
        "end_to_end": ("select * from checkins_vs_stars", ("checkins_vs_stars",)),
        "weekly_bucketed": (f"select {WEEKLY_OUT} from weekly_stars", ("weekly_stars",)),
        "weekly_ordered": (f"select {WEEKLY_OUT} from weekly_stars", ("weekly_stars",)),
        "end_to_end_cached": ("select * from checkins_vs_stars", ("checkins_vs_stars",)),
        "checkins_incremental": ("select * from checkins_vs_stars", ("checkins_vs_stars",)),
        # analyses
        "top_businesses_by_year": (
            f"""select business_id, business_name, city, state,
                   {_hundredths_rounded("s", "n")} as avg_stars_{year},
                   cast(total_reviews as bigint) as total_reviews
            from (select business_id, business_name, city, state,
                         sum(cast(round(avg_stars_weekly * 100) as bigint)) as s,
                         count(avg_stars_weekly) as n,
                         sum(review_count_weekly) as total_reviews
                  from weekly_stars where review_year = {year}
                  group by business_id, business_name, city, state)
            order by avg_stars_{year} desc, total_reviews desc, business_id
            limit {top_n}""",
            ("weekly_stars",),
        ),
        "weekly_multi_review": (
            f"select {WEEKLY_OUT} from weekly_stars where review_count_weekly > {more_than}",
            ("weekly_stars",),
        ),
        "quality_summary": (
            "select 'weekly_records' as metric, count(*) as value from weekly_stars union all "
            "select 'businesses_with_checkins' as metric, count(*) as value from checkins_vs_stars "
            "where total_checkins > 0",
            ("weekly_stars", "checkins_vs_stars"),
        ),
        "weekly_trend": (
            f"""select cast(review_week as date) as review_week,
                   cast(sum(cast(round(avg_stars_weekly * 100) as bigint)) as double)
                     / (count(avg_stars_weekly) * 100) as avg_stars,
                   count(*) as business_weeks
            from weekly_stars where review_year = {trend_year} group by review_week order by 1""",
            ("weekly_stars",),
        ),
        "checkin_scatter": (
            f"""select business_id, stars, total_checkins, checkins_per_review from checkins_vs_stars
            where total_checkins < {below} order by total_checkins desc, business_id limit {scatter_n}""",
            ("checkins_vs_stars",),
        ),
        "top_checkins": (
            f"select * from checkins_vs_stars order by total_checkins desc, business_id limit {checkins_n}",
            ("checkins_vs_stars",),
        ),
        "business_history": (
            f"select {WEEKLY_OUT} from weekly_stars where business_name = '{name}' "
            "order by review_count_weekly desc, business_id, review_week, review_year, review_week_number",
            ("weekly_stars",),
        ),
        "same_week_yoy": (
            f"select {WEEKLY_OUT} from weekly_stars where review_week_number = {week} "
            f"and review_year in ({years})",
            ("weekly_stars",),
        ),
    }
    return {k: with_ctes(final, needs) for k, (final, needs) in q.items()}
