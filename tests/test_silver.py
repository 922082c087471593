"""Silver cleaners on literal rows."""

import datetime as dt

from strata.operators import silver
from strata.operators.rules import Dedup, deduplicate

BUSINESS_SCHEMA = (
    "business_id string, name string, address string, city string, state string, postal_code string, "
    "latitude double, longitude double, stars double, review_count bigint, is_open bigint, "
    "categories string, attributes struct<parking:boolean>"
)


def business_rows(spark, rows):
    full = [
        (bid, name, "1 Main", "c", "s", "00001", 1.0, 2.0, stars, 3, 1, "cat", (True,))
        for bid, name, stars in rows
    ]
    return spark.createDataFrame(full, BUSINESS_SCHEMA)


def test_business_drops_attributes_and_filters(spark):
    raw = business_rows(
        spark,
        [(" b1 ", " Cafe ", 4.0), ("b2", None, 3.0), ("b3", "x", None), ("b4", "y", 5.5), (None, "z", 1.0)],
    )
    out = silver.clean_business(raw)
    assert "attributes" not in out.columns
    assert out.columns[:2] == ["business_id", "business_name"]
    rows = out.collect()
    assert [(r.business_id, r.business_name, r.stars) for r in rows] == [("b1", "Cafe", 4.0)]


def test_dedup_after_trim_and_deterministic_survivor(spark):
    raw = business_rows(spark, [(" b1", "Zed", 2.0), ("b1 ", "Abe", 3.0), ("b1", "Abe", 1.0)])
    for parts in (1, 3, 7):
        out = silver.clean_business(raw.repartition(parts)).collect()
        assert [(r.business_id, r.business_name, r.stars) for r in out] == [("b1", "Abe", 1.0)]


def test_blank_id_passes(spark):
    raw = business_rows(spark, [("   ", "n", 1.0)])
    assert [r.business_id for r in silver.clean_business(raw).collect()] == [""]


def test_blank_ids_rejected_on_request(spark):
    import dataclasses

    from strata.operators.rules import clean

    raw = business_rows(spark, [("   ", "n", 1.0), ("b1", "  ", 2.0), ("b2", "m", 3.0)])
    strict = dataclasses.replace(silver.BUSINESS, reject_blank=True)
    assert [r.business_id for r in clean(raw, strict).collect()] == ["b2"]
    assert len(silver.clean_business(raw).collect()) == 3  # parity default keeps all three
    # Text that is not trimmed on the way in is still judged after trimming.
    tips = spark.createDataFrame(
        [("u1", "b1", "   ", "2019-01-01 10:00:00", "1"), ("u2", "b2", "ok", "2019-01-01 10:00:00", "1")],
        "user_id string, business_id string, text string, date string, compliment_count string",
    )
    strict_tip = dataclasses.replace(silver.TIP, reject_blank=True)
    assert [r.user_id for r in clean(tips, strict_tip).collect()] == ["u2"]


def test_dedup_on_a_stream_takes_the_aggregate_path(spark, tmp_path):
    from strata.operators.rules import _window_group_limit_on

    src = tmp_path / "in"
    spark.createDataFrame([("r1", "u", "b", 1.0)], "review_id string, user_id string, business_id string, "
                          "stars double").write.json(str(src))
    stream = spark.readStream.schema("review_id string, user_id string, business_id string, stars double").json(
        str(src))
    assert stream.isStreaming and not _window_group_limit_on(stream)
    out = silver.clean_review(stream)  # planning must not raise
    assert out.isStreaming


def test_review_keeps_undated_rows(spark):
    raw = spark.createDataFrame(
        [("r1", "u", "b", 3.0, 1, 0, None, "bad", "t"), ("r2", "u", "b", 4.0, 2, 1, 1, "2018-07-07 10:00:00", "t")],
        "review_id string, user_id string, business_id string, stars double, useful bigint, funny bigint, "
        "cool bigint, date string, text string",
    )
    got = {r.review_id: r.review_date for r in silver.clean_review(raw).collect()}
    assert got == {"r1": None, "r2": dt.date(2018, 7, 7)}


def test_checkin_explode_parse_dedup(spark):
    raw = spark.createDataFrame(
        [
            (" b1", "2020-01-01 10:00:00, 2020-01-01 10:00:00, bad,2020-01-02 00:00:00"),
            ("b1", "2020-01-01 10:00:00"),
            ("b2", None),
            (None, "2020-01-03 00:00:00"),
        ],
        "business_id string, date string",
    )
    rows = silver.clean_checkin(raw).collect()
    assert [(r.business_id, r.checkin_timestamp, r.checkin_date) for r in rows] == [
        ("b1", dt.datetime(2020, 1, 1, 10, 0), dt.date(2020, 1, 1))
    ]


def test_tip_has_no_dedup(spark):
    raw = spark.createDataFrame(
        [("u", "b", "same", "2020-01-01 00:00:00", "2"), ("u", "b", "same", "2020-01-01 00:00:00", "2.7")],
        "user_id string, business_id string, text string, date string, compliment_count string",
    )
    rows = silver.clean_tip(raw).collect()
    assert [r.compliment_count for r in rows] == [2, 2]


def test_user_missing_raw_column_is_typed_null(spark):
    raw = spark.createDataFrame([(" u1", "Ann")], "user_id string, name string")
    out = silver.clean_user(raw)
    r = out.collect()[0]
    assert (r.user_id, r.user_name, r.fans, r.yelping_since) == ("u1", "Ann", None, None)
    assert dict(out.dtypes)["fans"] == "int"


def test_dedup_nulls_last(spark):
    df = spark.createDataFrame([("k", None), ("k", "a")], "k string, v string")
    assert deduplicate(df, Dedup(("k",))).collect()[0].v == "a"
