import json

import pytest

from strata.functions.scalars import tolerant_cast
from strata.operators import analyses
from strata.operators.rules import clean
from strata.operators.silver import SPECS
from strata.plans.session import clear_scratch, scratch_path
from strata.sources.raw import RAW_SCHEMAS, read_raw
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW = {
    "business": [
        {"business_id": "b1", "name": "N", "stars": "4.5", "review_count": 3.0, "is_open": 1, "categories": "A, B", "attributes": {"x": {"y": 1}}, "extra": 5},
        {"business_id": "b2", "name": "M", "stars": 4, "review_count": 7, "is_open": "0", "latitude": 1.25},
    ],
    "review": [
        {"review_id": "r1", "user_id": "u", "business_id": "b1", "stars": "4.0", "useful": 3.0, "funny": 0, "cool": 1, "date": "2018-01-01 10:00:00", "text": "t", "extra": "e"},
        {"review_id": "r2", "user_id": "u", "business_id": "b1", "stars": 5, "useful": "2", "date": "x", "text": "t"},
    ],
    "user": [{"user_id": "u", "name": "n", "review_count": 3.0, "fans": "4", "average_stars": "3.5", "friends": ["a"], "extra": 1}, {"user_id": "v", "review_count": 2}],
    "checkin": [{"business_id": "b1", "date": "2018-01-01 10:00:00, 2018-01-02 10:00:00", "extra": 1}],
    "tip": [{"user_id": "u", "business_id": "b1", "text": "t", "date": "2018-01-01 10:00:00", "compliment_count": 3.0, "extra": 1}, {"user_id": "u", "business_id": "b1", "text": "s", "compliment_count": "7"}],
}


@pytest.mark.parametrize("name", sorted(RAW))
def test_declared_and_inferred_schemas_give_the_same_silver(spark, tmp_path, name):
    path = tmp_path / f"{name}.json"
    path.write_text("".join(json.dumps(r) + "\n" for r in RAW[name]))
    rows = [
        sorted(map(repr, clean(read_raw(spark, str(path), schema), SPECS[name]).collect())) for schema in (None, RAW_SCHEMAS[name])
    ]
    assert rows[0] == rows[1] and rows[0]
    assert "extra" in read_raw(spark, str(path)).columns


def test_text_to_integer_keeps_wide_numbers_and_refuses_exponents(spark):
    texts = ["3", "3.7", "-2.9", " 4 ", "1e3", "5d", "1E2f", "9007199254740993", "99999999999999999999", "", ".5", "5.", ".", "+", "abc", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(tolerant_cast("t", "int", T.StringType()), tolerant_cast("t", "bigint", T.StringType())).collect()]
    whole = [3, 3, -2, 4, None, None, None, 9007199254740993, None, None, 0, 5, None, None, None, None]
    assert [g[1] for g in got] == whole
    assert [g[0] for g in got] == [w if w is None or abs(w) < 1 << 31 else None for w in whole]


def test_an_absent_required_column_is_an_error(spark):
    with pytest.raises(ValueError, match="business.*business_id"):
        clean(spark.createDataFrame([("n", 4.0)], "name string, stars double"), SPECS["business"])


def test_history_order_does_not_depend_on_the_input(spark):
    rows = [("N", "b", 2, "2018-12-31", y, 1) for y in (2019, 2018)]
    schema = "business_name string, business_id string, review_count_weekly long, review_week string, review_year int, review_week_number int"
    for r in (rows, rows[::-1]):
        got = analyses.business_history(spark.createDataFrame(r, schema), "N").collect()
        assert [x.review_year for x in got] == [2018, 2019]


def test_scratch_folders_can_be_removed(spark):
    path = scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).agg(F.count("*")).first()[0] == 3
    assert clear_scratch(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
