"""Typed target rows from the record shapes of the fixtures."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from recordflow.functions.casts import split_rejects, to_text
from recordflow.operators.ingest import to_target_rows

TARGET = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType()), T.StructField("age", T.ShortType(), False),
    T.StructField("updated_at", T.TimestampNTZType(), False), T.StructField("score", T.DecimalType(9, 0)),
    T.StructField("airport_code", T.VarcharType(3)), T.StructField("sql_date", T.DateType()),
])
AT = dt.datetime(2023, 1, 1, 11, 11, 11, 111000)
SCHEMA = "id bigint, name string, age smallint, updated_at timestamp_ntz, score bigint, airport_code string, sql_date date"


def record(**changes):
    row = dict(id=1, name="foo", age=30, updated_at=AT, score=10000, airport_code="San Francisco", sql_date=dt.date(2023, 1, 1))
    return tuple({**row, **changes}.values())


def built(spark, schema=SCHEMA, hours=0, lowercase=False, **changes):
    return to_target_rows(spark.createDataFrame([record(**changes)], schema), TARGET, ["id"], hours=hours, lowercase=lowercase)


def test_a_whole_record(spark):
    r = built(spark, hours=9).first()
    assert (r["id"], r["age"], r["score"], r["airport_code"], r["sql_date"]) == (1, 30, Decimal(10000), "San", dt.date(2023, 1, 1))
    assert r["updated_at"] == dt.datetime(2023, 1, 1, 20, 11, 11, 111000) and r["_rejects"] == []


@pytest.mark.parametrize("changes, bad", [
    ({"id": None}, ["id"]), ({"age": None}, ["age"]), ({"updated_at": None}, ["updated_at"]), ({"name": None, "airport_code": None}, []),
    ({"id": None, "age": None}, ["id", "age"]), ({"score": 10 ** 12}, ["score"]),
])
def test_required_columns_and_overflow(spark, changes, bad):
    assert [e["column"] for e in built(spark, **changes).first()["_rejects"]] == bad


def test_case_of_names(spark):
    upper = SCHEMA.replace("id bigint", "ID bigint", 1)
    assert "id" not in built(spark, upper).columns
    assert built(spark, upper, lowercase=True).first()["id"] == 1


def test_text_records_with_patterns(spark):
    text = [("1409943961", "6981609001979330826", "2012-11-02", "2012-06-25 15:04:16", "2012-09-28 23:38:55.101", "2012-12-05 01:25:49.164000"),
            ("x", "1", "2012-11-31", "2012-06-25 15:04", "2012-09-28 23:38:55.1", " ")]
    df = spark.createDataFrame(text, "col_int string, col_float string, col_date string, t0 string, t3 string, t6 string").withColumn("seq", F.lit(1))
    n = T.TimestampNTZType()
    target = T.StructType([T.StructField("col_int", T.IntegerType(), False), T.StructField("col_float", T.FloatType()), T.StructField("col_date", T.DateType()),
                           T.StructField("t0", n), T.StructField("t3", n), T.StructField("t6", n)])
    out = to_target_rows(df, target, ["col_int"], {"t3": "yyyy-MM-dd HH:mm:ss.SSS", "t6": "yyyy-MM-dd HH:mm:ss.SSSSSS"}, hours=9, order=["seq"])
    good, bad = split_rejects(out)
    r = good.first()
    assert r["col_int"] == 1409943961 and r["col_date"] == dt.date(2012, 11, 2) and r["seq"] == 1
    assert (r["t0"], r["t3"], r["t6"]) == (dt.datetime(2012, 6, 26, 0, 4, 16), dt.datetime(2012, 9, 29, 8, 38, 55, 101000), dt.datetime(2012, 12, 5, 10, 25, 49, 164000))
    # November has no 31st: the last day is meant; blank is null; the others are refused
    assert [e["column"] for e in bad.first()["_rejects"]] == ["col_int", "t0", "t3"] and bad.first()["col_date"] == dt.date(2012, 11, 30)


def test_blank_required_timestamp_is_a_null(spark):
    df = spark.createDataFrame([("  ",)], "t string")
    target = T.StructType([T.StructField("t", T.TimestampNTZType(), False)])
    assert [e["reason"] for e in to_target_rows(df, target).first()["_rejects"]] == ["must not be null"]


def test_epoch_millis_numbers_become_timestamps(spark):
    df = spark.createDataFrame([(1672571471111,)], "t bigint")
    target = T.StructType([T.StructField("t", T.TimestampNTZType())])
    assert to_target_rows(df, target, hours=9).first()["t"] == AT + dt.timedelta(hours=9)


def test_byte_arrays_are_text(spark):
    df = spark.createDataFrame([([72, -61, -87],), ([],)], "b array<tinyint>")
    assert [r[0] for r in df.select(to_text(F.col("b"), df.schema["b"].dataType)).collect()] == ["Hé", ""]
