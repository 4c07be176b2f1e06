"""Conversions that must not depend on the session's zone, and values that must not be lost."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordflow.functions import casts, nested, timestamps as ts
from recordflow.operators import batches


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_wall_clock_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = ["2023-11-05 01:30:00.123456", "2023-03-12 02:30:00.000001", "1969-12-31 23:59:59.999999", "0001-01-01 00:00:00"]
        wall = spark.createDataFrame([(t,) for t in times], "t string").select("t", F.col("t").cast("timestamp_ntz").alias("x"))
        rows = wall.select("t", ts.to_micros(F.col("x")).alias("m"), ts.from_micros(ts.to_micros(F.col("x"))).cast("string").alias("back")).collect()
        assert [r.m for r in rows][:3] == [1_699_147_800_123_456, 1_678_588_200_000_001, -1]
        assert [r.back for r in rows] == [t if "." in t else t for t in times]
        one = spark.range(1).select(
            ts.parse_time(F.lit("01:00:00")).alias("a"), ts.cast_timestamp(F.lit("0")).cast("string").alias("b"),
            ts.cast_timestamp(F.lit("-1")).cast("string").alias("c"),
        ).first()
        assert (one.a, one.b, one.c) == (3_600_000_000, "1970-01-01 00:00:00", "1969-12-31 23:59:59.999")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("value, width", [(12345, 9), (-12345, 9), (-1, 16), (10**37, 16), (-(10**37), 16), (7, 20), (-7, 20), (10**38 - 1, 16), (0, 1)])
def test_wide_decimal_bytes(spark, value, width):
    raw = bytearray(value.to_bytes(width, "big", signed=True))
    frame = spark.createDataFrame([(raw,)], "b binary")
    assert frame.select(casts.decimal_from_bytes(F.col("b"), 2).alias("d")).first().d == Decimal(f"{value}E-2")


def test_decimal_bytes_beyond_38_digits_are_null(spark):
    frame = spark.createDataFrame([(bytearray((10**40).to_bytes(18, "big")),), (bytearray((1 << 126).to_bytes(16, "big")),)], "b binary")
    found = [r.d for r in frame.select(casts.decimal_from_bytes(F.col("b"), 0).alias("d")).collect()]
    assert found[0] is None and found[1] in (None, Decimal(1 << 126))


def test_inferred_names_keep_type_words(spark):
    rows = spark.createDataFrame([('{"PRODUCT_VARIANT": 1, "AVOID": "x", "VOID": null, "l": [null]}',)], "j string")
    out = nested.expand_nested(rows, "j").first().asDict()
    assert out["j_PRODUCT_VARIANT"] == 1 and out["j_AVOID"] == "x" and out["j_VOID"] is None
    blank = spark.createDataFrame([(None,), (None,)], "j string")
    assert nested.expand_nested(blank, "j").collect() == blank.collect()


def test_shared_folder_is_asked_for_beyond_local_masters():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        batches.shared_dir(Session())
