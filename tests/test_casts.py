import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from recordflow.functions import casts, nested, timestamps as ts, values


def one(spark, expr, **cols):
    """Value of an expression over a one-row table of the given columns."""
    types = {str: "string", int: "bigint", float: "double", bool: "boolean", bytes: "binary", bytearray: "binary",
             dt.datetime: "timestamp_ntz", type(None): "string"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in cols.items()) or "dummy int"
    row = tuple(cols.values()) or (1,)
    return spark.createDataFrame([row], schema).select(expr().alias("v")).first()["v"]


def text_case(spark, build, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r["v"] for r in rows.select("i", build(F.col("x")).alias("v")).orderBy("i").collect()]


def test_boolean_accepts_only_true_and_false(spark):
    assert text_case(spark, casts.to_boolean, "true", "FALSE", "t", "yes", "1", " true", None) == [True, False, None, None, None, None, None]


@pytest.mark.parametrize("type_name, good, bad", [
    ("tinyint", ["-128", "+127", "007"], ["128", " 1", "1.0", "", "1\n"]),
    ("smallint", ["-32768", "32767"], ["32768", "x"]),
    ("int", ["-2147483648", "2147483647"], ["2147483648", "1e3"]),
    ("bigint", ["-9223372036854775808", "9223372036854775807"], ["9223372036854775808", "1L"]),
])
def test_integers_from_text_are_range_checked(spark, type_name, good, bad):
    got = text_case(spark, lambda c: casts.to_integer(c, type_name), *good, *bad)
    assert got == [int(g) for g in good] + [None] * len(bad)


def test_numbers_wrap_to_byte_and_short(spark):
    rows = spark.createDataFrame([(300,), (-129,), (127,), (65535,)], "n bigint")
    got = rows.select(casts.wrap_integer(F.col("n"), 8), casts.wrap_integer(F.col("n"), 16)).collect()
    assert [tuple(r) for r in got] == [(44, 300), (127, -129), (127, 127), (-1, -1)]


def test_numbers_do_not_wrap_to_int(spark):
    assert one(spark, lambda: casts.int_from_number(F.col("x")), x=3000000000) is None
    assert one(spark, lambda: casts.int_from_number(F.col("x")), x=12.9) == 12


def test_floating_point_grammar(spark):
    got = text_case(spark, casts.to_double, "1.5", " 2e3 ", ".5", "5.", "1d", "-Infinity", "inf", "1,5", "", "--1", "nan")
    assert got == [1.5, 2000.0, 0.5, 5.0, 1.0, float("-inf"), None, None, None, None, None]
    assert str(text_case(spark, casts.to_double, "NaN")[0]) == "nan"


def test_float_keeps_what_a_float_can_hold(spark):
    # nineteen digits lose precision as a float
    assert text_case(spark, casts.to_float, "6981609001979330826")[0] == pytest.approx(6.981609e18, rel=1e-6)


def test_decimal_rounds_half_up_and_refuses_overflow(spark):
    got = text_case(spark, lambda c: casts.to_decimal(c, 4, 2), "1.535", "-1.535", "99.994", "99.995", "1e1", " 1")
    assert got == [Decimal("1.54"), Decimal("-1.54"), Decimal("99.99"), None, Decimal("10.00"), None]


def test_unbounded_whole_numbers(spark):
    assert text_case(spark, casts.to_bigint_unbounded, "9" * 38, "9" * 39, "1.0") == [Decimal("9" * 38), None, None]


def test_char_enum_varchar(spark):
    assert text_case(spark, casts.to_char, "abc", "") == ["a", None]
    assert text_case(spark, lambda c: casts.to_enum(c, ["A", "B"]), "A", "a") == ["A", None]
    assert text_case(spark, lambda c: casts.to_varchar(c, 3), "San Francisco", "SF") == ["San", "SF"]


def test_uuid(spark):
    u = "123e4567-e89b-12d3-a456-426614174000"
    assert text_case(spark, casts.to_uuid, u.upper(), "1-2-3-4-5", "x", u.replace("-", "")) == [
        u, "00000001-0002-0003-0004-000000000005", None, None]
    raw = bytes.fromhex(u.replace("-", ""))
    assert one(spark, lambda: casts.uuid_from_bytes(F.col("x")), x=bytearray(raw)) == u
    assert one(spark, lambda: casts.uuid_from_bytes(F.col("x")), x=bytearray(raw[:8])) is None
    assert bytes(one(spark, lambda: casts.uuid_to_bytes(F.col("x")), x=u)) == raw


def test_binary_encodings(spark):
    assert bytes(one(spark, lambda: casts.binary_decode(F.col("x"), "hex"), x="48690a")) == b"Hi\n"
    assert bytes(one(spark, lambda: casts.binary_decode(F.col("x"), "base64"), x="SGk=")) == b"Hi"
    assert bytes(one(spark, lambda: casts.binary_decode(F.col("x")), x="Hé")) == b"H?"
    assert one(spark, lambda: casts.binary_decode(F.col("x"), "hex"), x="abc") is None
    with pytest.raises(ValueError):
        casts.binary_decode(F.lit("x"), "rot13")


@pytest.mark.parametrize("raw, scale, want", [
    (b"\x01\x00", 2, "2.56"), (b"\xff\x00", 2, "-2.56"), (b"\x7f" + b"\xff" * 7, 0, "9223372036854775807"),
    (b"\x80" + b"\x00" * 7, 0, "-9223372036854775808"), (b"\x00", 3, "0.000"),
])
def test_bytes_to_decimal(spark, raw, scale, want):
    assert one(spark, lambda: casts.decimal_from_bytes(F.col("x"), scale), x=bytearray(raw)) == Decimal(want)


def test_strict_plus_rejects_is_the_input(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "x").otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    good, bad = casts.split_rejects(casts.convert(rows, {"a": "int", "k": "bigint"}, required=("k",)))
    assert good.count() + bad.count() == 1000
    assert bad.count() == sum(1 for i in range(1000) if i % 3 == 0 or i % 7 == 0)
    both = bad.filter(F.size("_rejects") == 2).first()["_rejects"]
    assert [(r["column"], r["reason"]) for r in both] == [("a", "not a valid int"), ("k", "must not be null")]


def test_soft_keeps_the_text(spark):
    rows = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    got = [tuple(r) for r in rows.select(*casts.soft_columns(F.col("a"), "int", "a")).collect()]
    assert got == [(1, None), (None, "x"), (None, None)]


def test_compatibility_differs_from_conversion(spark):
    assert text_case(spark, lambda c: casts.is_compatible(c, "double"), "1d", " 1", "1e5", "-.5") == [False, False, True, True]
    # the sign belongs to plain decimals only
    assert text_case(spark, lambda c: casts.is_compatible(c, "decimal(9,2)"), "-1.5", "-1e5", "1e5", "-.5", ".5") == [
        True, False, True, False, True]
    assert text_case(spark, lambda c: casts.is_compatible(c, "timestamp", "yyyy-MM-dd HH:mm:ss"), "2020-01-01 00:00:00", "20", None) == [
        True, False, False]


def test_union_picks_the_simplest_member(spark):
    members = ["string", "double", "int", "boolean"]
    assert text_case(spark, lambda c: casts.choose_type(c, members), "true", "1", "1.5", "x", None) == ["boolean", "int", "double", "string", None]
    rows = spark.createDataFrame([("1",), ("x",)], "x string")
    tags = rows.select(F.schema_of_variant(casts.choose_variant(F.col("x"), members)).alias("t")).collect()
    assert [r["t"] for r in tags] == ["BIGINT", "STRING"]


# ------------------------------------------------------------------ timestamps
def stamp(spark, text, pattern, hours=0):
    return one(spark, lambda: ts.cast_timestamp(F.col("x"), pattern, hours), x=text)


@pytest.mark.parametrize("text, pattern, want", [
    ("2012-06-25 15:04:16", "yyyy-MM-dd HH:mm:ss", dt.datetime(2012, 6, 25, 15, 4, 16)),
    ("2012-09-28 23:38:55.101", "yyyy-MM-dd HH:mm:ss.SSS", dt.datetime(2012, 9, 28, 23, 38, 55, 101000)),
    ("2012-12-05 01:25:49.164000", "yyyy-MM-dd HH:mm:ss.SSSSSS", dt.datetime(2012, 12, 5, 1, 25, 49, 164000)),
    (" 2012-06-25 15:04:16\t", "yyyy-MM-dd HH:mm:ss", dt.datetime(2012, 6, 25, 15, 4, 16)),
    ("20230101111111111", "yyyyMMddHHmmssSSS", dt.datetime(2023, 1, 1, 11, 11, 11, 111000)),
    ("1/2/2023 3:04", "d/M/yyyy H:mm", dt.datetime(2023, 2, 1, 3, 4)),
    ("2023-01-01T10:00", "yyyy-MM-dd'T'HH:mm", dt.datetime(2023, 1, 1, 10, 0)),
    ("05 Mar 2021 10:11", "dd MMM yyyy HH:mm", dt.datetime(2021, 3, 5, 10, 11)),
    ("23-01-01 10", "yy-MM-dd HH", dt.datetime(2023, 1, 1, 10)),
    ("1672571471111", "yyyy-MM-dd HH:mm:ss", dt.datetime(2023, 1, 1, 11, 11, 11, 111000)),
    ("2023-02-31 00:00:00", "yyyy-MM-dd HH:mm:ss", dt.datetime(2023, 2, 28)),
    # rejected
    ("2012-09-28 23:38:55.1", "yyyy-MM-dd HH:mm:ss.SSSSSS", None),
    ("2012-09-28 23:38:55.1234567", "yyyy-MM-dd HH:mm:ss.SSSSSS", None),
    ("2012-13-01 00:00:00", "yyyy-MM-dd HH:mm:ss", None),
    ("2012-01-32 00:00:00", "yyyy-MM-dd HH:mm:ss", None),
    ("1234abc", "yyyy-MM-dd HH:mm:ss", None),
    ("2023-01-01", "yyyy-MM-dd", None),          # a date alone is no timestamp
    ("", "yyyy-MM-dd HH:mm:ss", None),
    ("99999999999999999999", "yyyy-MM-dd HH:mm:ss", None),
])
def test_timestamp_patterns(spark, text, pattern, want):
    assert stamp(spark, text, pattern) == want


def test_hour_shift(spark):
    p = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    assert stamp(spark, "2023-01-01 11:11:11.111222", p, 9) == dt.datetime(2023, 1, 1, 20, 11, 11, 111222)
    # far beyond the range of milliseconds in an int, and backwards
    assert stamp(spark, "2023-01-01 00:00:00.000001", p, 1000) == dt.datetime(2023, 2, 11, 16, 0, 0, 1)
    assert stamp(spark, "1672531200000", p, -1) == dt.datetime(2022, 12, 31, 23)
    at = dt.datetime(2023, 1, 1, 11, 11, 11, 111222)
    assert one(spark, lambda: ts.add_hours(F.col("x"), 9), x=at) == at + dt.timedelta(hours=9)


def test_no_hidden_shift(spark):
    assert stamp(spark, "2023-01-01 00:00:00", "yyyy-MM-dd HH:mm:ss") == dt.datetime(2023, 1, 1)


def test_dates_have_their_own_default_and_no_shift(spark):
    assert one(spark, lambda: ts.cast_date(F.col("x")), x=" 2012-11-02 ") == dt.date(2012, 11, 2)
    assert one(spark, lambda: ts.cast_date(F.col("x"), "yyyyMMdd"), x="20230101") == dt.date(2023, 1, 1)
    assert one(spark, lambda: ts.cast_date(F.col("x"), None), x="86400000") == dt.date(1970, 1, 2)
    assert one(spark, lambda: ts.cast_date(F.col("x")), x="86400000") is None
    assert one(spark, lambda: ts.cast_date(F.col("x"), "yyyy-MM-dd HH:mm:ss"), x="2020-01-02 10:00:00") == dt.date(2020, 1, 2)


def test_time_of_day(spark):
    assert one(spark, lambda: ts.cast_time(F.col("x")), x="01:02:03") == 3723_000_000
    assert one(spark, lambda: ts.cast_time(F.col("x"), "HHmmss.SSS"), x="010203.004") == 3723_004_000
    assert one(spark, lambda: ts.cast_time(F.col("x")), x="25:00:00") is None


@pytest.mark.parametrize("pattern", ["", "yyyy-ww", "YYYY-MM-dd", "yyyy-MM-dd 'at", "yyyy-MM-dd j"])
def test_bad_patterns_fail_when_planned(pattern):
    with pytest.raises(ValueError):
        ts.check_pattern(pattern)


def test_pattern_document():
    doc = '{"formats":[{"column-name":"a","timestamp-pattern":"yyyy-MM-dd HH:mm:ss","type":"TIMESTAMP"}]}'
    assert ts.patterns_from_spec(doc) == {"a": "yyyy-MM-dd HH:mm:ss"}
    for broken in ('{"formats":', "[]", '{"formats":[{"pattern":"x"}]}', '{"formats":[{"column-name":"a","timestamp-pattern":"QQQ"}]}'):
        with pytest.raises(ValueError):
            ts.patterns_from_spec(broken)


def test_pattern_precedence(spark):
    assert ts.pattern_from_props({"column.all.pattern": "A", "column.x.pattern": "B"}, "x") == "A"
    assert ts.pattern_from_props({"column.x.pattern": "B"}, "x") == "B"
    assert ts.pattern_from_props(None, "x") == "yyyy-MM-dd HH:mm:ss"
    rows = spark.createDataFrame([("2020/01/02 03", "2020.01.02 03", "2020-01-02 03:00:00")], "a string, b string, c string")
    rows = rows.withMetadata("b", {"format": "yyyy.MM.dd HH"})
    out = ts.parse_timestamp_columns(rows, ["a", "b", "c"], {"a": "yyyy/MM/dd HH"}).first()
    assert out["a"] == out["b"] == out["c"] == dt.datetime(2020, 1, 2, 3)


def test_mixed_inputs_of_one_record(spark):
    row = ("20230101", "2023-01-01 11:11:11", "2023-01-01 11:11:11.123", "2023-01-01 11:11:11.123456", "1672571471111")
    rows = spark.createDataFrame([row], "d string, t0 string, t3 string, t6 string, ms string")
    out = ts.parse_timestamp_columns(rows, ["t0", "t3", "t6", "ms"], {"t3": "yyyy-MM-dd HH:mm:ss.SSS", "t6": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    r = out.select("*", ts.cast_date(F.col("d"), "yyyyMMdd").alias("day")).first()
    assert (r["t0"].microsecond, r["t3"].microsecond, r["t6"].microsecond, r["ms"].microsecond) == (0, 123000, 123456, 111000)
    assert r["day"] == dt.date(2023, 1, 1) and r["_rejects"] == []


@pytest.mark.parametrize("name, text, want", [
    ("BASIC_ISO_DATE", "20230131", dt.date(2023, 1, 31)), ("ISO_LOCAL_DATE", "2023-02-30", None),
    ("ISO_OFFSET_DATE", "2023-01-31+09:00", dt.date(2023, 1, 31)), ("ISO_DATE", "2023-01-31", dt.date(2023, 1, 31)),
    ("ISO_ORDINAL_DATE", "2024-366", dt.date(2024, 12, 31)), ("ISO_ORDINAL_DATE", "2023-366", None),
    ("ISO_WEEK_DATE", "2020-W53-5", dt.date(2021, 1, 1)), ("ISO_WEEK_DATE", "2021-W53-1", None),
    ("ISO_LOCAL_TIME", "10:15", 36900_000_000), ("ISO_OFFSET_TIME", "10:15:30.5+01:00", 36930_500_000),
    ("ISO_TIME", "10:15:30", 36930_000_000), ("ISO_LOCAL_DATE_TIME", "2023-01-31T10:15:30.123456", dt.datetime(2023, 1, 31, 10, 15, 30, 123456)),
    ("ISO_OFFSET_DATE_TIME", "2023-01-31T10:15:30+09:00", dt.datetime(2023, 1, 31, 10, 15, 30)),
    ("ISO_ZONED_DATE_TIME", "2023-01-31T10:15:30+09:00[Asia/Seoul]", dt.datetime(2023, 1, 31, 10, 15, 30)),
    ("ISO_DATE_TIME", "2023-01-31T10:15:30", dt.datetime(2023, 1, 31, 10, 15, 30)),
    ("ISO_INSTANT", "2023-01-31T10:15:30Z", dt.datetime(2023, 1, 31, 10, 15, 30)),
    ("RFC_1123_DATE_TIME", "Tue, 3 Jun 2008 11:05:30 GMT", dt.datetime(2008, 6, 3, 11, 5, 30)),
    ("RFC_1123_DATE_TIME", "Wed, 3 Jun 2008 11:05:30 GMT", None), ("yyyy/MM/dd HH", "2020/01/02 03", dt.datetime(2020, 1, 2, 3)),
])
def test_named_formats(spark, name, text, want):
    assert one(spark, lambda: ts.parse_named(F.col("x"), name), x=text) == want


def test_all_fifteen_names_are_known():
    assert len(ts.NAMED_FORMATS) == 15


# ---------------------------------------------------------------- small values
def test_unquote_and_empty(spark):
    assert text_case(spark, values.unquote, '"a"', '"', '""', 'a"', '"a') == ["a", '"', "", 'a"', '"a']
    assert text_case(spark, values.empty_to_null, '""', "", "x") == [None, None, "x"]
    assert text_case(spark, lambda c: values.empty_to_null(c, keep_quotes=True), '""', "") == ['""', None]


def test_sql_literals_are_safe(spark):
    assert one(spark, lambda: values.sql_literal(F.col("x"), T.StringType()), x="O'Neil") == "'O''Neil'"
    assert one(spark, lambda: values.sql_literal(F.col("x"), T.StringType()), x=None) == "NULL"
    assert one(spark, lambda: values.sql_literal(F.lit(None).cast("int"), T.IntegerType())) == "NULL"
    assert one(spark, lambda: values.sql_literal(F.col("x"), T.LongType()), x=5) == "5"


def test_statement_splitting(spark):
    assert one(spark, lambda: values.split_statements(F.col("x")), x="a; b\\;c ;;\n d") == ["a", "b;c", "d"]
    assert one(spark, lambda: values.split_statements(F.col("x")), x="  ") == []


@pytest.mark.parametrize("ms, want", [(0, "0초"), (61_000, "1분 1초"), (3_600_000, "1시간 0초"), (90_061_999, "25시간 1분 1초")])
def test_durations(spark, ms, want):
    assert one(spark, lambda: values.format_duration(F.col("x")), x=ms) == want


@pytest.mark.parametrize("n, want", [(0, "0 bytes"), (1024, "1,024 bytes"), (1536, "1.5 KB"), (5 << 40, "5 TB"), ((1 << 20) + 1, "1 MB")])
def test_sizes(spark, n, want):
    assert one(spark, lambda: values.format_data_size(F.col("x")), x=n) == want


def test_size_parsing(spark):
    assert text_case(spark, values.parse_data_size, "100 MB", "1.5kb", "7 B", "10", "x GB") == [100 << 20, 1536, 7, None, None]
    assert values.data_size_bytes("2 GB") == 2 << 30 and values.data_size_bytes("90%") is None


# ---------------------------------------------------------------------- nested
def test_byte_arrays(spark):
    assert one(spark, lambda: nested.to_byte_array(F.col("x"), T.StringType()), x="Aé") == [65, -61, -87]
    assert one(spark, lambda: nested.to_byte_array(F.col("x"), T.StringType()), x="") == []


def test_arrays_inside_unions_keep_pattern_and_shift(spark):
    rows = spark.createDataFrame([(["01/02/2020 03", None],)], "x array<string>")
    out = rows.select(nested.conform(F.col("x"), rows.schema["x"].dataType, T.ArrayType(T.TimestampNTZType()), "dd/MM/yyyy HH", 9).alias("v"))
    assert out.first()["v"] == [dt.datetime(2020, 2, 1, 12), None]


def test_inferred_nested_columns(spark):
    rows = spark.createDataFrame([('{"a": 1, "b": {"c": "x"}}',), ('{"a": 2.5, "d": [1]}',), ("broken",)], "p string")
    out = nested.expand_nested(rows, "p")
    assert out.columns == ["p_a", "p_b", "p_d"]
    assert [float(r["p_a"]) if r["p_a"] is not None else None for r in out.collect()] == [1.0, 2.5, None]


def test_record_rules(spark):
    have = "name string, codes array<string>"
    rows = spark.createDataFrame([(("a", ["1", "2"]),), ((None, ["1"]),), (("a", ["x"]),)], f"r struct<{have.replace(' ', ':').replace(',:', ',')}>")
    want = T.StructType([T.StructField("name", T.StringType(), False), T.StructField("codes", T.ArrayType(T.IntegerType()))])
    got = rows.select(nested.record_compatible(F.col("r"), rows.schema["r"].dataType, want).alias("v")).collect()
    assert [r["v"] for r in got] == [True, False, False]


def test_products_beyond_bigint_fit_nothing(spark):
    big = 2 ** 62
    rows = [(3, 4), (900_000, 120_000), (big, big), (-big, big), (big, 0), (0, big), (9, 1_000_000), (None, big), (big, None)]
    a, b = F.col("a"), F.col("b")
    got = spark.createDataFrame(rows, "a bigint, b bigint").select(
        casts.fits_exactly(a, "float", b), casts.fits_exactly(a, "double", b, 1000000000)).collect()
    want = [(None, None) if None in r else (abs(r[0] * r[1]) <= 2 ** 24, abs(r[0] * r[1] * 10 ** 9) <= 2 ** 53) for r in rows]
    assert [tuple(r) for r in got] == want
