"""Scalar conversion queries: table columns rendered as text, some of it spoilt, and converted back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.functions import casts, nested, timestamps as ts, values
from recordflow.plans.registry import query, table
from recordflow.sources import jdbc

INT = "'[+-]?[0-9]+'"


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _checked(df: DataFrame, key: str, text: Column, value: Column, name: str = "value") -> DataFrame:
    """(key, text, value, rejected) of a conversion."""
    rows = df.select(F.col(key), text.alias("text"))
    return rows.select(
        key, "text", value.alias(name), (F.col("text").isNotNull() & value.isNull()).alias("rejected")
    )



# ------------------------------------------------------------------ boolean
_BOOL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'TRUE' WHEN '2-HIGH' THEN 'false' WHEN '3-MEDIUM' THEN 'yes'
  WHEN '4-NOT SPECIFIED' THEN ' true' ELSE o_orderstatus END"""


@query("cast_boolean", f"""
SELECT o_orderkey, text, CASE WHEN lower(text) = 'true' THEN TRUE WHEN lower(text) = 'false' THEN FALSE END AS value,
  lower(text) NOT IN ('true', 'false') AS rejected
FROM (SELECT o_orderkey, {_BOOL} AS text FROM orders)""")
def cast_boolean(spark, sf_dir):
    return _checked(_orders(spark, sf_dir), "o_orderkey", F.expr(_BOOL), casts.to_boolean(F.col("text")))


# ----------------------------------------------------------- small integers
_SIGNED = """CASE o_orderstatus WHEN 'O' THEN concat('+', CAST(o_custkey AS {s}))
  WHEN 'F' THEN concat('-', CAST(o_custkey AS {s})) ELSE concat(CAST(o_custkey AS {s}), ' ') END"""
_SIGNED_NUMBER = "CASE o_orderstatus WHEN 'F' THEN -o_custkey * 37 ELSE o_custkey * 37 END"


def _small(type_name: str, bits: int):
    def run(spark, sf_dir):
        rows = _orders(spark, sf_dir).select(
            "o_orderkey", F.expr(_SIGNED.format(s="STRING")).alias("text"), F.expr(_SIGNED_NUMBER).alias("number")
        )
        return rows.select(
            "o_orderkey", "text", casts.to_integer(F.col("text"), type_name).cast("int").alias("value"),
            casts.wrap_integer(F.col("number"), bits).cast("int").alias("wrapped"),
        )

    return run


def _small_sql(duck: str, bits: int) -> str:
    full, half = 1 << bits, 1 << (bits - 1)
    return f"""
SELECT o_orderkey, text,
  CAST(CASE WHEN regexp_full_match(text, {INT}) THEN TRY_CAST(replace(text, '+', '') AS {duck}) END AS INTEGER) AS value,
  CAST((((number % {full}) + {full} + {half}) % {full}) - {half} AS INTEGER) AS wrapped
FROM (SELECT o_orderkey, {_SIGNED.format(s="VARCHAR")} AS text, {_SIGNED_NUMBER} AS number FROM orders)"""


query("cast_byte", _small_sql("TINYINT", 8))(_small("tinyint", 8))
query("cast_short", _small_sql("SMALLINT", 16))(_small("smallint", 16))


# -------------------------------------------------------------- int and long
_BIG_INT = "CASE o_orderstatus WHEN 'P' THEN CAST(o_orderkey AS {s}) ELSE concat(CAST(o_orderkey AS {s}), '00000{x}') END"


@query("cast_int", f"""
SELECT o_orderkey, text, CASE WHEN regexp_full_match(text, {INT}) THEN TRY_CAST(text AS INTEGER) END AS value,
  CASE WHEN abs(trunc(o_totalprice * 10000)) <= 2147483647 THEN CAST(trunc(o_totalprice * 10000) AS INTEGER) END AS from_number
FROM (SELECT *, {_BIG_INT.format(s="VARCHAR", x="0")} AS text FROM orders)""")
def cast_int(spark, sf_dir):
    return _orders(spark, sf_dir).withColumn("text", F.expr(_BIG_INT.format(s="STRING", x="0"))).select(
        "o_orderkey", "text", casts.to_integer(F.col("text")).alias("value"),
        casts.int_from_number(F.col("o_totalprice") * 10000).alias("from_number"),
    )


@query("cast_long", f"""
SELECT o_orderkey, text, CASE WHEN regexp_full_match(text, {INT}) THEN TRY_CAST(text AS BIGINT) END AS value,
  epoch_ms(o_orderdate) AS date_millis
FROM (SELECT *, {_BIG_INT.format(s="VARCHAR", x="0000000000000")} AS text FROM orders)""")
def cast_long(spark, sf_dir):
    return _orders(spark, sf_dir).withColumn("text", F.expr(_BIG_INT.format(s="STRING", x="0000000000000"))).select(
        "o_orderkey", "text", casts.to_integer(F.col("text"), "bigint").alias("value"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("date_millis"),
    )


_HUGE = """CASE o_orderstatus WHEN 'P' THEN concat('-', CAST(o_orderkey + 1 AS {s}), '000000000000000000000000')
  WHEN 'O' THEN concat(CAST(o_orderkey AS {s}), '.5') ELSE concat(CAST(o_orderkey + 1 AS {s}), repeat('7', 36)) END"""


@query("cast_bigint", f"""
SELECT o_orderkey, text,
  CAST(CASE WHEN regexp_full_match(text, {INT}) THEN TRY_CAST(text AS DECIMAL(38,0)) END AS VARCHAR) AS value
FROM (SELECT *, {_HUGE.format(s="VARCHAR")} AS text FROM orders)""")
def cast_bigint(spark, sf_dir):
    return _orders(spark, sf_dir).withColumn("text", F.expr(_HUGE.format(s="STRING"))).select(
        "o_orderkey", "text", casts.to_bigint_unbounded(F.col("text")).cast("string").alias("value")
    )


# ------------------------------------------------------------ floating point
_FLOAT = """CASE l_returnflag WHEN 'A' THEN concat(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {s}), 'E1')
  WHEN 'R' THEN CASE l_linestatus WHEN 'O' THEN concat(' ', CAST(CAST(l_quantity AS DECIMAL(18,1)) AS {s}), 'd ') ELSE 'nan' END
  ELSE CASE WHEN l_linenumber < 3 THEN '-Infinity' WHEN l_linenumber < 5 THEN 'NaN'
       WHEN l_linenumber < 6 THEN concat('.', CAST(l_suppkey AS {s})) ELSE concat(CAST(l_suppkey AS {s}), '..1') END END"""
_LINE_ID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _floating(type_name: str):
    def run(spark, sf_dir):
        rows = _lines(spark, sf_dir).withColumn("text", F.expr(_FLOAT.format(s="STRING")))
        v = casts.to_double(F.col("text"), type_name).cast("double")
        finite = ~F.isnan(v) & (F.abs(v) < float("inf"))
        return rows.select(
            *_LINE_ID, "text", F.when(finite, v).alias("value"),
            F.when(v.isNull(), "rejected").when(F.isnan(v), "nan").when(finite, "finite").otherwise("infinite").alias("kind"),
            casts.is_compatible(F.col("text"), type_name).alias("compatible"),
        )

    return run


def _floating_sql(duck: str) -> str:
    return f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, text,
  CASE WHEN v IS NOT NULL AND NOT isnan(v) AND NOT isinf(v) THEN v END AS value,
  CASE WHEN v IS NULL THEN 'rejected' WHEN isnan(v) THEN 'nan' WHEN isinf(v) THEN 'infinite' ELSE 'finite' END AS kind,
  regexp_full_match(text, '[+-]?(Infinity|NaN|[0-9]+(\\.[0-9]*)?([eE][+-]?[0-9]+)?|\\.[0-9]+([eE][+-]?[0-9]+)?)') AS compatible
FROM (SELECT *, CAST(CASE
    WHEN regexp_full_match(trim(text), '[+-]?(NaN|Infinity|([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)')
    THEN TRY_CAST(regexp_replace(trim(text), '[dDfF]$', '') AS {duck}) END AS DOUBLE) AS v
  FROM (SELECT *, {_FLOAT.format(s="VARCHAR")} AS text FROM lineitem))"""


query("cast_double", _floating_sql("DOUBLE"))(_floating("double"))
query("cast_float", _floating_sql("FLOAT"))(_floating("float"))


# ------------------------------------------------------------------- decimal
_DEC = """CASE l_returnflag WHEN 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS {s})
  WHEN 'R' THEN concat('-', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,3)) AS {s}))
  ELSE CASE l_linestatus WHEN 'F' THEN concat(CAST(l_orderkey AS {s}), 'e2') ELSE '1,5' END END"""


@query("cast_decimal", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, text,
  CAST(CASE WHEN regexp_full_match(text, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
    THEN TRY_CAST(text AS DECIMAL(7,2)) END AS VARCHAR) AS value
FROM (SELECT *, {_DEC.format(s="VARCHAR")} AS text FROM lineitem)""")
def cast_decimal(spark, sf_dir):
    return _lines(spark, sf_dir).withColumn("text", F.expr(_DEC.format(s="STRING"))).select(
        *_LINE_ID, "text", casts.to_decimal(F.col("text"), 7, 2).cast("string").alias("value")
    )


# ---------------------------------------------------------------------- text
@query("cast_char", """
SELECT doc_id, CASE WHEN length(text) > 0 THEN substr(text, 1, 1) END AS first_char,
  CASE WHEN lang <> 'en' THEN substr(lang, 1, 1) END AS lang_char
FROM documents""")
def cast_char(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lang = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return docs.select("doc_id", casts.to_char(F.col("text")).alias("first_char"), casts.to_char(lang).alias("lang_char"))


@query("cast_enum", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type END AS symbol,
  event_type NOT IN ('click', 'view', 'purchase') AS rejected FROM events""")
def cast_enum(spark, sf_dir):
    v = casts.to_enum(F.col("event_type"), ["click", "view", "purchase"])
    return table(spark, sf_dir, "events").select("event_id", v.alias("symbol"), v.isNull().alias("rejected"))


_UUID = "md5(CAST(event_id AS {s}))"
_UUID_TEXT = """CASE event_type WHEN 'error' THEN substr(h, 1, 30) WHEN 'view' THEN h ELSE
  upper(concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12))) END"""


@query("cast_uuid", f"""
SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN
    concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12)) END AS value,
  concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12)) AS from_bytes,
  CASE WHEN event_type NOT IN ('error', 'view') THEN upper(h) END AS as_bytes
FROM (SELECT *, {_UUID.format(s="VARCHAR")} AS h FROM events)""")
def cast_uuid(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("h", F.expr(_UUID.format(s="STRING"))).withColumn("t", F.expr(_UUID_TEXT))
    return rows.select(
        "event_id", casts.to_uuid(F.col("t")).alias("value"), casts.uuid_from_bytes(F.unhex("h")).alias("from_bytes"),
        F.hex(casts.uuid_to_bytes(F.col("t"))).alias("as_bytes"),
    )


@query("cast_string", """
SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') AS by_pattern, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS as_millis,
  event_type AS decoded, concat('[', event_type, ', ', props, ']') AS list_text
FROM events""")
def cast_string(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ntz = T.TimestampNTZType()
    return e.select(
        "event_id", casts.to_text(F.col("ts"), ntz, "yyyy/MM/dd HH:mm:ss").alias("by_pattern"),
        casts.to_text(F.col("ts"), ntz).alias("as_millis"),
        casts.to_text(F.encode("event_type", "UTF-8"), T.BinaryType()).alias("decoded"),
        casts.to_text(F.array("event_type", "props"), T.ArrayType(T.StringType())).alias("list_text"),
    )


@query("cast_varchar", "SELECT doc_id, substr(text, 1, 3) AS v3, substr(source, 1, 40) AS v40 FROM documents")
def cast_varchar(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", casts.to_varchar(F.col("text"), 3).alias("v3"), casts.to_varchar(F.col("source"), 40).alias("v40")
    )


@query("cast_binary", "SELECT doc_id, hex(encode(text)) AS bytes_hex, octet_length(encode(text)) AS n_bytes FROM documents")
def cast_binary(spark, sf_dir):
    b = casts.to_binary(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.hex(b).alias("bytes_hex"), F.octet_length(b).cast("bigint").alias("n_bytes")
    )


@query("binary_decode", """
SELECT event_id, hex(encode(event_type)) AS from_ascii, hex(encode(props)) AS from_hex, hex(encode(props)) AS from_base64,
  CAST(NULL AS VARCHAR) AS bad_hex
FROM events""")
def binary_decode(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", F.hex(casts.binary_decode(F.col("event_type"))).alias("from_ascii"),
        F.hex(casts.binary_decode(F.hex(F.encode("props", "UTF-8")), "hex")).alias("from_hex"),
        F.hex(casts.binary_decode(F.base64(F.encode("props", "UTF-8")), "base64")).alias("from_base64"),
        F.hex(casts.binary_decode(F.concat("event_type", F.lit("zz")), "hex")).alias("bad_hex"),
    )


# ------------------------------------------------------------ dates and times
@query("cast_date", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS by_pattern,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS by_compact, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS by_millis
FROM orders""")
def cast_date(spark, sf_dir):
    o = _orders(spark, sf_dir)
    d = F.col("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "O", F.date_format(d, "dd/MM/yyyy")).otherwise(
        F.concat(F.lit("  "), F.date_format(d, "yyyy-MM-dd"), F.lit(" ")))
    return o.select(
        "o_orderkey", ts.cast_date(text).cast("string").alias("by_pattern"),
        ts.cast_date(F.date_format(d, "yyyyMMdd"), "yyyyMMdd").cast("string").alias("by_compact"),
        ts.cast_date(F.unix_millis(d.cast("timestamp")).cast("string"), None).cast("string").alias("by_millis"),
    )


@query("cast_time", """
SELECT event_id, (epoch_us(ts) // 1000000 * 1000000) % 86400000000 AS by_pattern,
  (epoch_us(ts) // 1000 * 1000) % 86400000000 AS by_millis_pattern,
  (epoch_us(ts) // 1000 * 1000) % 86400000000 AS by_epoch, CAST(NULL AS BIGINT) AS bad
FROM events""")
def cast_time(spark, sf_dir):
    e, t = table(spark, sf_dir, "events"), F.col("ts")
    return e.select(
        "event_id", ts.cast_time(F.date_format(t, "HH:mm:ss")).alias("by_pattern"),
        ts.cast_time(F.date_format(t, "HH:mm:ss.SSS"), "HH:mm:ss.SSS").alias("by_millis_pattern"),
        ts.cast_time(F.unix_millis(t.cast("timestamp")).cast("string"), None).alias("by_epoch"),
        ts.cast_time(F.date_format(t, "HH:mm")).alias("bad"),
    )


_TS_MIX = """CASE event_type WHEN 'click' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')
  WHEN 'view' THEN concat('  ', CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING)) WHEN 'signup' THEN '   '
  WHEN 'error' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') ELSE concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), 'x') END"""


@query("cast_timestamp", """
SELECT event_id, CASE event_type WHEN 'click' THEN ts WHEN 'view' THEN date_trunc('milliseconds', ts) END AS value,
  CASE event_type WHEN 'click' THEN ts + INTERVAL 9 HOUR WHEN 'view' THEN date_trunc('milliseconds', ts) + INTERVAL 9 HOUR END AS shifted,
  date_trunc('milliseconds', ts) AS compact, event_type IN ('error', 'purchase') AS rejected
FROM events""")
def cast_timestamp(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("text", F.expr(_TS_MIX))
    p = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    v = ts.cast_timestamp(F.col("text"), p)
    return e.select(
        "event_id", v.alias("value"), ts.cast_timestamp(F.col("text"), p, 9).alias("shifted"),
        ts.cast_timestamp(F.date_format("ts", "yyyyMMddHHmmssSSS"), "yyyyMMddHHmmssSSS").alias("compact"),
        (v.isNull() & ~ts.is_blank(F.col("text"))).alias("rejected"),
    )


_SPEC = """{"formats": [
  {"column-name": "ship", "timestamp-pattern": "yyyyMMdd HHmmss", "type": "TIMESTAMP"},
  {"column-name": "micro", "timestamp-pattern": "dd.MM.yyyy HH:mm:ss.SSSSSS", "type": "TIMESTAMP_MICROS"}]}"""


def _three_texts(spark, sf_dir) -> DataFrame:
    t = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(t, "yyyyMMdd HHmmss").alias("ship"),
        F.date_format(t, "dd.MM.yyyy HH:mm:ss.SSSSSS").alias("micro"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss")).alias("plain"),
    )


@query("parse_timestamps_by_spec", """
SELECT event_id, date_trunc('second', ts) - INTERVAL 3 HOUR AS ship, ts - INTERVAL 3 HOUR AS micro,
  CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) - INTERVAL 3 HOUR END AS plain,
  CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS n_rejects,
  CASE WHEN event_type = 'error' THEN 'plain' END AS reject_column
FROM events""")
def parse_timestamps_by_spec(spark, sf_dir):
    out = ts.parse_timestamp_columns(
        _three_texts(spark, sf_dir), ["ship", "micro", "plain"], ts.patterns_from_spec(_SPEC), hours=-3
    )
    r = F.col(casts.REJECTS)
    return out.select("event_id", "ship", "micro", "plain", F.size(r).alias("n_rejects"),
                      F.get(r, F.lit(0))["column"].alias("reject_column"))


@query("parse_timestamps_by_props", """
SELECT event_id, date_trunc('second', ts) AS ship, ts AS micro,
  CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS plain, CAST(NULL AS TIMESTAMP) AS all_pattern_plain
FROM events""")
def parse_timestamps_by_props(spark, sf_dir):
    props = {"column.ship.pattern": "yyyyMMdd HHmmss", "column.micro.pattern": "dd.MM.yyyy HH:mm:ss.SSSSSS"}
    texts = _three_texts(spark, sf_dir).withColumn("all_pattern_plain", F.col("plain"))
    out = ts.parse_timestamp_columns(texts, ["ship", "micro", "plain"], props=props)
    out = ts.parse_timestamp_columns(
        out, ["all_pattern_plain"], props={"column.all.pattern": "yyyyMMdd", "column.all_pattern_plain.pattern": "yyyy"}
    )
    return out.select("event_id", "ship", "micro", "plain", "all_pattern_plain")


@query("add_hours", """
SELECT event_id, ts + INTERVAL 9 HOUR AS later, ts - INTERVAL 700 HOUR AS earlier, ts AS same FROM events""")
def add_hours(spark, sf_dir):
    t = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", ts.add_hours(t, 9).alias("later"), ts.add_hours(t, -700).alias("earlier"), ts.add_hours(t, 0).alias("same")
    )


@query("named_datetime_format", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS basic_iso, CAST(CAST(ts AS DATE) AS VARCHAR) AS iso_date,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS ordinal, CAST(CAST(ts AS DATE) AS VARCHAR) AS week_date,
  epoch_us(ts) % 86400000000 AS iso_time, ts AS iso_date_time, ts AS iso_instant, date_trunc('second', ts) AS rfc_1123
FROM events""")
def named_datetime_format(spark, sf_dir):
    e, t = table(spark, sf_dir, "events"), F.col("ts")
    week = F.concat(F.date_format(F.date_add(t.cast("date"), 3 - F.weekday(t)), "yyyy"), F.lit("-W"),
                    F.lpad(F.weekofyear(t).cast("string"), 2, "0"), F.lit("-"), (F.weekday(t) + 1).cast("string"))
    iso = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return e.select(
        "event_id",
        ts.parse_named(F.date_format(t, "yyyyMMdd"), "BASIC_ISO_DATE").cast("string").alias("basic_iso"),
        ts.parse_named(F.date_format(t, "yyyy-MM-dd'+02:00'"), "ISO_DATE").cast("string").alias("iso_date"),
        ts.parse_named(F.date_format(t, "yyyy-DDD"), "ISO_ORDINAL_DATE").cast("string").alias("ordinal"),
        ts.parse_named(week, "ISO_WEEK_DATE").cast("string").alias("week_date"),
        ts.parse_named(F.date_format(t, "HH:mm:ss.SSSSSS"), "ISO_LOCAL_TIME").alias("iso_time"),
        ts.parse_named(iso, "ISO_DATE_TIME").alias("iso_date_time"),
        ts.parse_named(F.concat(iso, F.lit("Z")), "ISO_INSTANT").alias("iso_instant"),
        ts.parse_named(F.date_format(t, "E, d MMM yyyy HH:mm:ss 'GMT'"), "RFC_1123_DATE_TIME").alias("rfc_1123"),
    )


@query("micros_roundtrip", """
SELECT event_id, epoch_us(ts) AS micros, ts AS back, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || 'Z' AS text FROM events""")
def micros_roundtrip(spark, sf_dir):
    t = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", ts.to_micros(t).alias("micros"), ts.from_micros(ts.to_micros(t)).alias("back"), ts.micros_text(t).alias("text")
    )


@query("local_date_to_utc", """
SELECT o_orderkey, date_trunc('day', o_orderdate) AS utc_midnight FROM orders""")
def local_date_to_utc(spark, sf_dir):
    # the stored instant of local midnight in Seoul, nine hours before midnight in UTC
    local = F.to_utc_timestamp(F.col("o_orderdate").cast("timestamp"), "Asia/Seoul")
    return _orders(spark, sf_dir).select(
        "o_orderkey", ts.local_date_to_utc(local, "Asia/Seoul").cast("timestamp_ntz").alias("utc_midnight")
    )


# -------------------------------------------------------------- type choices
_MIXED = """CASE l_returnflag WHEN 'A' THEN CAST(l_partkey * 40 AS {s}) WHEN 'R' THEN
    CASE l_linestatus WHEN 'F' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {s}) ELSE 'false' END
  ELSE CASE l_linestatus WHEN 'F' THEN concat(CAST(l_orderkey + 1 AS {s}), '000000000') ELSE concat('#', CAST(l_suppkey AS {s})) END END"""


@query("is_compatible", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, lower(text) IN ('true', 'false') AS as_boolean,
  regexp_full_match(text, {INT}) AND TRY_CAST(text AS SMALLINT) IS NOT NULL AS as_short,
  regexp_full_match(text, {INT}) AND TRY_CAST(text AS INTEGER) IS NOT NULL AS as_int,
  regexp_full_match(text, {INT}) AND TRY_CAST(text AS BIGINT) IS NOT NULL AS as_long,
  regexp_full_match(text, '[+-]?[0-9]+(\\.[0-9]*)?') AS as_double, regexp_full_match(text, '[+-]?[0-9]+(\\.[0-9]*)?') AS as_decimal,
  length(text) > 0 AS as_char, regexp_full_match(text, '[0-9]+') AS as_date
FROM (SELECT *, {_MIXED.format(s="VARCHAR")} AS text FROM lineitem)""")
def is_compatible(spark, sf_dir):
    names = {"as_boolean": "boolean", "as_short": "smallint", "as_int": "int", "as_long": "bigint", "as_double": "double",
             "as_decimal": "decimal(10,2)", "as_char": "char", "as_date": "date"}
    rows = _lines(spark, sf_dir).withColumn("text", F.expr(_MIXED.format(s="STRING")))
    return rows.select(*_LINE_ID, *[casts.is_compatible(F.col("text"), t).alias(n) for n, t in names.items()])


@query("fits_exactly", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, n BETWEEN -16777216 AND 16777216 AS in_float,
  n * 1000000000 BETWEEN -9007199254740992 AND 9007199254740992 AS in_double,
  l_extendedprice * 1e34 <= 3.4028234663852886e38 AS double_in_float_range
FROM (SELECT *, l_orderkey * l_partkey AS n FROM lineitem)""")
def fits_exactly(spark, sf_dir):
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    return _lines(spark, sf_dir).select(
        *_LINE_ID, casts.fits_exactly(order, "float", part).alias("in_float"),
        casts.fits_exactly(order, "double", part, 1000000000).alias("in_double"),
        casts.within_float_range(F.col("l_extendedprice") * F.lit(1e34)).alias("double_in_float_range"),
    )


@query("choose_type", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, text,
  CASE WHEN lower(text) IN ('true', 'false') THEN 'boolean'
    WHEN regexp_full_match(text, {INT}) AND TRY_CAST(text AS SMALLINT) IS NOT NULL THEN 'smallint'
    WHEN regexp_full_match(text, {INT}) AND TRY_CAST(text AS BIGINT) IS NOT NULL THEN 'bigint'
    WHEN regexp_full_match(text, '[+-]?[0-9]+(\\.[0-9]*)?') THEN 'double' ELSE 'string' END AS chosen
FROM (SELECT *, {_MIXED.format(s="VARCHAR")} AS text FROM lineitem)""")
def choose_type(spark, sf_dir):
    rows = _lines(spark, sf_dir).withColumn("text", F.expr(_MIXED.format(s="STRING")))
    return rows.select(*_LINE_ID, "text", casts.choose_type(F.col("text"), ["string", "double", "bigint", "smallint", "boolean"]).alias("chosen"))


# ------------------------------------------------------------------- nested
@query("infer_nested_column", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events""")
def infer_nested_column(spark, sf_dir):
    return nested.expand_nested(table(spark, sf_dir, "events").select("event_id", "event_type", "props"), "props")


@query("to_array", """
SELECT vec_id, len(embedding) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value,
  4 AS n_bytes, ascii(substr(CAST(label + 1000 AS VARCHAR), 4, 1)) AS last_byte
FROM embeddings""")
def to_array(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    text = (F.col("label") + 1000).cast("string")
    cells = nested.to_byte_array(text, T.StringType())
    floats = nested.json_to_array(F.to_json("embedding"), "float")
    return e.select(
        "vec_id", F.size(floats).cast("bigint").alias("n"), F.round(F.get(floats, F.lit(0)).cast("double"), 6).alias("first_value"),
        F.size(cells).alias("n_bytes"), F.get(cells, F.lit(3)).cast("int").alias("last_byte"),
    )


@query("to_map", """
SELECT c_custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, 2 AS n_keys,
  '{"c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS deep
FROM customer""")
def to_map(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    flat = F.struct("c_name", "c_nationkey")
    deep = F.struct(F.col("c_name"), F.struct("c_nationkey", "c_mktsegment").alias("where"))
    rows = c.select("c_custkey", flat.alias("s"), deep.alias("d"))
    m = nested.to_map(F.col("s"), rows.schema["s"].dataType)
    return rows.select(
        "c_custkey", m["c_name"].alias("name"), m["c_nationkey"].alias("nation"), F.size(m).alias("n_keys"),
        nested.deep_to_map(F.col("d"), rows.schema["d"].dataType)["where"].alias("deep"),
    )


@query("to_record", """
SELECT c_custkey, c_nationkey AS nation, c_name AS name, CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_acctbal AS DOUBLE) END AS balance,
  CAST(NULL AS VARCHAR) AS absent,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'r.balance: not a valid double: about ' || CAST(c_nationkey AS VARCHAR) END AS rejected FROM customer""")
def to_record(spark, sf_dir):
    schema = T.StructType([T.StructField("nation", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("balance", T.DoubleType()), T.StructField("absent", T.StringType())])
    m = F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("name"), F.col("c_name"),
                     F.lit("balance"), F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("about "), F.col("c_nationkey").cast("string")))
                     .otherwise(F.col("c_acctbal").cast("string")), F.lit("other"), F.lit("x"))
    rows = casts.evaluate_once(table(spark, sf_dir, "customer"), {"r": nested.to_record_checked(m, schema, "r")})
    return rows.select("c_custkey", "r.value.nation", "r.value.name", "r.value.balance", "r.value.absent", _reject_text(F.col("r.rejects")).alias("rejected"))


def _reject_text(entries):
    return F.nullif(F.array_join(F.transform(entries, lambda e: F.concat_ws(": ", e["column"], e["reason"], e["value"])), "; "), F.lit(""))


@query("record_compatible", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN FALSE ELSE TRUE END AS fits, FALSE AS fits_strict,
  TRUE AS fits_loose FROM customer""")
def record_compatible(spark, sf_dir):
    text = F.when(F.col("c_mktsegment") == "MACHINERY", "n/a").otherwise(F.col("c_nationkey").cast("string"))
    rec = F.struct(F.col("c_name").alias("name"), text.alias("nation"), F.array(text).alias("codes"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", rec.alias("r"))
    want = T.StructType([T.StructField("name", T.StringType(), False), T.StructField("nation", T.IntegerType()),
                         T.StructField("note", T.StringType(), True)])
    loose = T.StructType([T.StructField("name", T.StringType(), False)])
    have = rows.schema["r"].dataType
    return rows.select(
        "c_custkey", nested.record_compatible(F.col("r"), have, want).alias("fits"),
        nested.record_compatible(F.col("r"), have, want, strict=True).alias("fits_strict"),
        nested.record_compatible(F.col("r"), have, loose).alias("fits_loose"),
    )


@query("conform_to_schema", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,1)) AS VARCHAR) AS price_text,
  o_orderdate + INTERVAL 9 HOUR AS placed, CASE WHEN o_orderstatus IN ('O', 'F') THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS INTEGER) END AS customer_id, 'none' AS note, CAST(o_custkey AS VARCHAR) AS map_cust,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS BIGINT) END AS list_second,
  nullif(concat_ws('; ', CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'status: not a valid string: ' || o_orderstatus END,
    CASE WHEN o_orderkey % 7 = 0 THEN 'customer.id: not a valid int: bad ' || CAST(o_custkey AS VARCHAR) END,
    CASE WHEN o_orderkey % 5 = 0 THEN 'ids[1]: not a valid bigint: x' || CAST(o_custkey AS VARCHAR) END), '') AS rejected
FROM orders""")
def conform_to_schema(spark, sf_dir):
    key = F.col("o_custkey").cast("string")
    rows = _orders(spark, sf_dir).select(
        "o_orderkey", F.col("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("placed"), F.col("o_orderstatus").alias("status"),
        F.struct(F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("bad "), key)).otherwise(key).alias("id"), F.lit("x").alias("dropped")).alias("customer"),
        F.struct(F.col("o_custkey").alias("cust")).alias("attributes"),
        F.array(F.lit("1"), F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("x"), key)).otherwise(key)).alias("ids"),
    )
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("price", T.DecimalType(18, 1)),
        T.StructField("placed", T.TimestampNTZType()), T.StructField("status", T.StringType(), True, {"symbols": ["O", "F"]}),
        T.StructField("customer", T.StructType([T.StructField("id", T.IntegerType())])),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("note", T.StringType(), True, {"default": "none"}),
    ])
    out = nested.conform_to_schema(rows, schema, hours=9)
    return out.select(
        "o_orderkey", F.col("price").cast("string").alias("price_text"), "placed", "status",
        F.col("customer.id").alias("customer_id"), "note", F.col("attributes")["cust"].alias("map_cust"),
        F.get("ids", F.lit(1)).alias("list_second"), _reject_text(F.col("_rejects")).alias("rejected"),
    )


# --------------------------------------------------------------- small values
@query("unquote", """
SELECT doc_id, text AS unquoted, '"' AS lone, lang || '"' AS half FROM documents""")
def unquote(spark, sf_dir):
    q = F.lit('"')
    return table(spark, sf_dir, "documents").select(
        "doc_id", values.unquote(F.concat(q, "text", q)).alias("unquoted"), values.unquote(q).alias("lone"),
        values.unquote(F.concat("lang", q)).alias("half"),
    )


@query("empty_to_null", """
SELECT doc_id, CASE WHEN lang <> 'en' THEN lang END AS plain, CASE WHEN lang <> 'en' THEN lang END AS quoted,
  '"' || CASE WHEN lang = 'en' THEN '' ELSE lang END || '"' AS kept FROM documents""")
def empty_to_null(spark, sf_dir):
    lang = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    quoted = F.concat(F.lit('"'), lang, F.lit('"'))
    return table(spark, sf_dir, "documents").select(
        "doc_id", values.empty_to_null(lang).alias("plain"), values.empty_to_null(quoted).alias("quoted"),
        F.when(values.empty_to_null(quoted, keep_quotes=True).isNotNull(), quoted).alias("kept"),
    )


@query("null_marker", r"""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS plain,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' THEN NULL WHEN o_orderstatus = 'P' THEN '\N' ELSE o_orderstatus END AS strict
FROM orders""")
def null_marker(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", "\\N").otherwise(F.col("o_orderstatus"))
    return _orders(spark, sf_dir).select(
        "o_orderkey", values.null_marker(text, "\\N").alias("plain"),
        values.null_marker(text, "\\N", quoted=F.col("o_orderpriority") == "1-URGENT").alias("strict"),
    )


@query("oracle_literal", """
SELECT doc_id, '''' || replace(text, '''', '''''') || '''' AS text_literal, CAST(n_chars AS VARCHAR) AS number_literal,
  CASE WHEN lang = 'en' THEN 'NULL' ELSE '''' || lang || '''' END AS null_literal FROM documents""")
def oracle_literal(spark, sf_dir):
    s = T.StringType()
    return table(spark, sf_dir, "documents").select(
        "doc_id", values.sql_literal(F.col("text"), s).alias("text_literal"),
        values.sql_literal(F.col("n_chars"), T.LongType()).alias("number_literal"),
        values.sql_literal(F.when(F.col("lang") != "en", F.col("lang")), s).alias("null_literal"),
    )


@query("bytes_to_decimal", """
SELECT o_orderkey, CAST(CAST(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(20,2)) AS VARCHAR) AS amount
FROM orders""")
def bytes_to_decimal(spark, sf_dir):
    cents = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint")
    signed = F.when(F.col("o_orderstatus") == "F", -cents).otherwise(cents)
    # the low four bytes, big-endian, as an unscaled decimal arrives
    raw = F.unhex(F.lpad(F.right(F.hex(signed), F.lit(8)), 8, "0"))
    return _orders(spark, sf_dir).select("o_orderkey", casts.decimal_from_bytes(raw, 2).cast("string").alias("amount"))


@query("split_statements", r"""
SELECT conv_id, turn, len(s) AS n, s[1] AS first_statement, s[len(s)] AS last_statement FROM (
  SELECT conv_id, turn, list_filter(list_transform(string_split(replace(x, '\;', chr(1)), ';'),
    lambda p: trim(replace(p, chr(1), ';'), chr(9) || chr(10) || chr(13) || ' ')), lambda p: length(p) > 0) AS s
  FROM (SELECT conv_id, turn, replace(replace(text, '.', ';'), ',', '\;') AS x FROM conversations))""")
def split_statements(spark, sf_dir):
    script = F.replace(F.replace("text", F.lit("."), F.lit(";")), F.lit(","), F.lit("\\;"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", values.split_statements(script).alias("s"))
    return rows.select(
        "conv_id", "turn", F.size("s").cast("bigint").alias("n"), F.get("s", F.lit(0)).alias("first_statement"),
        F.get("s", F.size("s") - 1).alias("last_statement"),
    )


@query("format_duration", """
SELECT o_orderkey, concat_ws(' ', CASE WHEN s // 3600 <> 0 THEN (s // 3600) || '시간' END,
  CASE WHEN s % 3600 // 60 <> 0 THEN (s % 3600 // 60) || '분' END, (s % 60) || '초') AS text,
  concat_ws(' ', CASE WHEN s // 3600 <> 0 THEN (s // 3600) || 'h' END,
  CASE WHEN s % 3600 // 60 <> 0 THEN (s % 3600 // 60) || 'm' END, (s % 60) || 's') AS short_text
FROM (SELECT o_orderkey, CAST(trunc(o_totalprice * 100) AS BIGINT) // 1000 AS s FROM orders)""")
def format_duration(spark, sf_dir):
    ms = F.col("o_totalprice") * 100
    ms = ms.cast("bigint")
    return _orders(spark, sf_dir).select(
        "o_orderkey", values.format_duration(ms).alias("text"), values.format_duration(ms, ("h", "m", "s")).alias("short_text")
    )


_SIZE_SQL = """CASE {} ELSE format('{{:,}}', b) || ' bytes' END""".format(" ".join(
    f"WHEN b > {1024 ** i} THEN regexp_replace(format('{{:,.2f}}', b / {float(1024 ** i)}), '\\.?0+$', '') || ' {u}'"
    for i, u in [(4, "TB"), (3, "GB"), (2, "MB"), (1, "KB")]
))


@query("format_data_size", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_SIZE_SQL} AS text,
  CAST(floor(l_quantity * 1024 * 1024) AS BIGINT) AS parsed, CAST(NULL AS BIGINT) AS not_a_size
FROM (SELECT *, CAST(l_orderkey AS BIGINT) * l_partkey * CASE l_returnflag WHEN 'A' THEN 1 ELSE 4099 END AS b FROM lineitem)""")
def format_data_size(spark, sf_dir):
    b = F.col("l_orderkey") * F.col("l_partkey") * F.when(F.col("l_returnflag") == "A", 1).otherwise(4099)
    size_text = F.concat(F.col("l_quantity").cast("decimal(9,1)").cast("string"), F.lit(" mb"))
    return _lines(spark, sf_dir).select(
        *_LINE_ID, values.format_data_size(b).alias("text"), values.parse_data_size(size_text).alias("parsed"),
        values.parse_data_size(F.col("l_returnflag")).alias("not_a_size"),
    )


@query("jdbc_value_normalize", """
SELECT o_orderkey AS O_KEY, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total_price,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed_at, CAST(o_custkey % 100 AS INTEGER) AS small FROM orders""")
def jdbc_value_normalize(spark, sf_dir):
    scan = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("O KEY"), F.col("o_totalprice").cast("decimal(12,2)").alias("total-price"),
        F.col("o_orderdate").alias("placed at"), (F.col("o_custkey") % 100).cast("tinyint").alias("small"),
    )
    return jdbc.jdbc_value_normalize(scan, logical=False, convert_names=True)


@query("sql_bound_params", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 1000.5 AND o_orderdate >= TIMESTAMP '1996-03-01 00:00:00' AND o_custkey > 7""")
def sql_bound_params(spark, sf_dir):
    attributes = {
        "sql.args.1.type": "12", "sql.args.1.value": "F", "sql.args.2.type": "8", "sql.args.2.value": "1000.5",
        "sql.args.3.type": "93", "sql.args.3.value": "1996-03-01T00:00:00", "sql.args.3.format": "ISO_LOCAL_DATE_TIME",
        "sql.args.4.type": "-5", "sql.args.4.value": "7",
    }
    text = """SELECT o_orderkey, o_totalprice FROM bound_orders
      WHERE o_orderstatus = ? AND o_totalprice >= ? AND o_orderdate >= ? AND o_custkey > ?"""
    return jdbc.sql_bound_params(spark, text, attributes, bound_orders=_orders(spark, sf_dir))
