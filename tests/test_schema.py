import pytest
from pyspark.sql import functions as F, types as T

from recordflow.operators import schema
from recordflow.sources import avro

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


@pytest.mark.parametrize("a, b, want", [
    (T.ByteType(), T.ShortType(), T.ShortType()), (I, L, L), (L, T.FloatType(), T.FloatType()), (T.FloatType(), D, D),
    (D, T.DecimalType(10, 2), T.DecimalType(10, 2)), (I, T.DecimalType(10, 2), T.DecimalType(10, 2)),
    (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(10, 4)), (T.VarcharType(3), S, S), (S, I, None), (T.BooleanType(), I, None),
    (T.DateType(), T.TimestampType(), None), (T.NullType(), I, I),
])
def test_widening(a, b, want):
    assert schema.wider_type(a, b) == want and schema.wider_type(b, a) == want


def test_union_of_different_tables(spark):
    a = spark.createDataFrame([(1, "x", True)], "id int, name string, flag boolean")
    b = spark.createDataFrame([(10_000_000_000, "y", 5)], "id bigint, title string, flag int").withMetadata("title", {"aliases": ["name"]})
    out = schema.union_widened(a, b)
    assert dict(out.dtypes) == {"id": "bigint", "name": "string", "flag": "string"}
    assert sorted(map(tuple, out.collect())) == [(1, "x", "true"), (10_000_000_000, "y", "5")]
    assert dict(schema.union_widened(a, b, mixed="variant").dtypes)["flag"] == "variant"


def test_union_never_drops_a_value_silently(spark):
    a = spark.sql("SELECT CAST(123456789 AS DECIMAL(10,0)) AS v")
    b = spark.sql("SELECT CAST(1.2345 AS DECIMAL(5,4)) AS v")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        schema.union_widened(a, b).collect()


def test_names(spark):
    assert [schema.plain_name(n) for n in ("a b", "1x", "é", "ok_1")] == ["a_b", "_1x", "_", "ok_1"]
    assert [schema.valid_field_name(n) for n in ("", "1x", "é b", "_a")] == ["UNNAMED_FIELD", "_x", "é_b", "_a"]
    df = spark.range(1).select(F.col("id").alias("My_Id"), F.lit(1).alias("other"))
    assert schema.translate_names(df, ["MYID"]).columns == ["MYID"]
    with pytest.raises(ValueError):
        schema.translate_names(df, ["MYID"], unmatched="fail")
    with pytest.raises(ValueError):
        schema.translate_names(df, ["x"])
    # a name in another case matches only after lowercasing
    assert "id" not in df.columns and schema.lowercase_names(df).columns == ["my_id", "other"]


def test_nested_paths(spark):
    df = spark.sql("SELECT named_struct('a', named_struct('x', 1, 'y', 2), 'n', 3) AS o")
    assert schema.nested_record_extract(df, "o.a").columns == ["x", "y"]
    with pytest.raises(ValueError):
        schema.nested_record_extract(df, "o.n")
    with pytest.raises(ValueError):
        schema.nested_record_extract(df, "o.missing")


def test_drift(spark):
    t = spark.sql("SELECT 1 AS id")
    c = spark.sql("SELECT 1 AS id, 'x' AS name, CAST(1.5 AS DECIMAL(6,3)) AS d")
    wide = schema.schema_drift_add_columns(t, c)
    assert dict(wide.dtypes) == {"id": "int", "name": "string", "d": "decimal(6,3)"}
    assert schema.add_columns_ddl("db.t", t.schema, c.schema) == "ALTER TABLE db.t ADD COLUMNS (`name` string, `d` decimal(6,3))"
    assert schema.add_columns_ddl("db.t", c.schema, t.schema) is None


def test_column_policies():
    assert schema.check_columns(["ID", "x"], ["id", "name"]) == ["ID"]
    with pytest.raises(ValueError):
        schema.check_columns(["id", "x"], ["id"], extra="fail")
    with pytest.raises(ValueError):
        schema.check_columns(["x"], ["id"])
    with pytest.raises(ValueError):
        schema.check_columns(["id"], ["id", "n"], required=["n"])
    with pytest.warns(UserWarning):
        schema.check_columns(["id"], ["id", "n"], required=["n"], missing="warn")
    assert schema.check_columns(["id"], ["id", "n"], required=["n"], missing="ignore") == ["id"]


ALL_TYPES = """{"type": "record", "name": "r", "fields": [
  {"name": "b", "type": ["null", "boolean"]}, {"name": "i", "type": "int"}, {"name": "l", "type": ["long", "null"], "default": 7},
  {"name": "d", "type": {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2}},
  {"name": "day", "type": {"type": "int", "logicalType": "date"}}, {"name": "tm", "type": {"type": "int", "logicalType": "time-millis"}},
  {"name": "ts", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}], "aliases": ["stamp"]},
  {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}}, {"name": "m", "type": {"type": "map", "values": "long"}},
  {"name": "a", "type": {"type": "array", "items": ["null", "string"]}}, {"name": "u", "type": ["null", "int", "string"]},
  {"name": "rec", "type": {"type": "record", "name": "n", "fields": [{"name": "x", "type": "double"}]}}]}"""


def test_avro_schemas_map_both_ways():
    s = avro.schema_from_avro(ALL_TYPES)
    types = {f.name: f.dataType.simpleString() for f in s.fields}
    assert types == {"b": "boolean", "i": "int", "l": "bigint", "d": "decimal(6,2)", "day": "date", "tm": "bigint", "ts": "timestamp_ntz",
                     "e": "string", "m": "map<string,bigint>", "a": "array<string>", "u": "string", "rec": "struct<x:double>"}
    assert s["ts"].nullable and not s["i"].nullable and s["l"].metadata["default"] == 7 and s["ts"].metadata["aliases"] == ["stamp"]
    again = avro.schema_from_avro(avro.schema_to_avro(s))
    assert {f.name: f.dataType.simpleString() for f in again.fields} == types
    assert again["e"].metadata["symbols"] == ["A", "B"] and again["tm"].metadata["logicalType"] == "time-millis"


def test_avro_codecs_and_missing_module(spark):
    assert avro.codec("xz") == "xz"
    for bad in ("lzo", "zip"):
        with pytest.raises(ValueError):
            avro.codec(bad)
    with pytest.raises(ValueError, match="cannot be compressed"):
        avro.avro_write_external(spark.range(1), compression="snappy")
    if not avro.available(spark):
        with pytest.raises(avro.AvroUnavailable):
            avro.avro_write_embedded(spark.range(1), "/tmp/none")
