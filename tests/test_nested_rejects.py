"""Conversion keeps the errors of every depth, and no value is lost."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F, types as T

from recordflow.functions import casts, nested
from recordflow.operators.ingest import to_target_rows

WANT = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("s", T.StructType([
        T.StructField("n", T.IntegerType()), T.StructField("must", T.StringType(), False),
        T.StructField("deep", T.StructType([T.StructField("d", T.DecimalType(6, 2))])),
    ])),
    T.StructField("a", T.ArrayType(T.StructType([T.StructField("t", T.TimestampNTZType())]))),
    T.StructField("m", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("kind", T.StringType(), True, {"symbols": ["x", "y"], "default": "x"}),
    T.StructField("list", T.ArrayType(T.IntegerType())),
])
HAVE = "id string, s struct<n string, must string, deep struct<d string>>, a array<struct<t string>>, m map<string, string>, kind string, list string"


def rows_of(spark):
    return spark.createDataFrame([
        ("1", ("5", "ok", ("1.25",)), [("2020-01-02 03:04:05",), (None,), ("",)], {"k": "7", "z": None}, "y", None),
        ("2", ("bad", None, ("oops",)), [("2020-01-02 03:04:05",), ("never",)], {"k": "no", "z": "8"}, "q", "12"),
        ("x", None, None, None, None, None),
    ], HAVE)


def test_rejects_at_every_depth(spark):
    out = nested.conform_to_schema(rows_of(spark), WANT).orderBy(F.size("_rejects"), F.col("id").desc()).collect()
    good, worst = out[0], out[-1]
    assert good["_rejects"] == [] and good["s"] == (5, "ok", (Decimal("1.25"),)) and good["m"] == {"k": 7, "z": None} and good["kind"] == "y"
    assert [x["t"] for x in good["a"]] == [dt.datetime(2020, 1, 2, 3, 4, 5), None, None]
    assert [tuple(e) for e in worst["_rejects"]] == [
        ("s.n", "bad", "not a valid int"), ("s.must", None, "must not be null"), ("s.deep.d", "oops", "not a valid decimal(6,2)"),
        ("a[1].t", "never", "not a valid timestamp_ntz"), ("m['k']", "no", "not a valid int"), ("kind", "q", "not a valid string"),
        ("list", "12", "not a valid array<int>"),
    ]
    # a bad part is null, those beside it stay; no default stands in for it
    assert worst["s"] == (None, None, (None,)) and worst["m"] == {"k": None, "z": 8} and worst["kind"] is None
    assert [tuple(e) for e in out[1]["_rejects"]] == [("id", "x", "not a valid bigint")] and out[1]["kind"] == "x"


def test_no_value_is_lost(spark):
    """Every value of the input is in the output or among the rejects."""
    good, bad = casts.split_rejects(nested.conform_to_schema(rows_of(spark), WANT))
    assert (good.count(), bad.count()) == (1, 2)
    leaves = lambda df: df.select(F.size(F.array_compact(F.array("id", "s.n", "s.deep.d", F.get("a", F.lit(1))["t"], F.element_at("m", "k").cast("string"))))).first()[0]
    text = rows_of(spark).filter("id = '2'")
    kept = nested.conform_to_schema(text, WANT)
    rejected = kept.select(F.size(F.filter("_rejects", lambda e: e["value"].isNotNull() & ~e["column"].isin("kind", "list")))).first()[0]
    as_text = kept.select(F.col("id").cast("string"), F.struct(F.col("s.n").cast("string").alias("n"), F.struct(F.col("s.deep.d").cast("string").alias("d")).alias("deep")).alias("s"),
                          F.transform("a", lambda x: F.struct(x["t"].cast("string").alias("t"))).alias("a"), "m")
    assert leaves(text) == leaves(as_text) + rejected == 5


def test_depth_does_not_multiply_the_plan(spark):
    have, want, value = T.StringType(), T.IntegerType(), F.lit("7")
    for _ in range(12):
        have = T.StructType([T.StructField("v", have)])
        want = T.StructType([T.StructField("v", want)])
        value = F.struct(value.alias("v"))
    df = spark.range(3).select(value.alias("x"))
    out = nested.conform_to_schema(df, T.StructType([T.StructField("x", want)]))
    assert len(out._jdf.queryExecution().analyzed().toString()) < 60_000
    assert out.select(F.col("x" + ".v" * 12).alias("v"), F.size("_rejects").alias("n")).distinct().collect() == [(7, 0)]


def test_structs_and_maps_convert_into_each_other(spark):
    df = spark.createDataFrame([(("1", "x"), {"n": "2", "other": "3"})], "s struct<a string, b string>, m map<string, string>")
    want = T.StructType([T.StructField("s", T.MapType(T.StringType(), T.IntegerType())), T.StructField("m", T.StructType([T.StructField("n", T.IntegerType())]))])
    row = nested.conform_to_schema(df, want).first()
    assert row["s"] == {"a": 1, "b": None} and row["m"] == (2,) and [tuple(e) for e in row["_rejects"]] == [("s['b']", "x", "not a valid int")]


def test_target_rows_reject_nested_values_and_apply_converters(spark):
    target = T.StructType([f for f in WANT.fields if f.name in ("id", "s")])
    out = to_target_rows(rows_of(spark), target, ["id"], converters={"id": lambda c: F.concat(c, F.lit("0"))}).collect()
    by = {r["id"]: [e["column"] for e in r["_rejects"]] for r in out}
    assert by == {10: [], 20: ["s.n", "s.must", "s.deep.d"], None: ["id"]}
    assert out[0].asDict().keys() == {"id", "s", "_rejects"}
