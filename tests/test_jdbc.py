"""Statements, key rules and typed parameters; no database is started."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from recordflow.sources import jdbc

DB = jdbc.Database("jdbc:none:", dialect=jdbc.ANSI)
INFO = jdbc.TableInfo(columns=["ID", "NAME", "AGE"], keys=["ID"], required=["ID"], nullable={"NAME", "AGE"})


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 2)], "id int, na_me string, seq int")


def plan(df, op, **kw):
    return jdbc.plan_write(df, DB, '"APP"."T"', INFO, op, ["seq"], staging="S", **kw)


def test_statements(rows):
    on = 't."ID" = s."ID"'
    ins = 'WHEN NOT MATCHED THEN INSERT ("ID", "NAME") VALUES (s."ID", s."NAME")'
    upd = 'WHEN MATCHED THEN UPDATE SET "NAME" = s."NAME"'
    merge = f'MERGE INTO "APP"."T" t USING "S" s ON {on} '
    assert plan(rows, "insert").statement == 'INSERT INTO "APP"."T" ("ID", "NAME") SELECT "ID", "NAME" FROM "S"'
    assert plan(rows, "update").statement == merge + upd
    assert plan(rows, "upsert").statement == merge + upd + " " + ins
    assert plan(rows, "insert_ignore").statement == merge + ins
    assert plan(rows, "delete").statement == (
        'DELETE FROM "APP"."T" WHERE EXISTS (SELECT 1 FROM "S" s WHERE ("APP"."T"."ID" = s."ID") AND '
        '("APP"."T"."NAME" = s."NAME" OR ("APP"."T"."NAME" IS NULL AND s."NAME" IS NULL)))')


def test_staged_rows_hold_the_winner_of_each_key(rows):
    got = lambda op: sorted(map(tuple, plan(rows, op).rows.collect()))
    assert got("upsert") == got("update") == [(1, "b"), (2, "c")]
    assert got("insert_ignore") == [(1, "a"), (2, "c")]
    assert got("insert") == [(1, "a"), (1, "b"), (2, "c")]


def test_policies(rows, spark):
    with pytest.raises(ValueError, match="not in the target"):
        plan(rows.withColumn("extra", F.lit(1)), "insert", extra="fail")
    with pytest.raises(ValueError, match="required"):
        plan(rows.drop("id"), "insert")
    with pytest.raises(ValueError, match="no primary key"):
        jdbc.resolve_keys(jdbc.TableInfo(["A"]), None)
    assert jdbc.resolve_keys(INFO, ["na_me"]) == ["NAME"]
    with pytest.raises(ValueError, match="not in the table"):
        jdbc.resolve_keys(INFO, ["zip"])
    with pytest.raises(ValueError, match="not supported"):
        jdbc.plan_write(rows, jdbc.Database("x", dialect=jdbc.Dialect(operations=("INSERT",))), "T", INFO, "UPSERT")


def test_names_are_quoted():
    d = jdbc.ANSI
    assert d.table(None, "my schema", 'we"ird') == '"my schema"."we""ird"'
    assert d.select('"T"', '"A"', '"A" > 1', '"A"', 10, 5) == 'SELECT "A" FROM "T" WHERE "A" > 1 ORDER BY "A" OFFSET 5 ROWS FETCH NEXT 10 ROWS ONLY'


def test_evolution():
    old = T.StructType([T.StructField("ID", T.LongType(), False)])
    new = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("price", T.DecimalType(9, 2)), T.StructField("x", T.DoubleType())])
    assert jdbc.evolve_statements(jdbc.ANSI, '"T"', new, old) == [
        'ALTER TABLE "T" ADD COLUMN "price" DECIMAL(9,2)', 'ALTER TABLE "T" ADD COLUMN "x" DOUBLE PRECISION']
    assert jdbc.evolve_statements(jdbc.DERBY, '"T"', new, None, ["id"]) == [
        'CREATE TABLE "T" ("id" BIGINT NOT NULL, "price" DECIMAL(9,2), "x" DOUBLE, PRIMARY KEY ("id"))']
    assert jdbc.evolve_statements(jdbc.ANSI, '"T"', old, new) == []


def test_scan_options():
    db = jdbc.Database("jdbc:x:", "org.Driver", {"user": "u"})
    assert jdbc.scan_options(db, "SELECT 1", fetch_size=100, timeout_seconds=5, before=["SET a", "SET b"]) == {
        "url": "jdbc:x:", "user": "u", "driver": "org.Driver", "fetchsize": "100", "queryTimeout": "5", "query": "SELECT 1",
        "sessionInitStatement": "SET a; SET b"}


@pytest.mark.parametrize("args, want", [
    (("INTEGER", 0, 0, True), T.IntegerType()), (("INTEGER", 10, 0, False), T.LongType()), (("INTEGER", 5, 0, False), T.IntegerType()),
    (("TINYINT",), T.IntegerType()), (("BIGINT", 19), T.LongType()), (("BIGINT", 4), T.LongType()), (("BIGINT", 25), T.StringType()),
    (("DECIMAL", 9, 2), T.DecimalType(9, 2)), (("NUMERIC", 0, -127), T.DecimalType(10, 0)), (("NUMERIC", 2, 5), T.DecimalType(5, 5)),
    (("DECIMAL", 9, 2, True, False), T.StringType()), (("DATE",), T.DateType()), (("TIMESTAMP", 0, 0, True, False), T.StringType()),
    (("CLOB",), T.StringType()), (("BLOB",), T.BinaryType()), (("REAL",), T.FloatType()), (("BIT",), T.BooleanType()),
])
def test_result_types(args, want):
    assert jdbc.value_type(*args) == want


@pytest.mark.parametrize("code, value, fmt, want", [
    (jdbc.BIT, "T", "", True), (jdbc.BIT, "0", "", False), (jdbc.BOOLEAN, "t", "", False), (jdbc.SMALLINT, "5", "", 5),
    (jdbc.DECIMAL, "1.50", "", "1.50"), (jdbc.DATE, "2020-01-02", "", "2020-01-02"), (jdbc.DATE, "86400000", "", "1970-01-02"),
    (jdbc.DATE, "20200102", "BASIC_ISO_DATE", "2020-01-02"), (jdbc.TIMESTAMP, "2020-01-02 03:04:05.678", "", dt.datetime(2020, 1, 2, 3, 4, 5, 678000)),
    (jdbc.TIMESTAMP, "86400000", "", dt.datetime(1970, 1, 2)), (jdbc.TIME, "01:00:00.000", "", 3_600_000_000), (jdbc.VARBINARY, "4869", "hex", bytearray(b"Hi")),
    (12, "text", "", "text"), (jdbc.INTEGER, None, "", None),
])
def test_parameter_values(spark, code, value, fmt, want):
    got = spark.range(1).select(jdbc.bound_value(code, value, fmt).alias("v")).first()["v"]
    assert (str(got) if isinstance(want, str) else got) == want


def test_bad_parameters(spark):
    for attributes in ({"sql.args.1.type": "x"}, {"sql.args.2.type": "4", "sql.args.2.value": "1"}):
        with pytest.raises(ValueError):
            jdbc.bound_args(attributes)
    with pytest.raises(ValueError, match="does not fit"):
        jdbc.sql_bound_params(spark, "SELECT ?", {"sql.args.1.type": "4", "sql.args.1.value": "many"})


@pytest.mark.parametrize("op", ["UPDATE", "UPSERT", "INSERT_IGNORE"])
def test_rows_with_a_null_key_are_rejects_where_a_winner_is_picked(spark, op):
    info = jdbc.TableInfo(["K", "V"], ["K"])
    rows = spark.createDataFrame([(1, "a", 0), (None, "b", 1), (None, "c", 2), (1, "d", 3)], "K int, V string, seq int")
    done = jdbc.plan_write(rows, DB, "T", info, op, ["seq"], staging="S")
    assert [tuple(r) for r in done.rows.collect()] == [(1, "a" if op == "INSERT_IGNORE" else "d")]
    assert sorted(tuple(r) for r in done.rejects.collect()) == [(None, "b", "key must not be null"), (None, "c", "key must not be null")]


@pytest.mark.parametrize("op", ["INSERT", "DELETE"])
def test_rows_with_a_null_key_are_staged_elsewhere(spark, op):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "K int, V string")
    done = jdbc.plan_write(rows, DB, "T", jdbc.TableInfo(["K", "V"], ["K"]), op, staging="S")
    assert done.rows.count() == 2 and done.rejects.count() == 0
