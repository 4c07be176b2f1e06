"""Delimited and Parquet files: each query writes whole tables to a shared folder and reads them back."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from recordflow.operators.batches import shared_dir
from recordflow.plans.registry import query, table
from recordflow.sources import csv, parquet


def _docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "source")


# text that is empty comes back as null
_DOCS_SQL = "SELECT doc_id, nullif(lang, '') AS lang, nullif(text, '') AS text, nullif(source, '') AS source FROM documents"


# ------------------------------------------------------------------------ scans
@query("csv_scan", f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text, source FROM ({_DOCS_SQL})")
def csv_scan(spark, sf_dir):
    path = shared_dir(spark)
    csv.csv_write(_docs(spark, sf_dir), path, "informix-unload-csv")
    return csv.csv_scan(spark, path, "informix-unload-csv")


def _round_trip(spark, rows: DataFrame, names: list[str], multi_line: bool) -> DataFrame:
    out = []
    for name in names:
        path = shared_dir(spark)
        csv.csv_write(rows, path, name)
        out.append(csv.csv_scan(spark, path, name, multi_line=multi_line).withColumn("dialect", F.lit(name)))
    return reduce(DataFrame.unionByName, out)


def _dialect_sql(names: list[str]) -> str:
    listed = ", ".join(f"('{n}')" for n in names)
    return f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text, source, dialect FROM ({_DOCS_SQL}), (VALUES {listed}) d(dialect)"


_PRESETS = ["rfc-4180", "excel", "informix-unload-csv", "mysql", "mongodb-csv", "mongodb-tsv", "postgresql-csv", "postgresql-text"]


@query("csv_dialect", _dialect_sql(_PRESETS[:4]))
def csv_dialect(spark, sf_dir):
    return _round_trip(spark, _docs(spark, sf_dir), _PRESETS[:4], True)


@query("csv_dialect_extra", _dialect_sql(_PRESETS[4:]))
def csv_dialect_extra(spark, sf_dir):
    return _round_trip(spark, _docs(spark, sf_dir), _PRESETS[4:], True)


# dialects that trim: single-line columns
@query("csv_dialect_trimmed", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment || '|' AS seg, dialect
FROM customer, (VALUES ('custom'), ('tdf'), ('informix-unload'), ('oracle')) d(dialect)""")
def csv_dialect_trimmed(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit(" "), "c_name").alias("c_name"), F.concat("c_mktsegment", F.lit("|")).alias("seg"))
    out = []
    for name in ("custom", "tdf", "informix-unload", "oracle"):
        path = shared_dir(spark)
        csv.csv_write(rows, path, name)
        out.append(csv.csv_scan(spark, path, name, multi_line=False).select(
            "c_custkey", F.ltrim("c_name").alias("c_name"), "seg").withColumn("dialect", F.lit(name)))
    return reduce(DataFrame.unionByName, out)


@query("csv_escape_unquoted", f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text, source FROM ({_DOCS_SQL})")
def csv_escape_unquoted(spark, sf_dir):
    path = shared_dir(spark)
    csv.csv_write(_docs(spark, sf_dir), path, "mysql", header=False)
    return csv.csv_scan(spark, path, "mysql", ["doc_id", "lang", "text", "source"], header="none")


@query("csv_header_schema", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment,
  CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS c_acctbal FROM customer""")
def csv_header_schema(spark, sf_dir):
    path = shared_dir(spark)
    c = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    # files of one segment have a column more, in front
    csv.csv_write(c.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), f"{path}/a")
    csv.csv_write(c.filter("c_mktsegment = 'BUILDING'").select("c_acctbal", "c_custkey", "c_name", "c_nationkey", "c_mktsegment"), f"{path}/b")
    return csv.csv_scan(spark, [f"{path}/a", f"{path}/b"])


def _written_lines(spark, sf_dir) -> DataFrame:
    """Line items read back as text, with a column of mixed content and one that is all empty."""
    path = shared_dir(spark)
    t = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        (F.col("l_returnflag") == "R").alias("returned"), (F.col("l_orderkey") * 1000000000).alias("big"),
        F.when(F.col("l_returnflag") == "N", F.lit("none")).otherwise(F.col("l_suppkey").cast("string")).alias("mixed"),
        F.lit(None).cast("string").alias("empty"),
    )
    csv.csv_write(t, path)
    return csv.csv_scan(spark, path, multi_line=False)


@query("csv_infer_schema", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate AS shipped, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day,
  l_returnflag = 'R' AS returned, l_orderkey * 1000000000 AS big,
  CASE WHEN l_returnflag = 'N' THEN 'none' ELSE CAST(l_suppkey AS VARCHAR) END AS mixed, CAST(NULL AS VARCHAR) AS empty FROM lineitem""")
def csv_infer_schema(spark, sf_dir):
    text = _written_lines(spark, sf_dir)
    typed = csv.apply_inferred(text, csv.csv_infer_schema(text))
    return typed.withColumn("day", F.col("day").cast("string"))


@query("column_type_profile", """
SELECT 'l_orderkey' AS column_name, count(*) AS value_count, count(*) AS fits_int, count(*) AS fits_bigint, count(*) AS fits_double,
  0 AS fits_boolean, 0 AS fits_timestamp, 0 AS fits_date, 0 AS fits_time, 'int' AS chosen_type FROM lineitem
UNION ALL SELECT 'l_extendedprice', count(*), 0, 0, count(*), 0, 0, 0, 0, 'double' FROM lineitem
UNION ALL SELECT 'shipped', count(*), 0, 0, 0, 0, count(*), 0, 0, 'timestamp' FROM lineitem
UNION ALL SELECT 'returned', count(*), 0, 0, 0, count(*), 0, 0, 0, 'boolean' FROM lineitem
UNION ALL SELECT 'mixed', count(*), n, n, n, 0, 0, 0, 0, 'string' FROM lineitem, (SELECT count(*) AS n FROM lineitem WHERE l_returnflag <> 'N') GROUP BY n
UNION ALL SELECT 'empty', 0, 0, 0, 0, 0, 0, 0, 0, 'string'""")
def column_type_profile(spark, sf_dir):
    return csv.column_type_profile(
        _written_lines(spark, sf_dir), ["l_orderkey", "l_extendedprice", "shipped", "returned", "mixed", "empty"])


@query("csv_header_by_name", """
SELECT c_custkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_nationkey, c_name FROM (
  SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_nationkey, c_name FROM customer)""")
def csv_header_by_name(spark, sf_dir):
    path = shared_dir(spark)
    c = table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"), "c_name", "c_custkey")
    # files with the columns in another order each
    odd = F.col("c_custkey") % 2 == 1
    csv.csv_write(c.filter(odd), f"{path}/a")
    csv.csv_write(c.filter(~odd).select("c_custkey", "c_name", "c_acctbal", "c_nationkey"), f"{path}/b")
    scan = csv.csv_scan(spark, [f"{path}/a", f"{path}/b"])
    # the balance is not in the schema, so it stays text
    return csv.bind_types(scan, {"c_custkey": "bigint", "c_nationkey": "int", "c_name": "string"}).drop("_rejects")


@query("csv_header_ignored", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label FROM customer")
def csv_header_ignored(spark, sf_dir):
    path = shared_dir(spark)
    csv.csv_write(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), path)
    return csv.csv_scan(spark, path, names=["id", "label"], header="ignored", multi_line=False)


@query("csv_headerless", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def csv_headerless(spark, sf_dir):
    path = shared_dir(spark)
    csv.csv_write(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), path, header=False)
    return csv.csv_scan(spark, path, names=["id", "label", "nation"], header="none", multi_line=False)


@query("csv_unknown_fields", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label, c_mktsegment AS unknown_field_index_2,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '"x,y"' END AS unknown_field_index_3, 1 + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS n_unknown
FROM customer""")
def csv_unknown_fields(spark, sf_dir):
    path = shared_dir(spark)
    c = table(spark, sf_dir, "customer")
    line = F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment",
                       F.when(F.col("c_mktsegment") == "BUILDING", F.lit('"\\"x,y\\""')))
    csv.write_lines(c.select(line.alias("line")), path, "id,label")
    wide = csv.csv_scan(spark, path, names=["id", "label"], header="ignored", unknown="columns", multi_line=False)
    extra = [x for x in wide.columns if x.startswith(csv.UNKNOWN_FIELD)]
    count = reduce(lambda a, b: a + b, [F.col(x).isNotNull().cast("int") for x in extra])
    return wide.withColumn("n_unknown", count)


@query("csv_duplicate_headers", """
SELECT CAST(c_custkey AS VARCHAR) AS a, c_name AS b, CAST(c_nationkey AS VARCHAR) AS right_b, c_mktsegment AS c, CAST(c_nationkey AS VARCHAR) AS shifted_c
FROM customer""")
def csv_duplicate_headers(spark, sf_dir):
    path = shared_dir(spark)
    c = table(spark, sf_dir, "customer")
    csv.write_lines(c.select(F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("line")), path, "a,b,b,c")
    right = csv.csv_scan(spark, path, multi_line=False).select("a", F.col("b").alias("right_b"), "c")
    left = csv.csv_scan(spark, path, multi_line=False, duplicate_values="shifted").select("a", "b", F.col("c").alias("shifted_c"))
    return right.join(left, "a")


def _uneven(spark, sf_dir) -> str:
    """Customers as lines: BUILDING rows lack a cell, MACHINERY rows have one too many, AUTOMOBILE balances are no numbers."""
    path = shared_dir(spark)
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    balance = F.when(seg == "AUTOMOBILE", "unpaid").otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    cells = [F.col("c_custkey").cast("string"), F.col("c_name"), F.when(seg != "BUILDING", balance), F.when(seg == "MACHINERY", F.lit("more"))]
    csv.write_lines(c.select(F.concat_ws(",", *cells).alias("line")), path, "id,label,balance")
    return path


@query("csv_field_count", """
SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'rejected' ELSE 'accepted' END AS part,
  CASE c_mktsegment WHEN 'BUILDING' THEN 2 WHEN 'MACHINERY' THEN 4 ELSE 3 END AS n_cells, count(*) AS row_count
FROM customer GROUP BY 1, 2""")
def csv_field_count(spark, sf_dir):
    d = csv.dialect("custom")
    lines = csv.read_lines(spark, _uneven(spark, sf_dir), d, skip_header=True)
    good, bad = csv.split_field_count(csv.parse_lines(lines, d), 3)
    parts = good.withColumn("part", F.lit("accepted")).unionByName(bad.withColumn("part", F.lit("rejected")))
    return parts.groupBy("part", F.size("cells").alias("n_cells")).agg(F.count(F.lit(1)).alias("row_count"))


@query("csv_quarantine", """
SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'bad' ELSE 'good' END AS part, c_custkey AS id,
  CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN CAST(c_acctbal AS DOUBLE) END AS balance,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'wrong number of cells' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'not a valid double' END AS reason
FROM customer""")
def csv_quarantine(spark, sf_dir):
    types = {"id": "bigint", "label": "string", "balance": "double"}
    good, bad = csv.csv_quarantine(csv.scan_with_rejects(spark, _uneven(spark, sf_dir), types, multi_line=False))
    return good.select(F.lit("good").alias("part"), "id", "balance", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.lit("bad").alias("part"), "id", F.lit(None).cast("double").alias("balance"),
                   F.get("_rejects", F.lit(0))["reason"].alias("reason")))


@query("csv_skip_blank_comment", """
SELECT 'custom' AS dialect, count(*) AS all_rows, count(*) AS with_id FROM customer
UNION ALL SELECT 'excel', 2 * count(*) + count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), count(*) + count(*) FILTER (WHERE c_mktsegment = 'BUILDING') FROM customer""")
def csv_skip_blank_comment(spark, sf_dir):
    path = shared_dir(spark)
    note = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("# about "), "c_name"))
    lines = F.array_compact(F.array(F.concat_ws(",", "c_custkey", "c_name"), F.lit(""), note))
    csv.write_lines(table(spark, sf_dir, "customer").select(F.explode(lines).alias("line")), path, "id,label")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("all_rows"), F.count("id").alias("with_id")).withColumn("dialect", F.lit(name))
    dropped = csv.csv_scan(spark, path, csv.dialect("custom").but(comment="#"), multi_line=False)
    kept = csv.csv_scan(spark, path, "excel", multi_line=False)
    return count(dropped, "custom").unionByName(count(kept, "excel"))


# ------------------------------------------------------------------------ writes
_Q = "'\"' || replace({}, '\"', '\"\"') || '\"'"
_TXT = "c_name || ',\"' || c_mktsegment"
_SEG = "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END"


@query("csv_write", f"""
SELECT c_custkey, {_Q.format("CAST(c_custkey AS VARCHAR)")} || ',' || {_Q.format(_TXT)} || ',' || coalesce({_Q.format(_SEG)}, '""') AS all_quoted,
  {_Q.format("CAST(c_custkey AS VARCHAR)")} || ',' || {_Q.format(_TXT)} || ',' || coalesce({_Q.format(_SEG)}, '') AS all_non_null,
  c_custkey || ',' || {_Q.format(_TXT)} || ',' || coalesce({_SEG}, '') AS minimal,
  c_custkey || ',' || {_Q.format(_TXT)} || ',' || coalesce({_Q.format(_SEG)}, '') || ',' AS non_numeric,
  c_custkey || ',' || replace({_TXT}, ',', '\\,') || ',' || coalesce({_SEG}, '') AS none
FROM customer""")
def csv_write(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_TXT).alias("txt"), F.expr(_SEG).alias("seg"))
    d = csv.dialect("default")
    line = lambda mode, **kw: csv.render_lines(rows, d.but(**kw), mode)
    return rows.select(
        "c_custkey", line(csv.ALL).alias("all_quoted"), line(csv.ALL_NON_NULL).alias("all_non_null"), line(csv.MINIMAL).alias("minimal"),
        line(csv.NON_NUMERIC, trailing_delimiter=True).alias("non_numeric"), line(csv.NONE).alias("none"))


@query("csv_write_extra_fields", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS VARCHAR) AS note, c_mktsegment, c_name,
  'c_custkey,note,c_name,c_mktsegment' AS header FROM customer""")
def csv_write_extra_fields(spark, sf_dir):
    path = shared_dir(spark)
    rows = table(spark, sf_dir, "customer").select("c_name", "c_mktsegment", "c_custkey")
    csv.csv_write(csv.csv_write_extra_fields(rows, ["c_custkey", "note"]), path)
    back = csv.csv_scan(spark, path, multi_line=False)
    return back.withColumn("header", F.lit(",".join(back.columns)))


# ----------------------------------------------------------------------- parquet
@query("parquet_scan_glob", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')")
def parquet_scan_glob(spark, sf_dir):
    path = shared_dir(spark)
    parquet.parquet_write(table(spark, sf_dir, "orders"), path, partition_by=["o_orderstatus"])
    return parquet.parquet_scan_glob(spark, f"{path}/o_orderstatus={{F,[N-O]}}/*.parquet").select("o_orderkey", "o_totalprice")


@query("parquet_scan_int96", "SELECT event_id, ts FROM events")
def parquet_scan_int96(spark, sf_dir):
    path = shared_dir(spark)
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    parquet.parquet_write_int96(rows, path)
    return spark.read.parquet(path).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("parquet_write_int96", "SELECT event_id, ts FROM events")
def parquet_write_int96(spark, sf_dir):
    path = shared_dir(spark)
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    parquet.parquet_write_int96(rows, path, int96=True)
    return spark.read.parquet(path).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("parquet_write_int96_columns", "SELECT event_id, ts, ts + INTERVAL 1 HOUR AS later FROM events")
def parquet_write_int96_columns(spark, sf_dir):
    """One zoned column stored as INT96, the other not; both come back as the instants they were."""
    path = shared_dir(spark)
    ts_column = F.col("ts").cast("timestamp")
    rows = table(spark, sf_dir, "events").select(
        "event_id", ts_column.alias("ts"), (ts_column + F.expr("INTERVAL 1 HOUR")).alias("later"))
    parquet.parquet_write_int96(rows, path, columns=["ts"])
    back = parquet.read_zoned(spark, path)
    return back.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("ts", "later")])


def _parts(spark, sf_dir) -> str:
    """Customers and suppliers as files of two folders, with different columns."""
    path = shared_dir(spark)
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    parquet.parquet_write(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), f"{path}/in/a")
    parquet.parquet_write(s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), f"{path}/in/b")
    return path


_MERGED = """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier"""


@query("parquet_merge", _MERGED)
def parquet_merge(spark, sf_dir):
    path = _parts(spark, sf_dir)
    parquet.parquet_merge(spark, f"{path}/in/*/*.parquet", f"{path}/out")
    return spark.read.parquet(f"{path}/out")


@query("union_files", _MERGED)
def union_files(spark, sf_dir):
    path = _parts(spark, sf_dir)
    return parquet.union_files(spark, [f"{path}/in/a", f"{path}/in/b"])


@query("parquet_merge_cleanup", "SELECT count(*) + (SELECT count(*) FROM supplier) AS row_count, 0 AS sources_left FROM customer")
def parquet_merge_cleanup(spark, sf_dir):
    path = _parts(spark, sf_dir)
    pattern = f"{path}/in/*/*.parquet"
    parquet.parquet_merge_cleanup(spark, pattern, f"{path}/out", delete_sources=True)
    left = len(parquet.glob_files(spark, pattern))
    return spark.read.parquet(f"{path}/out").agg(F.count(F.lit(1)).alias("row_count")).withColumn("sources_left", F.lit(left))


@query("parquet_write", "SELECT doc_id, lang, text FROM documents")
def parquet_write(spark, sf_dir):
    path = shared_dir(spark)
    parquet.parquet_write(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path, compression="gzip",
                          row_group_size="8 MB", page_size="64 KB", dictionary=False, writer_version="PARQUET_2_0", legacy_lists=True)
    return spark.read.parquet(path)


@query("parquet_write_atomic", "SELECT c_custkey, c_name FROM customer")
def parquet_write_atomic(spark, sf_dir):
    path = shared_dir(spark)
    parquet.parquet_write(table(spark, sf_dir, "supplier"), path)
    parquet.parquet_write(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), path, overwrite=True)
    return spark.read.parquet(path)


@query("parquet_write_atomic_failed", "SELECT c_custkey, c_name FROM customer")
def parquet_write_atomic_failed(spark, sf_dir):
    """A write that fails in its tasks leaves the stored rows."""
    path = shared_dir(spark)
    parquet.parquet_write(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), path)
    spoilt = table(spark, sf_dir, "supplier").withColumn("s_name", F.raise_error(F.lit("no such supplier")).cast("string"))
    try:
        parquet.parquet_write(spoilt, path)
    except (PySparkException, Py4JJavaError):
        return spark.read.parquet(path)
    raise AssertionError("the write did not fail")


@query("parquet_write_ts_format", "SELECT event_id, date_trunc('milliseconds', ts) + INTERVAL 9 HOUR AS at FROM events WHERE event_type <> 'error'")
def parquet_write_ts_format(spark, sf_dir):
    path = shared_dir(spark)
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", "?").otherwise(
        F.date_format("ts", "yyyyMMdd'T'HHmmss.SSS")).alias("at"))
    parquet.parquet_write_ts_format(rows, path, ["at"], {"at": "yyyyMMdd'T'HHmmss.SSS"}, hours=9)
    return spark.read.parquet(path).select("event_id", "at")


@query("file_row_counts", "SELECT 'a' AS folder, count(*) AS row_count FROM customer UNION ALL SELECT 'b', count(*) FROM supplier")
def file_row_counts(spark, sf_dir):
    per = parquet.file_row_counts(parquet.parquet_scan_glob(spark, f"{_parts(spark, sf_dir)}/in/*/*.parquet"))
    folder = F.regexp_extract("file_path", "/in/([ab])/", 1)
    return per.groupBy(folder.alias("folder")).agg(F.sum("row_count").alias("row_count"))
