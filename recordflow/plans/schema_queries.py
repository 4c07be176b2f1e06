"""Column names, widening, defaults, nested records, limits and pages."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from recordflow.operators import batches, keyed, schema
from recordflow.plans.registry import query, table


@query("project_to_target", "SELECT o_orderkey, o_totalprice FROM orders")
def project_to_target(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "unknown").select("o_orderkey", "unknown", "o_totalprice")
    return keyed.project_to_target(rows, table(spark, sf_dir, "orders"))


@query("lowercase_names", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def lowercase_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return schema.lowercase_names(c.select(
        F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_name").alias("C_Name"), F.col("c_mktsegment").alias("c_mktSegment")))


@query("translate_names", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def translate_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CCustKey"), F.col("c_name").alias("C_NAME"), F.col("c_acctbal").alias("cAcct_Bal"),
        F.col("c_nationkey").alias("elsewhere"))
    return schema.translate_names(c, table(spark, sf_dir, "customer").columns)


def _field(name: str, dt: T.DataType, **meta) -> T.StructField:
    return T.StructField(name, dt, True, meta)


@query("alias_lookup", """
SELECT p_partkey AS id, p_name AS title, p_brand AS maker, p_size AS size, CAST(NULL AS DOUBLE) AS weight FROM part""")
def alias_lookup(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("label"),
        F.col("p_brand").alias("brand", metadata={"aliases": ["maker"]}),
        F.col("p_size").alias("extent", metadata={"aliases": ["dimension"]}))
    want = T.StructType([
        _field("id", T.LongType()), _field("title", T.StringType(), aliases=["name", "label"]),
        _field("maker", T.StringType()), _field("size", T.IntegerType(), aliases=["dimension"]),
        _field("weight", T.DoubleType()),
    ])
    return schema.alias_lookup(p, want)


@query("default_fill", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE o_orderstatus END AS status, 7 AS priority, o_custkey FROM orders""")
def default_fill(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    want = T.StructType([_field("o_orderkey", T.LongType()), _field("status", T.StringType(), default="open"),
                         _field("priority", T.IntegerType(), default="7")])
    return schema.default_fill(o, want)


@query("normalize_names", """
SELECT r_regionkey AS region_key, r_name AS _1st_name, r_name || '!' AS Caf_, 1 AS n_aliases FROM region""")
def normalize_names(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    out = schema.normalize_names(r.select(F.col("r_regionkey").alias("region key"), F.col("r_name").alias("1st-name"),
                                          F.concat("r_name", F.lit("!")).alias("Café")))
    kept = schema.normalize_names(r.select(F.col("r_name").alias("1 Café")), "unicode")
    return out.withColumn("n_aliases", F.lit(len(kept.schema["__Café"].metadata["aliases"])))


@query("nested_record_extract", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, n FROM events, (SELECT unnest([1, 2]) AS n)""")
def nested_record_extract(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.from_json("props", "k bigint")["k"]
    item = lambda n: F.struct(F.col("event_id"), F.col("event_type"), k.alias("k"), F.lit(n).alias("n"))
    outer = e.select(F.struct(F.array(item(1), item(2)).alias("records")).alias("body"))
    return schema.nested_record_extract(outer, "body.records")


_ALL = "SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(12,2)) AS amount, c_name AS name, CAST(c_nationkey AS VARCHAR) AS mixed, NULL AS qty"


@query("union_widened", f"""
SELECT id, CAST(CAST(amount AS DECIMAL(12,4)) AS VARCHAR) AS amount, name, mixed, qty FROM (
{_ALL} FROM customer
UNION ALL SELECT s_suppkey, CAST(s_acctbal AS DECIMAL(9,4)), s_name, s_name, s_nationkey * 1.0 FROM supplier)""")
def union_widened(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_acctbal").cast("decimal(12,2)").alias("amount"),
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("mixed"))
    b = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").cast("decimal(9,4)").alias("amount"),
        F.col("s_name").alias("title", metadata={"aliases": ["name"]}), F.col("s_name").alias("mixed"),
        F.col("s_nationkey").cast("double").alias("qty"))
    out = schema.union_widened(a, b)
    return out.withColumn("amount", F.col("amount").cast("string"))


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return batches.limit_rows(o, [F.col("o_totalprice").desc(), "o_orderkey"], 100)


@query("select_page", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 25""")
def select_page(spark, sf_dir):
    return batches.select_page(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"], F.col("o_orderstatus") == "F",
                               ["o_orderdate", "o_orderkey"], 50, 25)


@query("select_page_deep", """
SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 500 OFFSET 300""")
def select_page_deep(spark, sf_dir):
    return batches.select_page(table(spark, sf_dir, "events"), ["event_id", "ts"], None, ["ts", "event_id"], 500, 300)


# ------------------------------------------------------------ numbered batches
@query("result_fragments", """
SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS fragment_index FROM events""")
def result_fragments(spark, sf_dir):
    return batches.result_fragments(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 1000).drop("ts")


@query("fragment_summary", """
WITH f AS (SELECT (row_number() OVER (ORDER BY ts, event_id) - 1) // 300 AS i FROM events)
SELECT 'events' AS fragment_identifier, i AS fragment_index, count(*) AS row_count,
  (SELECT count(DISTINCT i) FROM f) AS fragment_count FROM f GROUP BY i""")
def fragment_summary(spark, sf_dir):
    rows = batches.result_fragments(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 300)
    return batches.fragment_summary(rows, "events")


@query("batched_sql_render", r"""
WITH r AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS rn, 'INTO app.customer ( c_custkey, c_name, c_segment ) VALUES ( '
    || c_custkey || ', ''' || replace(c_name, '#', '''') || repeat('''', CAST(length(c_name) - length(replace(c_name, '#', '')) AS INTEGER) * 0)
    || ''', ' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'NULL' ELSE '''' || c_mktsegment || '''' END || ' )' AS line FROM customer)
SELECT rn // 100 AS batch, count(*) AS row_count,
  'INSERT ALL' || chr(10) || string_agg(replace(line, 'Customer''', 'Customer'''''), chr(10) ORDER BY rn) || chr(10) || 'SELECT 1 FROM dual' AS script
FROM r GROUP BY 1""")
def batched_sql_render(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.replace("c_name", F.lit("#"), F.lit("'")).alias("c_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_segment"))
    return batches.batched_sql_render(c, "app.customer", ["c_custkey", "c_name", "c_segment"], ["c_custkey"], 100)
