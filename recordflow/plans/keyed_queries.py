"""Keyed-table queries: ``orders`` is the stored table, all of ``lineitem`` the change rows.

Returned lines open replacement orders under new keys, so that both stored and
new keys occur; some keys and some prices are null.  The order of changes is
the line number and then every other column, which makes it total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordflow.functions import casts, timestamps as ts
from recordflow.operators import keyed
from recordflow.operators.batches import shared_dir
from recordflow.operators.ingest import to_target_rows
from recordflow.operators.load import load_whole
from recordflow.plans.registry import query, table
from recordflow.sources import jdbc, parquet

KEYS = ["o_orderkey"]
ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]
NEW_KEYS = 1_000_000_000_000

_KEY = f"CASE WHEN l_quantity = 50 THEN NULL WHEN l_returnflag = 'R' THEN l_orderkey + {NEW_KEYS} ELSE l_orderkey END"
_PRICE = "CASE WHEN l_discount < 0.02 THEN NULL ELSE l_extendedprice END"
_OP = """CASE WHEN l_tax < 0.015 THEN 'insert' WHEN l_tax < 0.035 THEN 'Update' WHEN l_tax < 0.055 THEN 'UPSERT'
  WHEN l_tax < 0.075 THEN 'DELETE' ELSE 'TRUNCATE' END"""

# numbered changes; k is the key, rn the position within it
_C = f"""c AS (
  SELECT k AS o_orderkey, price AS o_totalprice, l_shipdate AS o_orderdate, l_returnflag, l_linenumber, op,
    row_number() OVER (PARTITION BY k ORDER BY {", ".join(ORDER)}) AS rn, count(*) OVER (PARTITION BY k) AS n
  FROM (SELECT *, {_KEY} AS k, {_PRICE} AS price, upper({_OP}) AS op FROM lineitem))"""


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders")


def changes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.expr(_KEY).alias("o_orderkey"), F.expr(_PRICE).alias("o_totalprice"), F.col("l_shipdate").alias("o_orderdate"),
        F.expr(_OP).alias("op"), *ORDER,
    )


_OUT = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _both(applied: keyed.Applied) -> DataFrame:
    """Table rows and rejects side by side, told apart by ``part``."""
    stored = applied.table.select(F.lit("table").alias("part"), *_OUT, F.lit(None).cast("string").alias("reason"))
    rejects = applied.rejects.select(
        F.lit("reject").alias("part"), *_OUT[:3], F.lit(None).cast("string").alias("o_orderpriority"),
        F.col(keyed.REASON).alias("reason"),
    )
    return stored.unionByName(rejects)


_STORED = "SELECT 'table' AS part, o_orderkey, o_totalprice, o_orderdate, o_orderpriority, NULL AS reason FROM orders"
_NULL_KEYS = "SELECT 'reject' AS part, o_orderkey, o_totalprice, o_orderdate, NULL AS o_orderpriority, 'key must not be null' AS reason FROM c WHERE o_orderkey IS NULL"


# ------------------------------------------------------------------- inserts
@query("keyed_insert", f"""
WITH {_C} {_STORED}
UNION ALL SELECT 'table', o_orderkey, o_totalprice, o_orderdate, NULL, NULL FROM c
  WHERE rn = 1 AND o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'reject', o_orderkey, o_totalprice, o_orderdate, NULL, 'key already present' FROM c
  WHERE o_orderkey IS NOT NULL AND (rn > 1 OR o_orderkey IN (SELECT o_orderkey FROM orders))
UNION ALL {_NULL_KEYS}""")
def keyed_insert(spark, sf_dir):
    return _both(keyed.insert(_orders(spark, sf_dir), changes(spark, sf_dir), KEYS, ORDER))


# every row of an order comes twice, and none of its rows is before another: one is stored, all others are rejects
_TIED = """rows AS (SELECT l_orderkey + CASE WHEN l_linenumber = 1 THEN 0 ELSE 60000000 END AS k FROM lineitem, (VALUES (1), (2)) twice(t))"""


def _tied(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") + F.when(F.col("l_linenumber") == 1, 0).otherwise(60_000_000)
    rows = items.select(key.alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"), F.lit(0).alias("seq"))
    return rows.unionByName(rows)


def _parts(done: keyed.Applied, known: DataFrame) -> DataFrame:
    """Rows the table gained or lost, and rows rejected."""
    count = lambda df, part: df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("part", F.lit(part))
    change = F.abs(F.col("row_count") - known.agg(F.count(F.lit(1))).scalar())
    return count(done.table, "applied").withColumn("row_count", change).unionByName(count(done.rejects, "reject"))


@query("keyed_insert_ties", f"""
WITH {_TIED}, new AS (SELECT k FROM rows WHERE k NOT IN (SELECT o_orderkey FROM orders))
SELECT 'applied' AS part, count(DISTINCT k) AS row_count FROM new
UNION ALL SELECT 'reject', (SELECT count(*) FROM rows) - (SELECT count(DISTINCT k) FROM new)""")
def keyed_insert_ties(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return _parts(keyed.insert(orders, _tied(spark, sf_dir), KEYS, ["seq"]), orders)


@query("keyed_delete_ties", f"""
WITH {_TIED}, gone AS (SELECT DISTINCT k FROM rows WHERE k IN (SELECT o_orderkey FROM orders))
SELECT 'applied' AS part, count(*) AS row_count FROM gone
UNION ALL SELECT 'reject', (SELECT count(*) FROM rows) - (SELECT count(*) FROM gone)""")
def keyed_delete_ties(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return _parts(keyed.delete(orders, _tied(spark, sf_dir), KEYS, ["seq"]), orders)


@query("keyed_insert_ignore", f"""
WITH {_C} SELECT o_orderkey, o_totalprice, o_orderdate, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, o_orderdate, NULL FROM c
  WHERE rn = 1 AND o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def keyed_insert_ignore(spark, sf_dir):
    return keyed.insert_ignore(_orders(spark, sf_dir), changes(spark, sf_dir), KEYS, ORDER).select(*_OUT)


# ---------------------------------------------------------- updates and upserts
_LAST = "SELECT * FROM c WHERE rn = n AND o_orderkey IS NOT NULL"


@query("keyed_upsert", f"""
WITH {_C}, last AS ({_LAST})
SELECT coalesce(l.o_orderkey, o.o_orderkey) AS o_orderkey,
  CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
  CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_orderdate ELSE o.o_orderdate END AS o_orderdate, o.o_orderpriority
FROM orders o FULL JOIN last l ON l.o_orderkey = o.o_orderkey""")
def keyed_upsert(spark, sf_dir):
    return keyed.upsert(_orders(spark, sf_dir), changes(spark, sf_dir), KEYS, ORDER).table.select(*_OUT)


@query("keyed_update", f"""
WITH {_C}, last AS ({_LAST})
SELECT 'table' AS part, o.o_orderkey, CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
  coalesce(l.o_orderdate, o.o_orderdate) AS o_orderdate, o.o_orderpriority, NULL AS reason
FROM orders o LEFT JOIN last l ON l.o_orderkey = o.o_orderkey
UNION ALL SELECT 'reject', o_orderkey, o_totalprice, o_orderdate, NULL, 'key not found' FROM c
  WHERE o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL {_NULL_KEYS}""")
def keyed_update(spark, sf_dir):
    return _both(keyed.update(_orders(spark, sf_dir), changes(spark, sf_dir), KEYS, ORDER))


@query("keyed_update_ignore", f"""
WITH {_C}, last AS ({_LAST})
SELECT o.o_orderkey, CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
  coalesce(l.o_orderdate, o.o_orderdate) AS o_orderdate, o.o_orderpriority
FROM orders o LEFT JOIN last l ON l.o_orderkey = o.o_orderkey""")
def keyed_update_ignore(spark, sf_dir):
    return keyed.update_ignore(_orders(spark, sf_dir), changes(spark, sf_dir), KEYS, ORDER).select(*_OUT)


@query("keyed_ignore_null", f"""
WITH {_C}, last AS (SELECT o_orderkey, max_by(o_totalprice, rn) FILTER (WHERE o_totalprice IS NOT NULL) AS price,
    max_by(o_orderdate, rn) AS d FROM c WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey)
SELECT coalesce(l.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(l.price, o.o_totalprice) AS o_totalprice,
  coalesce(l.d, o.o_orderdate) AS o_orderdate, o.o_orderpriority
FROM orders o FULL JOIN last l ON l.o_orderkey = o.o_orderkey""")
def keyed_ignore_null(spark, sf_dir):
    done = keyed.upsert(_orders(spark, sf_dir), changes(spark, sf_dir), KEYS, ORDER, ignore_null=True)
    return done.table.select(*_OUT)


# ------------------------------------------------------------------- deletes
# lines shipped before 1997 ask for their order to be removed
_EARLY = "l_shipdate < TIMESTAMP '1997-01-01 00:00:00'"
_DELETES = f"""d AS (SELECT o_orderkey, o_totalprice, o_orderdate,
    row_number() OVER (PARTITION BY o_orderkey ORDER BY rn) AS dn FROM c WHERE o_orderdate < TIMESTAMP '1997-01-01 00:00:00')"""


@query("keyed_delete", f"""
WITH {_C}, {_DELETES}
{_STORED} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM d WHERE o_orderkey IS NOT NULL)
UNION ALL SELECT 'reject', o_orderkey, o_totalprice, o_orderdate, NULL,
  CASE WHEN o_orderkey IS NULL THEN 'key must not be null' ELSE 'key not found' END
  FROM d WHERE o_orderkey IS NULL OR dn > 1 OR o_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def keyed_delete(spark, sf_dir):
    rows = changes(spark, sf_dir).filter(_EARLY)
    return _both(keyed.delete(_orders(spark, sf_dir), rows, KEYS, ORDER))


@query("keyed_delete_ignore", f"""
WITH {_C}, {_DELETES} SELECT o_orderkey, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM d WHERE o_orderkey IS NOT NULL)""")
def keyed_delete_ignore(spark, sf_dir):
    return keyed.delete_ignore(_orders(spark, sf_dir), changes(spark, sf_dir).filter(_EARLY), KEYS).select(*_OUT)


# ----------------------------------------------------------- all or nothing
@query("all_or_nothing", f"""
WITH {_C}, last AS (SELECT * FROM c WHERE rn = n AND o_orderkey IS NOT NULL)
SELECT 'insert' AS part, o_orderkey, o_totalprice, o_orderdate, o_orderpriority,
  (SELECT count(*) FROM c WHERE o_orderkey IS NULL OR rn > 1 OR o_orderkey IN (SELECT o_orderkey FROM orders)) AS rejected FROM orders
UNION ALL SELECT 'upsert', o_orderkey, o_totalprice, o_orderdate, o_orderpriority, (SELECT count(*) FROM c WHERE o_orderkey IS NULL) FROM orders
UNION ALL SELECT 'upsert of good rows', coalesce(l.o_orderkey, o.o_orderkey),
  CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_totalprice ELSE o.o_totalprice END,
  CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_orderdate ELSE o.o_orderdate END, o.o_orderpriority, 0
FROM orders o FULL JOIN last l ON l.o_orderkey = o.o_orderkey""")
def all_or_nothing(spark, sf_dir):
    """Loads with rejects leave the stored table as it was; one without any goes through."""
    rows = changes(spark, sf_dir)
    good, _ = keyed.required_not_null(rows, KEYS)
    path = shared_dir(spark)
    parts = []
    for name, operation, sent in (("insert", keyed.INSERT, rows), ("upsert", keyed.UPSERT, rows), ("upsert of good rows", keyed.UPSERT, good)):
        # each load meets a table of its own, as the query shows all three afterwards
        own = f"{path}/{len(parts)}"
        parquet.parquet_write(_orders(spark, sf_dir).select(*_OUT), own)
        loaded = load_whole(spark, own, sent, KEYS, ORDER, operation)
        parts.append(spark.read.parquet(own).select(F.lit(name).alias("part"), *_OUT, F.lit(loaded.rejected).cast("bigint").alias("rejected")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------------ mixed operations
def _fold(ignore_null: bool) -> str:
    price = "coalesce(c.o_totalprice, s.o_totalprice)" if ignore_null else "c.o_totalprice"
    fresh = "c.o_totalprice"
    return f"""
WITH RECURSIVE {_C.replace("PARTITION BY k ORDER", "PARTITION BY k, op = 'TRUNCATE' ORDER").replace(
        "count(*) OVER (PARTITION BY k)", "count(*) OVER (PARTITION BY k, op = 'TRUNCATE')")},
good AS (SELECT * FROM c WHERE o_orderkey IS NOT NULL AND op <> 'TRUNCATE'),
s AS (
  SELECT k.o_orderkey, CAST(0 AS BIGINT) AS rn, o.o_orderkey IS NOT NULL AS present, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
    CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS DOUBLE) AS in_price, CAST(NULL AS TIMESTAMP) AS in_date
  FROM (SELECT DISTINCT o_orderkey FROM good) k LEFT JOIN orders o ON o.o_orderkey = k.o_orderkey
  UNION ALL
  SELECT s.o_orderkey, c.rn, CASE c.op WHEN 'DELETE' THEN FALSE WHEN 'UPDATE' THEN s.present ELSE TRUE END,
    CASE WHEN c.op = 'DELETE' OR (c.op = 'UPDATE' AND NOT s.present) THEN NULL WHEN c.op = 'INSERT' AND s.present THEN s.o_totalprice
      WHEN s.present THEN {price} ELSE {fresh} END,
    CASE WHEN c.op = 'DELETE' OR (c.op = 'UPDATE' AND NOT s.present) THEN NULL WHEN c.op = 'INSERT' AND s.present THEN s.o_orderdate ELSE c.o_orderdate END,
    CASE WHEN s.present AND c.op <> 'DELETE' THEN s.o_orderpriority END,
    CASE WHEN c.op = 'INSERT' AND s.present THEN 'key already present' WHEN c.op IN ('UPDATE', 'DELETE') AND NOT s.present THEN 'key not found' END,
    c.o_totalprice, c.o_orderdate
  FROM s JOIN good c ON c.o_orderkey = s.o_orderkey AND c.rn = s.rn + 1)
SELECT 'table' AS part, o_orderkey, o_totalprice, o_orderdate, o_orderpriority, NULL AS reason FROM orders
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM good)
UNION ALL SELECT 'table', o_orderkey, o_totalprice, o_orderdate, o_orderpriority, NULL FROM s
  WHERE present AND rn = (SELECT max(n) FROM good g WHERE g.o_orderkey = s.o_orderkey)
UNION ALL SELECT 'reject', o_orderkey, in_price, in_date, NULL, reason FROM s WHERE reason IS NOT NULL
UNION ALL {_NULL_KEYS}
UNION ALL SELECT 'reject', o_orderkey, o_totalprice, o_orderdate, NULL, 'unknown operation' FROM c
  WHERE op = 'TRUNCATE' AND o_orderkey IS NOT NULL"""


def mixed_fold_table() -> str:
    return f"SELECT o_orderkey, o_totalprice, o_orderdate, o_orderpriority FROM ({_fold(False)}) WHERE part = 'table'"


@query("keyed_mixed_ops", _fold(False))
def keyed_mixed_ops(spark, sf_dir):
    done = keyed.apply_mixed(_orders(spark, sf_dir), changes(spark, sf_dir), KEYS, ORDER, "op", operations=keyed.ROW_OPERATIONS)
    return _both(done)


@query("keyed_mixed_ignore_null", _fold(True))
def keyed_mixed_ignore_null(spark, sf_dir):
    done = keyed.apply_mixed(_orders(spark, sf_dir), changes(spark, sf_dir), KEYS, ORDER, "op", ignore_null=True,
                             operations=keyed.ROW_OPERATIONS)
    return _both(done)


# ------------------------------------------------------------------ flagship
@query("keyed_ingest", f"""
WITH good AS (
  SELECT l_orderkey AS o_orderkey, l_extendedprice AS o_totalprice, l_shipdate + INTERVAL 9 HOUR AS o_orderdate,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(c + " DESC" for c in ORDER)}) AS rn
  FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F'))
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, coalesce(g.o_totalprice, o.o_totalprice) AS o_totalprice,
  coalesce(g.o_orderdate, o.o_orderdate) AS o_orderdate, o.o_orderpriority
FROM orders o LEFT JOIN good g ON g.o_orderkey = o.o_orderkey AND g.rn = 1""")
def keyed_ingest(spark, sf_dir):
    """Text rows in, typed and shifted, bad ones set aside, the rest upserted."""
    spoilt = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    text = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("o_orderkey"),
        F.when(spoilt, "n/a").otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("o_totalprice"),
        F.date_format("l_shipdate", "dd/MM/yyyy HH:mm:ss").alias("o_orderdate"), *ORDER,
    )
    stored = _orders(spark, sf_dir)
    typed = to_target_rows(text, stored.schema, KEYS, {"o_orderdate": "dd/MM/yyyy HH:mm:ss"}, hours=9, order=ORDER)
    good, _ = casts.split_rejects(typed)
    return keyed.upsert(stored, good, KEYS, ORDER).table


# ------------------------------------------------------------ schema and routing
@query("schema_drift_add_columns", f"""
WITH {_C}, last AS ({_LAST})
SELECT coalesce(l.o_orderkey, o.o_orderkey) AS o_orderkey,
  CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
  l.l_returnflag AS return_flag, l.l_linenumber AS line_number, o.o_orderpriority
FROM orders o FULL JOIN last l ON l.o_orderkey = o.o_orderkey""")
def schema_drift_add_columns(spark, sf_dir):
    from recordflow.operators.schema import schema_drift_add_columns as widen

    rows = changes(spark, sf_dir).withColumns({"return_flag": F.col("l_returnflag"), "line_number": F.col("l_linenumber")})
    incoming = rows.select("o_orderkey", "o_totalprice", "return_flag", "line_number")
    target = widen(_orders(spark, sf_dir), incoming)
    done = keyed.upsert(target, rows.select(*incoming.columns, *ORDER), KEYS, ORDER)
    return done.table.select("o_orderkey", "o_totalprice", "return_flag", "line_number", "o_orderpriority")


@query("reject_routing", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag <> 'R' AND l_linestatus <> 'O' AS accepted,
  CASE WHEN l_returnflag = 'R' THEN 'qty' WHEN l_linestatus = 'O' THEN 'shipped' END AS first_bad,
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS INTEGER) AS n_bad
FROM lineitem""")
def reject_routing(spark, sf_dir):
    q = F.col("l_quantity").cast("decimal(9,0)").cast("string")
    text = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "R", F.concat(q, F.lit("?"))).otherwise(q).alias("qty"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"), "l_linestatus",
    )
    late = F.when(F.col("l_linestatus") == "O", F.col("shipped")).otherwise(F.concat("shipped", F.lit(" 00:00:00")))
    typed = casts.convert(text.withColumn("shipped", late), {"qty": "int"})
    typed = ts.parse_timestamp_columns(typed, ["shipped"])
    good, bad = casts.split_rejects(typed)
    r = F.col(casts.REJECTS)
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    return good.select(*ids, F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("first_bad"),
                       F.lit(0).alias("n_bad")).unionByName(
        bad.select(*ids, F.lit(False).alias("accepted"), F.get(r, F.lit(0))["column"].alias("first_bad"), F.size(r).alias("n_bad")))


@query("required_not_null", """
SELECT doc_id, CASE WHEN lang = 'de' THEN 'lang must not be null' END AS reason FROM documents""")
def required_not_null(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") != "de", F.col("lang")).alias("lang"), "source")
    good, bad = keyed.required_not_null(docs, ["doc_id", "lang"])
    return good.select("doc_id", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("doc_id", F.col(keyed.REASON).alias("reason")))


@query("op_from_column", """
SELECT event_id, upper(event_type) AS op, CASE WHEN event_type NOT IN ('click', 'view') THEN 'unknown operation' END AS reason
FROM events""")
def op_from_column(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("op"))
    good, bad = keyed.op_from_column(e, "op", ("CLICK", "VIEW"))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.withColumnRenamed(keyed.REASON, "reason"))


# --------------------------------------------------------------------- matching
@query("match_existing", f"WITH {_C} SELECT o_orderkey, rn FROM c WHERE o_orderkey IN (SELECT o_orderkey FROM orders)".replace("SELECT o_orderkey, rn", "SELECT o_orderkey, l_linenumber, o_totalprice"))
def match_existing(spark, sf_dir):
    return keyed.match_existing(changes(spark, sf_dir), _orders(spark, sf_dir), KEYS).select("o_orderkey", "l_linenumber", "o_totalprice")


@query("match_absent", f"""WITH {_C} SELECT o_orderkey, l_linenumber, o_totalprice FROM c
WHERE o_orderkey IS NULL OR o_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def match_absent(spark, sf_dir):
    return keyed.match_absent(changes(spark, sf_dir), _orders(spark, sf_dir), KEYS).select("o_orderkey", "l_linenumber", "o_totalprice")


@query("merge_by_key", """
SELECT c.c_custkey, c.c_name, CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_acctbal ELSE c.c_acctbal END AS c_acctbal, c.c_mktsegment
FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey
UNION ALL SELECT s_suppkey, NULL, s_acctbal, NULL FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)""")
def merge_by_key(spark, sf_dir):
    stored = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    new = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return keyed.merge_by_key(stored, new, ["c_custkey"])


_SEGMENTED = "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END"


@query("match_all_columns", f"""
SELECT a.c_custkey, a.seg FROM (SELECT *, {_SEGMENTED} AS seg FROM customer) a
WHERE EXISTS (SELECT 1 FROM (SELECT *, {_SEGMENTED} AS seg FROM customer) b WHERE b.c_custkey + 5 = a.c_custkey
  AND a.c_nationkey = b.c_nationkey AND a.seg IS NOT DISTINCT FROM b.seg)
  OR (a.seg IS NULL AND a.c_nationkey IS NOT NULL AND EXISTS (SELECT 1 FROM customer b WHERE b.c_custkey = a.c_custkey AND b.c_mktsegment = 'BUILDING'))""")
def match_all_columns(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.expr(_SEGMENTED).alias("seg"))
    moved = c.select((F.col("c_custkey") + 5).alias("c_custkey"), "c_nationkey", "seg")
    same = c.filter(F.col("seg").isNull())
    return keyed.match_all_columns(c, moved.unionByName(same)).select("c_custkey", "seg")


@query("null_safe_match", f"""
SELECT a.c_custkey, a.seg FROM (SELECT *, {_SEGMENTED} AS seg FROM customer) a
WHERE EXISTS (SELECT 1 FROM (SELECT *, {_SEGMENTED} AS seg FROM customer) b WHERE b.c_custkey = a.c_custkey + 1
  AND a.seg IS NOT DISTINCT FROM b.seg)""")
def null_safe_match(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_SEGMENTED).alias("seg"))
    back = c.select((F.col("c_custkey") - 1).alias("c_custkey"), "seg")
    return keyed.match_all_columns(c, back)


# ------------------------------------------------ rows staged for a database write
# The database half is one statement; what Spark computes is the staged rows and the rejects.
def _staged(operation: str):
    def run(spark, sf_dir):
        info = jdbc.TableInfo(["O_ORDERKEY", "O_TOTALPRICE", "O_ORDERDATE"], ["O_ORDERKEY"], ["O_ORDERKEY"])
        plan = jdbc.plan_write(changes(spark, sf_dir), jdbc.Database("jdbc:none:"), '"ORDERS"', info, operation, ORDER)
        return plan.rows.withColumn("reason", F.lit(None).cast("string")).unionByName(
            plan.rejects.withColumnRenamed(keyed.REASON, "reason"))

    return run


_ROW = 'o_orderkey AS "O_ORDERKEY", o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE"'
_ALL_STAGED = f"WITH {_C} SELECT {{}} {_ROW}, NULL AS reason FROM c"
_WINNERS_STAGED = f"""WITH {_C} SELECT {_ROW}, NULL AS reason FROM c WHERE o_orderkey IS NOT NULL AND {{}}
UNION ALL SELECT {_ROW}, 'key must not be null' FROM c WHERE o_orderkey IS NULL"""
query("jdbc_insert", _ALL_STAGED.format(""))(_staged("INSERT"))
query("jdbc_update", _WINNERS_STAGED.format("rn = n"))(_staged("UPDATE"))
query("jdbc_upsert", _WINNERS_STAGED.format("rn = n"))(_staged("UPSERT"))
query("jdbc_insert_ignore", _WINNERS_STAGED.format("rn = 1"))(_staged("INSERT_IGNORE"))
query("jdbc_delete", _ALL_STAGED.format("DISTINCT"))(_staged("DELETE"))


# ------------------------------------------------------------------------ counts
@query("errors_by_file", """
WITH per AS (SELECT source, lang || ' not accepted' AS reason, count(*) AS n, min(doc_id) AS place FROM documents WHERE lang <> 'en' GROUP BY 1, 2)
SELECT source, CAST(sum(n) AS BIGINT) AS rejected, string_agg(reason || ': ' || CAST(n AS VARCHAR), '; ' ORDER BY place) AS reasons
FROM per GROUP BY source""")
def errors_by_file(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").filter(F.col("lang") != "en")
    bad = docs.withColumn(keyed.REASON, F.concat("lang", F.lit(" not accepted")))
    out = keyed.errors_by_file(bad, "source", ["doc_id"])
    text = F.transform("reasons", lambda r: F.concat_ws(": ", r["reason"], r["row_count"].cast("string")))
    return out.select("source", "rejected", F.array_join(text, "; ").alias("reasons"))


@query("counts_by_op", f"SELECT upper({_OP}) AS operation, count(*) AS row_count FROM lineitem GROUP BY 1")
def counts_by_op(spark, sf_dir):
    return keyed.counts_by_op(changes(spark, sf_dir), "op")


@query("record_counts", """
SELECT source, count(*) AS total_rows, count(*) FILTER (WHERE n_chars > 500) AS rejected_rows,
  count(*) FILTER (WHERE NOT n_chars > 500) AS accepted_rows, CAST(ceil(count(*) / 100.0) AS BIGINT) AS batches
FROM documents GROUP BY source""")
def record_counts(spark, sf_dir):
    return keyed.record_counts(table(spark, sf_dir, "documents"), "source", F.col("n_chars") > 500, 100)


_LATEST = "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {}) = 1"


@query("latest_per_key", _LATEST.format(", ".join(f"{c} DESC" for c in ORDER)))
def latest_per_key(spark, sf_dir):
    rows = keyed.latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("first_per_key", _LATEST.format(", ".join(ORDER)))
def first_per_key(spark, sf_dir):
    rows = keyed.first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
