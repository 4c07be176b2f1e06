"""Streaming queries: tables arrive as files in order, run to the end, and are compared with the batch answer."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F, types as T

from recordflow.functions import casts
from recordflow.operators.batches import shared_dir
from recordflow.plans.alert_queries import _walk_sql
from recordflow.plans.keyed_queries import KEYS, ORDER, changes, mixed_fold_table
from recordflow.plans.registry import query, table
from recordflow.sources import csv
from recordflow.streaming.alerts import stream_alert_events
from recordflow.streaming.ingest import BucketedTable, stream_file_ingest, stream_keyed_apply, stream_reject_route


def _finish(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _customer_files(spark, sf_dir) -> str:
    path = shared_dir(spark)
    c = table(spark, sf_dir, "customer")
    balance = F.when(F.col("c_mktsegment") == "MACHINERY", "unknown").otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    rows = c.select("c_custkey", "c_name", balance.alias("balance"), "c_mktsegment")
    csv.csv_write(rows, f"{path}/in")
    return path


_TEXT = T.StructType([T.StructField(n, T.StringType()) for n in ("c_custkey", "c_name", "balance", "c_mktsegment")])


@query("stream_file_ingest", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def stream_ingest(spark, sf_dir):
    path = _customer_files(spark, sf_dir)
    rows = stream_file_ingest(spark, f"{path}/in", _TEXT, max_files=1)
    typed = rows.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment")
    _finish(typed.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/check"))
    return spark.read.parquet(f"{path}/out")


@query("stream_reject_route", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'balance' END AS bad_column,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS balance FROM customer""")
def stream_rejects(spark, sf_dir):
    path = _customer_files(spark, sf_dir)
    rows = stream_file_ingest(spark, f"{path}/in", _TEXT, max_files=1).drop("_file")
    convert = lambda batch: casts.convert(batch, {"c_custkey": "bigint", "balance": "double"})
    _finish(stream_reject_route(rows, convert, f"{path}/good", f"{path}/bad", f"{path}/check"))
    good, bad = spark.read.parquet(f"{path}/good/*"), spark.read.parquet(f"{path}/bad/*")
    return good.select("c_custkey", F.lit(None).cast("string").alias("bad_column"), "balance").unionByName(
        bad.select("c_custkey", F.get(casts.REJECTS, F.lit(0))["column"].alias("bad_column"), F.lit(None).cast("double").alias("balance")))


def _in_slices(rows: DataFrame, by: str, keys: list[str], path: str, slices: list[tuple]) -> None:
    """Files in the order of ``by``; rows of one key and slice stay in one file."""
    for low, high in slices:
        part = rows.filter((F.col(by) >= F.lit(low)) & (F.col(by) < F.lit(high)))
        part.repartition(*keys).write.mode("append").parquet(path)


#: A micro-batch costs a round of the state or of the stored table, so there are at most so many, whatever the number of files.
BATCHES = 6


def _in_batches(spark, rows: DataFrame, path: str) -> DataFrame:
    """Written files as a stream: the oldest first, one or a share of them a micro-batch."""
    files = len(spark.read.schema(rows.schema).parquet(path).inputFiles())
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, math.ceil(files / BATCHES))).parquet(path)


@query("stream_keyed_apply", mixed_fold_table())
def stream_keyed(spark, sf_dir):
    path = shared_dir(spark)
    rows = changes(spark, sf_dir).withColumn("op", F.upper("op"))
    _in_slices(rows, "l_linenumber", KEYS, f"{path}/in", [(0, 3), (3, 5), (5, 1 << 30)])
    orders = table(spark, sf_dir, "orders")
    target = BucketedTable(spark, f"{path}/table", orders.schema, KEYS, buckets=8)
    target.load(orders)
    stream = _in_batches(spark, rows, f"{path}/in")
    _finish(stream_keyed_apply(stream, target, ORDER, "op", f"{path}/rejects", f"{path}/check"))
    return target.read().select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("stream_alerts", _walk_sql("user_id", "6 HOUR") + ", event FROM s WHERE event IS NOT NULL")
def stream_alerts(spark, sf_dir):
    path = shared_dir(spark)
    rows = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    day = lambda n: F.expr(f"TIMESTAMP '2024-01-01 00:00:00' + INTERVAL {n} DAY")
    for low, high in ((-100_000, 10), (10, 20), (20, 100_000)):
        part = rows.filter((F.col("at") >= day(low)) & (F.col("at") < day(high)))
        part.repartition("user_id").write.mode("append").parquet(f"{path}/in")
    stream = _in_batches(spark, rows, f"{path}/in")
    found = stream_alert_events(stream, "user_id", "at", "event_id", F.col("value") > 300.0, 6 * 3600)
    _finish(found.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/check"))
    return spark.read.parquet(f"{path}/out").select("event_id", "user_id", "event")
