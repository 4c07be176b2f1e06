"""Threshold alerts over ``events`` (series, time, value) and usage rules over ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordflow.operators import alerts
from recordflow.plans.registry import query, table

LIMIT, HOURS = 300.0, 6


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


def _usage(spark, sf_dir) -> DataFrame:
    """Line items as capacity readings: the price is the total, discount and tax leave that share free."""
    total = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", total.alias("total"),
        F.when(F.col("l_linenumber") == 7, 0.0).otherwise(total * F.col("l_discount")).alias("free"),
    ).withColumn("total", F.when(F.col("l_linenumber") == 6, 0.0).otherwise(F.col("total")))


_USAGE_SQL = """(SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber = 6 THEN 0.0 ELSE l_extendedprice END AS total,
  CASE WHEN l_linenumber = 7 THEN 0.0 ELSE l_extendedprice * l_discount END AS free FROM lineitem)"""


@query("usage_percent", f"""
SELECT l_orderkey, l_partkey, l_linenumber, total - free AS used, CASE WHEN total <> 0 THEN (total - free) / total * 100.0 END AS used_percent,
  CASE WHEN total <> 0 THEN free / total * 100.0 END AS free_percent FROM {_USAGE_SQL}""")
def usage_percent(spark, sf_dir):
    return alerts.usage_percent(_usage(spark, sf_dir), "total", "free").drop("total", "free")


@query("threshold_filter", f"""
SELECT l_orderkey, l_partkey, l_linenumber, 'disk' AS rule FROM {_USAGE_SQL} WHERE total <> 0 AND (total - free) / total * 100.0 >= 95.0
UNION ALL SELECT l_orderkey, l_partkey, l_linenumber, 'pool' FROM {_USAGE_SQL} WHERE total - free > trunc(total * (95.0 / 100.0))
UNION ALL SELECT l_orderkey, l_partkey, l_linenumber, 'size' FROM {_USAGE_SQL} WHERE total - free > 65536
UNION ALL SELECT l_orderkey, l_partkey, l_linenumber, 'count' FROM {_USAGE_SQL} WHERE l_linenumber > 5""")
def threshold_filter(spark, sf_dir):
    u = _usage(spark, sf_dir).withColumn("used", F.col("total") - F.col("free"))
    ids = ["l_orderkey", "l_partkey", "l_linenumber"]
    rule = lambda df, name: df.select(*ids, F.lit(name).alias("rule"))
    return (
        rule(alerts.threshold_filter(u, "used", "95%", "total", inclusive=True), "disk")
        .unionByName(rule(alerts.threshold_filter(u, "used", "95%", "total"), "pool"))
        .unionByName(rule(alerts.threshold_filter(u, "used", "64 KB"), "size"))
        .unionByName(rule(alerts.threshold_filter(u, "l_linenumber", 5), "count"))
    )


@query("alert_every_breach", "SELECT event_id, user_id, value FROM events WHERE value > 300.0")
def alert_every_breach(spark, sf_dir):
    return alerts.alert_every_breach(_events(spark, sf_dir), "value", LIMIT).select("event_id", "user_id", "value")


@query("breach_edges", """
SELECT event_id, user_id, CASE WHEN x THEN 'UP' ELSE 'DOWN' END AS edge FROM (
  SELECT *, coalesce(lag(x) OVER (PARTITION BY user_id ORDER BY ts, event_id), FALSE) AS before FROM (SELECT *, value > 300.0 AS x FROM events))
WHERE x <> before""")
def breach_edges(spark, sf_dir):
    e = alerts.breach_edges(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], F.col("value") > LIMIT)
    return e.select("event_id", "user_id", "edge")


# five series hold all the rows, so each one is scanned in ranges
@query("breach_edges_hot", """
SELECT event_id, event_type, CASE WHEN x THEN 'UP' ELSE 'DOWN' END AS edge FROM (
  SELECT *, coalesce(lag(x) OVER (PARTITION BY event_type ORDER BY ts, event_id), FALSE) AS before FROM (SELECT *, value > 300.0 AS x FROM events))
WHERE x <> before""")
def breach_edges_hot(spark, sf_dir):
    e = alerts.breach_edges(_events(spark, sf_dir), ["event_type"], ["ts", "event_id"], F.col("value") > LIMIT)
    return e.select("event_id", "event_type", "edge")


def _walk_sql(series: str, interval: str, limit: float = LIMIT) -> str:
    """The sequential rule, one reading per step."""
    emit = f"(e.x AND (s.last IS NULL OR e.ts >= s.last + INTERVAL {interval}))"
    return f"""
WITH RECURSIVE e AS (SELECT {series} AS series, event_id, ts, value > {limit} AS x,
    row_number() OVER (PARTITION BY {series} ORDER BY ts, event_id) AS rn FROM events),
s AS (
  SELECT DISTINCT series, CAST(0 AS BIGINT) AS rn, FALSE AS flag, CAST(NULL AS TIMESTAMP) AS last,
    CAST(NULL AS VARCHAR) AS event, CAST(NULL AS BIGINT) AS event_id FROM e
  UNION ALL
  SELECT s.series, e.rn, CASE WHEN {emit} THEN TRUE WHEN NOT e.x THEN FALSE ELSE s.flag END,
    CASE WHEN {emit} OR (NOT e.x AND s.flag) THEN e.ts ELSE s.last END,
    CASE WHEN {emit} THEN 'ALERT' WHEN NOT e.x AND s.flag THEN 'RECOVERED' END, e.event_id
  FROM s JOIN e ON e.series = s.series AND e.rn = s.rn + 1)
SELECT event_id, series AS {series}"""


@query("alert_suppress", _walk_sql("user_id", f"{HOURS} HOUR") + " FROM s WHERE event = 'ALERT'")
def alert_suppress(spark, sf_dir):
    out = alerts.alert_suppress(_events(spark, sf_dir), ["user_id"], "ts", F.col("value") > LIMIT, HOURS * 3600, ["event_id"], keep=["event_id", "user_id"])
    return out.select("event_id", "user_id")


@query("alert_recovered", _walk_sql("user_id", f"{HOURS} HOUR") + " FROM s WHERE event = 'RECOVERED'")
def alert_recovered(spark, sf_dir):
    out = alerts.alert_recovered(_events(spark, sf_dir), ["user_id"], "ts", F.col("value") > LIMIT, HOURS * 3600, ["event_id"], keep=["event_id", "user_id"])
    return out.select("event_id", "user_id")


@query("alert_suppress_hot", _walk_sql("event_type", "45 MINUTE", 150.0) + ", event FROM s WHERE event IS NOT NULL")
def alert_suppress_hot(spark, sf_dir):
    out = alerts.alert_events(_events(spark, sf_dir), ["event_type"], "ts", F.col("value") > 150.0, 45 * 60, ["event_id"], keep=["event_id", "event_type"])
    return out.select("event_id", "event_type", "event")


@query("alert_payload", """
SELECT event_id, '{"type":"DiskUsage","pathName":"' || event_type || '","threshold":80,"usedSpace":' || CASE WHEN event_type = 'error' THEN 'null' ELSE CAST(user_id AS VARCHAR) END || '}' AS payload
FROM events WHERE value > 300.0""")
def alert_payload(spark, sf_dir):
    used = F.when(F.col("event_type") != "error", F.col("user_id"))
    payload = alerts.alert_payload({"pathName": F.col("event_type"), "threshold": F.lit(80), "usedSpace": used}, "DiskUsage")
    return alerts.alert_every_breach(_events(spark, sf_dir), "value", LIMIT).select("event_id", payload.alias("payload"))
