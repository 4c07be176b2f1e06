"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from recordflow.functions import casts
from recordflow.operators import keyed, skew
from recordflow.plans.keyed_queries import KEYS, ORDER, changes
from recordflow.plans.registry import table

SF = "/root/testdata/sf0.001"


@pytest.fixture
def large(spark):
    """Plans as for tables too large to broadcast."""
    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in keep.items():
        spark.conf.set(k, v)
    yield spark
    for k in keep:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", text))


def test_winners_are_pruned_before_the_shuffle(large):
    text = plan(keyed.latest_per_key(changes(large, SF), KEYS, ORDER))
    assert exchanges(text) == 1
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "WindowGroupLimit" in text[: text.index("Exchange")]


def test_upsert_shuffles_each_side_once(large):
    done = keyed.upsert(table(large, SF, "orders"), changes(large, SF), KEYS, ORDER)
    text = plan(done.table)
    assert exchanges(text) == 2 and "SortMergeJoin" in text and "Broadcast" not in text


def test_small_changes_leave_the_target_in_place(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(keyed.update_ignore(table(spark, SF, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
                                        changes(spark, SF).select(*KEYS, *[o for o in ORDER]), KEYS, ORDER))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in text


def test_mixed_operations_shuffle_the_changes_once(large):
    done = keyed.apply_mixed(table(large, SF, "orders"), changes(large, SF).withColumn("op", F.upper("op")), KEYS, ORDER, "op", ranges=skew.Ranges())
    # the changes, the keys of the target, and the target
    assert exchanges(plan(done.table)) == 3


@pytest.mark.parametrize("op", ["insert", "delete", "update"])
def test_no_cross_joins(large, op):
    done = getattr(keyed, op)(table(large, SF, "orders"), changes(large, SF), KEYS, ORDER, hot=skew.NO_HOT)
    for df in (done.table, done.rejects):
        assert not re.search("CartesianProduct|NestedLoop", plan(df))


def test_only_needed_columns_are_read(large):
    text = plan(keyed.match_existing(table(large, SF, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), table(large, SF, "orders"), KEYS))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {"l_orderkey:bigint", "o_orderkey:bigint"}
    text = plan(table(large, SF, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text


def test_conversions_run_once_in_generated_code(large):
    text_rows = table(large, SF, "orders").select(F.col("o_custkey").cast("string").alias("n"))
    good, _ = casts.split_rejects(casts.convert(text_rows, {"n": "bigint"}))
    text = plan(good)
    assert text.count("RLIKE(") == 1, text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
