import pytest
from pyspark.sql import functions as F

from recordflow.operators import keyed, load
from recordflow.sources import parquet

SCHEMA = "seq int, id bigint, a bigint"


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "stored")
    parquet.parquet_write(spark.createDataFrame([(1, 10, "x"), (2, 20, "y")], "id bigint, a bigint, b string"), path)
    return path


def rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


BEFORE = [(1, 10, "x"), (2, 20, "y")]


@pytest.mark.parametrize("operation, sent, rejected, after", [
    ("INSERT", [(0, 3, 5), (1, 4, 6)], 0, [*BEFORE, (3, 5, None), (4, 6, None)]),
    ("INSERT", [(0, 3, 5), (1, 3, 6), (2, 1, 7), (3, None, 8)], 3, BEFORE),
    ("INSERT_IGNORE", [(0, 3, 5), (1, 3, 6), (2, 1, 7), (3, None, 8)], 0, [*BEFORE, (3, 5, None)]),
    ("UPSERT", [(0, 1, 5), (1, 1, 6), (2, 3, 7)], 0, [(1, 6, "x"), (2, 20, "y"), (3, 7, None)]),
    ("UPSERT", [(0, 1, 5), (1, None, 6)], 1, BEFORE),
    ("UPSERT", [(0, None, 5), (1, None, 6)], 2, BEFORE),
    ("UPDATE", [(0, 1, 5), (1, 9, 6)], 1, BEFORE),
    ("DELETE", [(0, 1, 5)], 0, [(2, 20, "y")]),
    ("DELETE", [(0, 1, 5), (1, 1, 5)], 1, BEFORE),
    ("DELETE_IGNORE", [(0, 1, 5), (1, 2, 5), (2, 9, 5)], 0, []),
    ("UPSERT", [], 0, BEFORE),
])
def test_all_or_nothing_loads(spark, stored, tmp_path, operation, sent, rejected, after):
    done = load.load_whole(spark, stored, spark.createDataFrame(sent, SCHEMA), ["id"], ["seq"], operation)
    assert (done.rows, done.rejected, done.committed) == (len(sent), rejected, rejected == 0)
    assert rows(spark, stored) == after
    assert [p.name for p in tmp_path.iterdir()] == ["stored"]


def test_many_tasks_and_counts(spark, stored):
    sent = spark.range(0, 50_000, 1, 16).select(F.col("id").cast("int").alias("seq"), (F.col("id") % 40_000 + 1).alias("id"), F.col("id").alias("a"))
    done = load.load_whole(spark, stored, sent, ["id"], ["seq"], "INSERT")
    assert (done.rows, done.rejected) == (50_000, 10_002) and rows(spark, stored) == BEFORE
    done = load.load_whole(spark, stored, sent, ["id"], ["seq"], "UPSERT")
    assert done.committed and spark.read.parquet(stored).count() == 40_000


def test_unknown_operation(spark, stored):
    with pytest.raises(ValueError, match="unknown operation"):
        load.load_whole(spark, stored, spark.createDataFrame([], SCHEMA), ["id"], ["seq"], "MERGE")


def test_a_failing_load_leaves_the_table(spark, stored, tmp_path):
    bad = spark.createDataFrame([(0, 3, 5)], SCHEMA).withColumn("a", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        load.load_whole(spark, stored, bad, ["id"], ["seq"], "UPSERT")
    assert rows(spark, stored) == BEFORE and [p.name for p in tmp_path.iterdir()] == ["stored"]


def test_plain_form_still_raises(spark, stored):
    sent = spark.createDataFrame([(0, None, 5)], SCHEMA)
    with pytest.raises(keyed.RejectedRows):
        keyed.all_or_nothing(keyed.upsert(spark.read.parquet(stored), sent, ["id"], ["seq"]))


def test_a_hot_key(spark, stored):
    sent = spark.range(0, 30_000, 1, 8).select(
        F.col("id").cast("int").alias("seq"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") + 10).alias("id"),
        F.col("id").alias("a"))
    done = load.load_whole(spark, stored, sent, ["id"], ["seq"], "INSERT")
    assert (done.rows, done.rejected) == (30_000, 10_000 + 9_999) and rows(spark, stored) == BEFORE
    done = load.load_whole(spark, stored, sent.filter("id is not null"), ["id"], ["seq"], "UPSERT")
    assert (done.rows, done.rejected) == (20_000, 0)
    assert spark.read.parquet(stored).filter("id = 7").first()["a"] == 29_997 and spark.read.parquet(stored).count() == 10_003
