"""Replay, versions and clean-up of the streaming sinks."""

from pyspark.sql import functions as F

from recordflow.operators import keyed
from recordflow.streaming.ingest import BucketedTable, stream_keyed_apply
from tests.test_keyed import KEYS, ORDER, TARGET, fold, make, table_of


def loaded(spark, tmp_path, target):
    table = BucketedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], TARGET).schema, KEYS, buckets=4)
    table.load(spark.createDataFrame(target, TARGET))
    return table


def run(stream, table, path, **kw):
    stream_keyed_apply(stream, table, ORDER, "op", f"{path}/rejects", f"{path}/check", **kw).trigger(availableNow=True).start().awaitTermination()


def write_in_order(changes, path, cuts):
    for low, high in zip(cuts[:-1], cuts[1:]):
        changes.filter((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(path)


def test_batches_add_up_and_a_replay_changes_nothing(spark, tmp_path):
    target, rows, _, c = make(spark, 11, n=200)
    table = loaded(spark, tmp_path, target)
    source = str(tmp_path / "in")
    write_in_order(c, source, [0, 50, 120, 200])
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(source)
    run(stream, table, tmp_path)
    want, rejected = fold(target, rows)
    assert table_of(table.read()) == want
    got = spark.read.parquet(f"{tmp_path}/rejects/*")
    assert sorted(r["seq"] for r in got.collect()) == rejected

    # the last batch again, as after a failure between its write and its commit
    last = table.versions()[-1]
    before = table.read(last - 1)
    assert table_of(before) == fold(target, [r for r in rows if r[0] < 120])[0]
    batch = c.filter("seq >= 120")
    touched = [r["b"] for r in batch.select(table.bucket().alias("b")).distinct().collect()]
    done = keyed.apply_mixed(table.read(last - 1, touched), batch, KEYS, ORDER, "op")
    table.write(done.table, last, touched)
    assert table_of(table.read()) == want


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    target = [(i, i, "", "") for i in range(40)]
    table = loaded(spark, tmp_path, target)
    one = spark.createDataFrame([(0, 7, None, None, "DELETE")], "seq bigint, id bigint, a bigint, b string, op string")
    touched = [r["b"] for r in one.select(table.bucket().alias("b")).collect()]
    table.write(keyed.apply_mixed(table.read(-1, touched), one, KEYS, ORDER, "op").table, 0, touched)
    at = table.current()
    assert sorted(at.values()) == [-1, -1, -1, 0] and at[touched[0]] == 0
    assert table.read().count() == 39


def test_an_emptied_bucket_stays_empty_and_old_versions_go(spark, tmp_path):
    table = loaded(spark, tmp_path, [(1, 1, "", "")])
    gone = spark.createDataFrame([(0, 1, None, None, "DELETE")], "seq bigint, id bigint, a bigint, b string, op string")
    touched = [r["b"] for r in gone.select(table.bucket().alias("b")).collect()]
    table.write(keyed.apply_mixed(table.read(-1, touched), gone, KEYS, ORDER, "op").table, 0, touched)
    assert table.read().count() == 0
    back = gone.withColumn("op", F.lit("INSERT"))
    for v in (1, 2):
        table.write(keyed.apply_mixed(table.read(v - 1, touched), back, KEYS, ORDER, "op").table, v, touched)
    assert table.read().count() == 1
    assert table.vacuum(keep=1) >= 1
    assert table.read().count() == 1


def test_a_version_without_its_manifest_does_not_count(spark, tmp_path):
    table = loaded(spark, tmp_path, [(1, 1, "", "")])
    spark.createDataFrame([(2, 2, "", "")], TARGET).withColumn("bucket", table.bucket()).write.partitionBy("bucket").parquet(f"{table.path}/data/v=5")
    assert table.versions() == [-1] and table_of(table.read()) == [(1, 1, "", "")]


def test_many_files_come_in_few_batches_in_their_order(spark, tmp_path):
    from recordflow.plans.stream_queries import BATCHES, _in_batches

    rows = spark.range(40).repartition(20, "id")
    for _ in range(2):
        rows.write.mode("append").parquet(f"{tmp_path}/in")
    seen = []
    stream = _in_batches(spark, rows, f"{tmp_path}/in")
    note = lambda batch, n: seen.append(batch.count())
    stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    assert 1 < len(seen) <= BATCHES and sum(seen) == 80
