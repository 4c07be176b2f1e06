import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from recordflow.operators import batches
from recordflow.sources import parquet


def first_file(path):
    return next(path.glob("*.parquet"))


def test_writer_options_reach_the_file(spark, tmp_path):
    df = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("id"), F.concat(F.lit("value "), F.col("id") % 7).alias("s"))
    parquet.parquet_write(df.coalesce(1), str(tmp_path / "z"), compression="zstd", row_group_size="64 KB", page_size="8 KB",
                          dictionary_page_size="8 KB", dictionary=False, writer_version="PARQUET_2_0", validation=True, max_padding_size="1 MB")
    meta = pq.ParquetFile(first_file(tmp_path / "z")).metadata
    column = meta.row_group(0).column(1)
    assert column.compression == "ZSTD" and "RLE_DICTIONARY" not in column.encodings and "PLAIN_DICTIONARY" not in column.encodings
    assert meta.num_row_groups > 1
    parquet.parquet_write(df.coalesce(1), str(tmp_path / "d"))
    plain = pq.ParquetFile(first_file(tmp_path / "d")).metadata.row_group(0).column(1)
    assert plain.compression == "SNAPPY" and any("DICTIONARY" in e for e in plain.encodings)


def test_bad_options_fail_early():
    for bad in ({"compression": "zip"}, {"page_size": "many"}, {"writer_version": "v9"}):
        with pytest.raises((ValueError, KeyError)):
            parquet.writer_options(**bad)


def test_overwrite_or_refuse(spark, tmp_path):
    path = str(tmp_path / "t")
    parquet.parquet_write(spark.range(3), path)
    with pytest.raises(Exception, match="exists"):
        parquet.parquet_write(spark.range(4), path, overwrite=False)
    assert spark.read.parquet(path).count() == 3
    parquet.parquet_write(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4


def test_failed_overwrite_keeps_old_files(spark, tmp_path):
    path = str(tmp_path / "t")
    parquet.parquet_write(spark.range(3), path)
    with pytest.raises(Exception, match="stop here"):
        parquet.parquet_write(spark.range(9).selectExpr("if(id < 8, id, raise_error('stop here')) AS id"), path)
    assert spark.read.parquet(path).count() == 3
    parquet.parquet_write(spark.read.parquet(path).union(spark.range(2)), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_legacy_lists_and_setting_is_restored(spark, tmp_path):
    df = spark.sql("SELECT array(1, 2) AS a")
    parquet.parquet_write(df, str(tmp_path / "old"), legacy_lists=True)
    parquet.parquet_write(df, str(tmp_path / "new"))
    schema = lambda d: str(pq.ParquetFile(first_file(tmp_path / d)).schema)
    assert "element" in schema("new") and "element" not in schema("old")
    assert spark.conf.get("spark.sql.parquet.writeLegacyFormat") == "false"


def test_int96(spark, tmp_path):
    at = dt.datetime(2016, 2, 3, 7, 55, 29, 123456)
    df = spark.createDataFrame([(1, at)], "id int, registration_dttm timestamp")
    parquet.parquet_write_int96(df, str(tmp_path / "i"))
    parquet.parquet_write_int96(df, str(tmp_path / "m"), int96=False)
    kind = lambda d: pq.ParquetFile(first_file(tmp_path / d)).schema.column(1).physical_type
    assert (kind("i"), kind("m")) == ("INT96", "INT64")
    assert spark.read.parquet(str(tmp_path / "i")).first()["registration_dttm"] == at


def test_int96_query_writes_int96(spark, tmp_path, monkeypatch):
    from recordflow.plans import file_queries

    monkeypatch.setattr(file_queries, "shared_dir", lambda _: str(tmp_path / "q"))
    found = file_queries.parquet_write_int96(spark, "/root/testdata/sf0.001")
    schema = pq.ParquetFile(first_file(tmp_path / "q")).schema
    assert {schema.column(i).name: schema.column(i).physical_type for i in range(2)}["ts"] == "INT96"
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    assert sorted(map(tuple, found.collect())) == sorted((r[0], r[1].replace(tzinfo=None)) for r in rows.collect())


@pytest.mark.parametrize("glob, want", [
    ("*.parquet", 4), ("a?.parquet", 3), ("a[12].parquet", 2), ("a[^1].parquet", 2), ("a[2-3].parquet", 2), ("{a1,b1}.parquet", 2), ("b1.parquet", 1),
])
def test_globs(spark, tmp_path, glob, want):
    import pyarrow as pa

    for n in ("a1", "a2", "a3", "b1"):
        pq.write_table(pa.table({"x": [n]}), tmp_path / f"{n}.parquet")
    assert parquet.parquet_scan_glob(spark, str(tmp_path / glob)).count() == want


def small_files(spark, tmp_path):
    spark.range(10).select("id", F.lit("x").alias("a")).repartition(3).write.parquet(str(tmp_path / "in" / "1"))
    spark.range(5).select("id", F.lit(2.5).alias("b")).repartition(2).write.parquet(str(tmp_path / "in" / "2"))
    return str(tmp_path / "in" / "*" / "*.parquet")


def test_merge_unites_schemas_and_replaces_the_target(spark, tmp_path):
    pattern, out = small_files(spark, tmp_path), tmp_path / "out"
    spark.range(99).write.parquet(str(out))
    done = parquet.parquet_merge(spark, pattern, str(out), files=1)
    assert done.source_count == 5 and len(list(out.glob("*.parquet"))) == 1
    rows = spark.read.parquet(str(out))
    assert rows.count() == 15 and set(rows.columns) == {"id", "a", "b"}
    assert rows.filter("a IS NULL AND b = 2.5").count() == 5
    assert pq.ParquetFile(first_file(out)).metadata.row_group(0).column(0).compression == "SNAPPY"


def test_merge_size_target(spark, tmp_path):
    pattern = small_files(spark, tmp_path)
    total = sum(n for _, n in parquet.glob_files(spark, pattern))
    parquet.parquet_merge(spark, pattern, str(tmp_path / "out"), file_bytes=total // 2 + 1)
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 2


def test_sources_go_only_after_success_and_only_when_asked(spark, tmp_path):
    pattern = small_files(spark, tmp_path)
    kept = parquet.parquet_merge_cleanup(spark, pattern, str(tmp_path / "o1"))
    assert kept.deleted == 0 and kept.row_count == 15 and len(parquet.glob_files(spark, pattern)) == 5
    gone = parquet.parquet_merge_cleanup(spark, pattern, str(tmp_path / "o2"), delete_sources=True)
    assert gone.deleted == 5 and not parquet.glob_files(spark, pattern)
    with pytest.raises(FileNotFoundError):
        parquet.parquet_merge(spark, pattern, str(tmp_path / "o3"))


def test_merge_never_overwrites_its_own_sources(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        parquet.parquet_merge(spark, str(tmp_path / "t" / "*.parquet"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_timestamp_write_keeps_micros_and_returns_rejects(spark, tmp_path):
    df = spark.createDataFrame([(1, "2020-01-01 00:00:00.000001"), (2, "bad")], "id int, t string")
    bad = parquet.parquet_write_ts_format(df, str(tmp_path / "o"), ["t"], props={"column.t.pattern": "yyyy-MM-dd HH:mm:ss.SSSSSS"}, hours=9)
    assert spark.read.parquet(str(tmp_path / "o")).first()["t"] == dt.datetime(2020, 1, 1, 9, 0, 0, 1)
    assert [r["id"] for r in bad.collect()] == [2]


# ---------------------------------------------------------------------- batches
def test_row_numbers_are_exact_over_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.lit("same").alias("c")).repartition(7)
    got = batches.number_rows(df, ["c", "v"]).select("v", "_row").collect()
    assert sorted((r["_row"], r["v"]) for r in got) == [(i, i) for i in range(5000)]


def test_fragments_hold_exactly_n_rows(spark):
    out = batches.result_fragments(spark.range(1003), ["id"], 100)
    rows = {r["fragment_index"]: r for r in batches.fragment_summary(out, "q").collect()}
    assert len(rows) == 11 and [rows[i]["row_count"] for i in range(11)] == [100] * 10 + [3]
    assert {r["fragment_count"] for r in rows.values()} == {11}


@pytest.mark.parametrize("per", [1, 3, 100])
def test_every_row_is_rendered_once(spark, per):
    df = spark.range(10).select("id", F.when(F.col("id") != 4, F.concat(F.lit("it's "), "id")).alias("s"))
    scripts = batches.batched_sql_render(df, "app.t", ["id", "s"], ["id"], per).orderBy("batch").collect()
    lines = [x for r in scripts for x in r["script"].split("\n")[1:-1]]
    assert lines == ["INTO app.t ( id, s ) VALUES ( %d, %s )" % (i, "NULL" if i == 4 else f"'it''s {i}'") for i in range(10)]
    assert all(r["script"].startswith("INSERT ALL\n") and r["script"].endswith("\nSELECT 1 FROM dual") for r in scripts)
    assert len(scripts) == -(-10 // per)


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    assert batches.shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir", "/tmp"))


def test_ties_and_copies_do_not_share_one_partition(spark):
    df = spark.range(4000, numPartitions=8).select(F.lit(1).alias("same"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # it would merge such small partitions again
    try:
        got = batches.number_rows(df, ["same"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r["_row"] for r in got.collect()) == list(range(4000))
    largest = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest <= 1500


@pytest.mark.parametrize("guess", [20_000, 400])
def test_pages_at_every_depth(spark, monkeypatch, guess):
    monkeypatch.setattr(batches, "GUESS_ROWS", guess)
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("v"), F.lit(1).alias("same"))
    page = lambda offset, limit, where=None: [r["v"] for r in batches.select_page(df, ["v"], where, ["same", "v"], limit, offset).collect()]
    assert page(1000, 50, F.col("v") >= 100) == list(range(1100, 1150))
    assert page(0, 3) == [0, 1, 2] and page(12_345, 700) == list(range(12_345, 13_045))
    assert page(19_990, 100) == list(range(19_990, 20_000)) and page(30_000, 5) == [] and page(5, 0) == []
    assert batches.select_page(df.filter("false"), ["v"], None, ["v"], 10).count() == 0


def test_pages_where_the_guess_fails(spark, monkeypatch):
    wrong = lambda page, order, rows, first, last: (F.col("v") >= 50, F.col("v") <= 60)
    monkeypatch.setattr(batches, "_around", wrong)
    df = spark.range(200).select(F.col("id").alias("v"))
    page = lambda offset: [r["v"] for r in batches.select_page(df, ["v"], None, ["v"], 5, offset).collect()]
    assert page(10) == list(range(10, 15)) and page(100) == list(range(100, 105)) and page(52) == list(range(52, 57))


def test_pages_with_nulls_come_first(spark):
    df = spark.createDataFrame([(None,), (3,), (None,), (1,)], "v int")
    assert [r["v"] for r in batches.select_page(df, ["v"], None, ["v"], 2, 1).collect()] == [None, 1]


def test_pages_order_only_what_surrounds_them(spark, monkeypatch):
    monkeypatch.setattr(batches, "GUESS_ROWS", 1000)
    ordered = []
    number = batches.number_rows
    monkeypatch.setattr(batches, "number_rows", lambda df, order: (ordered.append(df.count()), number(df, order))[1])
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_000).alias("v"))
    assert [r["v"] for r in batches.select_page(df, ["v"], None, ["v"], 10, 150_000).collect()] == list(range(150_000, 150_010))
    assert batches.select_page(df, ["v"], None, ["v"], 10).count() == 10
    assert ordered[0] < 100_000 and ordered[1] < 10_000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_int96_by_column(spark, tmp_path, zone):
    times = [0, 1_710_052_200_123_456, 1_730_610_000_000_001, -7_000_000_000_000_000, None]  # around both changes of the clock
    df = spark.createDataFrame([(t,) for t in times], "t long").select(
        F.timestamp_micros("t").alias("a"), F.timestamp_micros("t").alias("b", metadata={"format": "x"}), "t")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        parquet.parquet_write_int96(df.coalesce(1), str(tmp_path / "z"), columns=["a"])
        back = parquet.read_zoned(spark, str(tmp_path / "z"))
        assert dict(back.dtypes) == {"a": "timestamp", "b": "timestamp", "t": "bigint"} and back.schema["b"].metadata == {"format": "x"}
        assert back.filter(~(F.unix_micros("a").eqNullSafe(F.col("t")) & F.unix_micros("b").eqNullSafe(F.col("t")))).count() == 0
        assert back.count() == len(times)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    schema = pq.ParquetFile(first_file(tmp_path / "z")).schema
    assert [schema.column(i).physical_type for i in range(2)] == ["INT96", "INT64"]
    with pytest.raises(ValueError, match="not zoned"):
        parquet.parquet_write_int96(df, str(tmp_path / "y"), columns=["t"])


@pytest.mark.parametrize("filled", [True, False])
def test_a_swap_cut_between_its_renames_is_mended(spark, tmp_path, filled):
    target, aside, new = tmp_path / "t", tmp_path / "_t.new-1-old", tmp_path / "_t.new-1"
    parquet.parquet_write(spark.range(3), str(aside))
    if filled:
        parquet.parquet_write(spark.range(5), str(new))
    parquet.parquet_write(spark.range(9), str(tmp_path / "_t.new-2"))   # another write, still being filled
    assert parquet.finish_swap(spark, str(target))
    assert spark.read.parquet(str(target)).count() == (5 if filled else 3)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["_t.new-2", "t"]
    assert not parquet.finish_swap(spark, str(target))


def test_an_overwrite_mends_first(spark, tmp_path):
    parquet.parquet_write(spark.range(3), str(tmp_path / "_t.new-1-old"))
    parquet.parquet_write(spark.range(7), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7 and [p.name for p in tmp_path.iterdir()] == ["t"]
