"""Files processed as they arrive: typed ingest, replay-safe keyed changes, reject routing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordflow.functions.casts import split_rejects
from recordflow.operators import keyed
from recordflow.sources.csv import Dialect, dialect, reader_options


def stream_file_ingest(spark: SparkSession, folder: str, schema: T.StructType, dialect_name: str | Dialect = "custom",
                       header: bool = True, max_files: int = 100) -> DataFrame:
    """Delimited files of a folder as a stream; each file is read once, with its path in ``_file``."""
    options = reader_options(dialect(dialect_name), header)
    return (
        spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", max_files).csv(folder)
        .withColumn("_file", F.col("_metadata.file_path"))
    )


def stream_reject_route(stream: DataFrame, convert: Callable[[DataFrame], DataFrame], good_path: str, bad_path: str,
                        checkpoint: str):
    """Good rows to one sink, rejected rows to another, in one pass per micro-batch.

    Each batch has its own ``batch=`` folder, overwritten on replay, so a batch
    that runs twice leaves its rows once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = convert(batch).persist()
        try:
            good, bad = split_rejects(marked)
            good.write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            bad.write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        finally:
            marked.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


class BucketedTable:
    """A keyed table kept as hash buckets of the key, each with its own versions.

    A micro-batch reads and rewrites only the buckets its keys fall into, under
    a folder named after the batch id; the manifest written last makes the
    version count.  A replayed batch starts again from the versions before it,
    so its changes are never applied twice.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.buckets = keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._hadoop(path)
        return fs.exists(p)

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        root = f"{self.path}/manifest"
        if not self._exists(root):
            return []
        fs, p = self._hadoop(root)
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and self._exists(f"{root}/{n}/_SUCCESS"))

    def current(self, version: int | None = None) -> dict[int, int]:
        """{bucket: its newest version} up to ``version``; as many entries as buckets."""
        known = [v for v in self.versions() if version is None or v <= version]
        if not known:
            return {}
        manifest = self.spark.read.schema("bucket int, version bigint").parquet(
            *[f"{self.path}/manifest/v={v}" for v in known]
        )
        rows = manifest.groupBy("bucket").agg(F.max("version").alias("v")).collect()
        return {r["bucket"]: r["v"] for r in rows}

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """The table, or just some buckets, as of ``version``."""
        at = self.current(version)
        paths = [f"{self.path}/data/v={v}/bucket={b}" for b, v in at.items() if only is None or b in only]
        # a bucket whose last row was deleted has a version but no folder
        paths = [p for p in paths if self._exists(p)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, table: DataFrame, version: int, touched: list[int]) -> None:
        rows = table.withColumn("bucket", self.bucket())
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/v={version}")
        manifest = self.spark.createDataFrame([(b, version) for b in touched], "bucket int, version bigint")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}")

    def load(self, table: DataFrame, version: int = -1) -> None:
        """Fill an empty table."""
        self.write(table, version, list(range(self.buckets)))

    def vacuum(self, keep: int = 3) -> int:
        """Remove bucket folders that a version older than the last ``keep`` already replaced."""
        known = self.versions()
        if len(known) <= keep:
            return 0
        live = {(b, v) for k in known[-keep:] for b, v in self.current(k).items()}
        gone = 0
        for v in known[:-keep]:
            root = f"{self.path}/data/v={v}"
            if not self._exists(root):
                continue
            fs, p = self._hadoop(root)
            for s in fs.listStatus(p):
                name = s.getPath().getName()
                if name.startswith("bucket=") and (int(name[7:]), v) not in live:
                    gone += bool(fs.delete(s.getPath(), True))
        return gone


def stream_keyed_apply(changes: DataFrame, table: BucketedTable, order: list[str], op: str, rejects_path: str,
                       checkpoint: str, ignore_null: bool = False, keep: int = 3):
    """Mixed operations applied batch by batch with the same operator the batch path uses."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            touched = [r["b"] for r in rows.select(table.bucket().alias("b")).distinct().collect()]
            before = table.read(batch_id - 1, touched)
            done = keyed.apply_mixed(before, rows, table.keys, order, op, ignore_null)
            done.rejects.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
            table.write(done.table, batch_id, touched)
            table.vacuum(keep)
        finally:
            rows.unpersist()

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
