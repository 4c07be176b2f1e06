"""Parquet: glob scans, writer options, timestamp layouts, compaction with safe clean-up."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from recordflow.functions.timestamps import parse_timestamp_columns
from recordflow.functions.values import data_size_bytes

# --- fixed values: option name -> writer key -------------------------------
SIZE_OPTIONS = {
    "row_group_size": "parquet.block.size",
    "page_size": "parquet.page.size",
    "dictionary_page_size": "parquet.dictionary.page.size",
    "max_padding_size": "parquet.writer.max-padding",
}
CODECS = ("uncompressed", "none", "snappy", "gzip", "lz4", "lz4_raw", "zstd", "brotli")
WRITER_VERSIONS = {"PARQUET_1_0": "v1", "PARQUET_2_0": "v2", "v1": "v1", "v2": "v2"}


def parquet_scan_glob(spark: SparkSession, *globs: str, merge_schema: bool = True) -> DataFrame:
    """All files matching the globs (``* ? [ab] [^a] [a-b] {a,b}``)."""
    return spark.read.option("mergeSchema", merge_schema).parquet(*globs)


def union_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of all files as one scan."""
    return parquet_scan_glob(spark, *paths)


def writer_options(
    compression: str = "snappy",
    row_group_size: str | int | None = None,
    page_size: str | int | None = None,
    dictionary_page_size: str | int | None = None,
    max_padding_size: str | int | None = None,
    dictionary: bool = True,
    writer_version: str | None = None,
    validation: bool | None = None,
) -> dict[str, str]:
    """Checked writer options; sizes may be text such as ``128 MB``."""
    if compression.lower() not in CODECS:
        raise ValueError(f"unknown codec {compression!r}; known: {CODECS}")
    out = {"compression": compression.lower(), "parquet.enable.dictionary": str(dictionary).lower()}
    sizes = dict(row_group_size=row_group_size, page_size=page_size, dictionary_page_size=dictionary_page_size,
                 max_padding_size=max_padding_size)
    for name, value in sizes.items():
        if value is None:
            continue
        size = data_size_bytes(value) if isinstance(value, str) else int(value)
        if size is None:
            raise ValueError(f"invalid data size for {name}: {value!r}")
        out[SIZE_OPTIONS[name]] = str(size)
    if writer_version is not None:
        out["parquet.writer.version"] = WRITER_VERSIONS[writer_version]
    if validation is not None:
        out["parquet.validation"] = str(validation).lower()
    return out


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put folder ``new`` in the place of ``path`` by renames alone.

    A reader sees the old files or all of the new ones, or no folder for the
    moment between two renames.  The old files go only once the new are in place.
    """
    fs, target = _fs(spark, path)
    source, aside = _fs(spark, new)[1], _fs(spark, f"{new}-old")[1]
    held = fs.exists(target)
    if held and not fs.rename(target, aside):
        raise OSError(f"cannot move {path!r} aside")
    if not fs.rename(source, target):
        if held:
            fs.rename(aside, target)
        raise OSError(f"cannot move {new!r} to {path!r}")
    if held:
        fs.delete(aside, True)


def finish_swap(spark: SparkSession, path: str) -> bool:
    """Mend what a driver lost inside :func:`replace_folder` left behind; true if there was anything to mend.

    A swap begins once its new folder is whole.  So without a target the new
    folder takes its place, or else the old one does; old files beside a target
    are left over.  Folders still being filled are not touched.  One writer at a time.
    """
    fs, target = _fs(spark, path)
    parent, _, name = path.rstrip("/").rpartition("/")
    left = fs.globStatus(_fs(spark, f"{parent}/_{name}.new-*-old")[1]) or []
    asides = [s.getPath() for s in sorted(left, key=lambda s: s.getModificationTime())]
    if asides and not fs.exists(target):
        last = asides[-1]
        filled = _fs(spark, last.toString().removesuffix("-old"))[1]
        if not fs.rename(filled if fs.exists(filled) else last, target):
            raise OSError(f"cannot restore {path!r}")
    for old in asides:
        fs.delete(old, True)
    return bool(asides)


def parquet_write(df: DataFrame, path: str, overwrite: bool = True, legacy_lists: bool = False,
                  partition_by: list[str] | None = None, max_records_per_file: int = 0,
                  check: Callable[[], None] | None = None, **options) -> None:
    """Write Parquet files.  An overwrite fills a folder beside the target, then swaps them.

    So a write that fails leaves the old files, and ``df`` may read what it replaces.
    ``check`` runs between filling and swapping; if it raises, the old files stay.
    An overwrite first mends what a driver lost inside an earlier swap left behind.
    """
    spark = df.sparkSession
    if overwrite:
        finish_swap(spark, path)
    parent, slash, name = path.rstrip("/").rpartition("/")
    # scans of the parent folder pass over names that begin with an underscore
    aside = f"{parent}{slash}_{name}.new-{uuid.uuid4().hex}" if overwrite else path
    writer = df.write.mode("errorifexists").options(**writer_options(**options))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    try:
        with session_setting(spark, "spark.sql.parquet.writeLegacyFormat", str(legacy_lists).lower()):
            writer.parquet(aside)
        if check is not None:
            check()
        if overwrite:
            replace_folder(spark, aside, path)
    except Exception:
        if overwrite:
            fs, left = _fs(spark, aside)
            fs.delete(left, True)
        raise


# marks a column that was zoned before it was stored as UTC wall clock
STORED_ZONED = "recordflow.zoned"


def parquet_write_int96(df: DataFrame, path: str, int96: bool = True, columns: list[str] | None = None, **kw) -> None:
    """Zoned timestamps stored as INT96: all of them, the named ``columns`` alone, or none.

    Spark sets the layout of zoned timestamps for a whole write.  So with
    ``columns`` the others are stored as INT64 wall clock in UTC, with a mark in
    the column's metadata, by which :func:`read_zoned` turns them back.
    """
    kind = "INT96" if int96 else "TIMESTAMP_MICROS"
    if int96 and columns is not None:
        zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
        unknown = [c for c in columns if c not in zoned]
        if unknown:
            raise ValueError(f"not zoned timestamp columns: {unknown}")
        df = df.select(*[
            _utc_wall_clock(F.col(f"`{f.name}`")).alias(f.name, metadata={**(f.metadata or {}), STORED_ZONED: True})
            if f.name in zoned and f.name not in columns else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ])
    with session_setting(df.sparkSession, "spark.sql.parquet.outputTimestampType", kind):
        parquet_write(df, path, **kw)


def _utc_wall_clock(c: Column) -> Column:
    """The instant as wall clock in UTC, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def read_zoned(spark: SparkSession, *paths: str) -> DataFrame:
    """A Parquet scan in which marked UTC wall-clock columns are zoned timestamps again."""
    df = spark.read.parquet(*paths)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def back(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if not (f.metadata or {}).get(STORED_ZONED):
            return c
        plain = {k: v for k, v in f.metadata.items() if k != STORED_ZONED}
        return F.timestamp_micros(F.timestamp_diff("MICROSECOND", start, c)).alias(f.name, metadata=plain)

    return df.select(*[back(f) for f in df.schema.fields])


def parquet_write_ts_format(df: DataFrame, path: str, columns: list[str], patterns: dict[str, str] | None = None,
                            props: dict[str, str] | None = None, hours: int = 0, **kw) -> DataFrame:
    """Parse text columns by their patterns, shift by whole hours, write; returns the rejected rows.

    Rows with a reject are left out of the file.
    """
    from recordflow.functions.casts import split_rejects

    good, bad = split_rejects(parse_timestamp_columns(df, columns, patterns, props=props, hours=hours))
    parquet_write(good, path, **kw)
    return bad


# -------------------------------------------------------------------- compaction
def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def glob_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files a glob names (a listing; no data is read)."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p) or []
    return [(s.getPath().toString(), s.getLen()) for s in found if s.isFile()]


def parquet_merge(spark: SparkSession, pattern: str, target: str, file_bytes: int = 512 << 20,
                  files: int | None = None) -> Row:
    """Compact many files into few, replacing the target; nothing is shuffled.

    By default the number of files follows from the input size; ``files=1`` gives
    a single file, written by one task.  Schemas are merged by column name.
    """
    found = glob_files(spark, pattern)
    if not found:
        raise FileNotFoundError(f"no files match {pattern!r}")
    inside = _fs(spark, target)[1].toUri().getPath().rstrip("/") + "/"
    if any(_fs(spark, f)[1].toUri().getPath().startswith(inside) for f, _ in found):
        raise ValueError("the target folder holds source files; choose another target")
    paths = [f for f, _ in found]
    count = files or max(1, math.ceil(sum(n for _, n in found) / file_bytes))
    source = parquet_scan_glob(spark, *paths)
    parquet_write(source.coalesce(count), target)
    return Row(target=target, source_count=len(paths), sources=paths)


def parquet_merge_cleanup(spark: SparkSession, pattern: str, target: str, delete_sources: bool = False, **kw) -> Row:
    """Merge, check the row count, and only then delete the sources (kept by default)."""
    done = parquet_merge(spark, pattern, target, **kw)
    wanted = parquet_scan_glob(spark, *done.sources).count()
    written = spark.read.parquet(target).count()
    if written != wanted:
        raise RuntimeError(f"merged file holds {written} rows, sources {wanted}; sources kept")
    deleted = 0
    if delete_sources:
        for f in done.sources:
            fs, p = _fs(spark, f)
            deleted += bool(fs.delete(p, False))
    return Row(target=target, source_count=done.source_count, row_count=written, deleted=deleted, sources=done.sources)


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows per source file of a scan."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))
