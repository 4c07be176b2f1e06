"""Numbered batches: exact row numbers over a whole table, result fragments, rendered SQL batches."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from recordflow.functions.values import sql_literal

ROW = "_row"


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under the one the cluster names for checkpoints; a local one only on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        return tempfile.mkdtemp(prefix="recordflow-")
    return f"{base.rstrip('/')}/recordflow-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def number_rows(df: DataFrame, order: list[str], name: str = ROW) -> DataFrame:
    """Exact 0-based position in ``order`` over the whole table, without a single-task window.

    The table is range-partitioned and sorted once and checkpointed, so that
    positions inside the partitions are fixed; the row count of each earlier
    partition (one small row per partition) is then added.  Rows that tie in
    ``order`` may spread over partitions: by their other columns, and copies by
    the partition they come from.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cols = [F.col(f"`{c}`") for c in order]
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    ties = {"_h": F.xxhash64(*[F.col(f"`{c}`") for c in plain]), "_p": F.spark_partition_id()}
    ranged = df.withColumns(ties).repartitionByRange(*cols, "_h", "_p").sortWithinPartitions(*cols)
    ranged = ranged.drop(*ties).checkpoint()
    # the id is (partition << 33) + position in the partition
    placed = ranged.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    # one offset row per partition: bounded by the number of partitions
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + inside)
        .drop("_id", "_part", "_offset")
    )


def result_fragments(df: DataFrame, order: list[str], rows_per_fragment: int) -> DataFrame:
    """Rows with ``fragment_index`` (0-based) so that each fragment holds exactly N rows but the last."""
    return number_rows(df, order).withColumn(
        "fragment_index", F.floor(F.col(ROW) / rows_per_fragment).cast("bigint")
    ).drop(ROW)


def fragment_summary(fragments: DataFrame, identifier: str) -> DataFrame:
    """One row per fragment: identifier, index, count of fragments, rows."""
    per = fragments.groupBy("fragment_index").agg(F.count(F.lit(1)).alias("row_count"))
    total = per.agg(F.count(F.lit(1)).alias("n")).scalar()
    return per.select(
        F.lit(identifier).alias("fragment_identifier"), "fragment_index", total.alias("fragment_count"), "row_count"
    )


def insert_clause(df: DataFrame, table: str, columns: list[str]) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    values = F.concat_ws(", ", *[sql_literal(F.col(f"`{c}`"), types[c]) for c in columns])
    return F.concat(F.lit(f"INTO {table} ( {', '.join(columns)} ) VALUES ( "), values, F.lit(" )"))


def batched_sql_render(df: DataFrame, table: str, columns: list[str], order: list[str], rows_per_batch: int) -> DataFrame:
    """One ``INSERT ALL`` script per batch of N rows, every row exactly once."""
    lines = number_rows(df, order).select(
        F.floor(F.col(ROW) / rows_per_batch).cast("bigint").alias("batch"), ROW,
        insert_clause(df, table, columns).alias("line"),
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(ROW, "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("batch").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.concat(F.lit("INSERT ALL\n"), body, F.lit("\nSELECT 1 FROM dual")).alias("script"),
    )


# ------------------------------------------------------------ limits and pages
# rows that are looked at to guess where a page lies; the guess never changes which rows it holds
GUESS_ROWS = 20_000


def limit_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _around(page: DataFrame, order: list[str], rows: int, first: int, last: int) -> tuple[Column, Column]:
    """Conditions that hold from a little before position ``first`` and to a little behind ``last``, by a sample."""
    at = F.struct(*[F.col(f"`{c}`") for c in order])
    share = min(1.0, GUESS_ROWS / max(rows, 1))
    places = page.select(at.alias("at"))
    # without a checkpoint each of the two bounds would come from a sample of its own
    places = (places.sample(share, 7) if share < 1 else places).checkpoint()
    sample = places.agg(F.sort_array(F.collect_list("at")).alias("s"))
    # six deviations of a sampled rank, and a little for ranks near the start
    slack = lambda rank: 6 * math.sqrt(rank) + 10
    low, high = int(first * share - slack(first * share)), int(last * share + slack(last * share))
    above = at >= sample.select(F.get("s", F.lit(low))).scalar() if low >= 0 else F.lit(True)
    below = at <= sample.select(F.get("s", F.lit(high))).scalar()
    return F.coalesce(above, F.lit(True)), F.coalesce(below, F.lit(True))


def select_page(df: DataFrame, columns: list[str], where: Column | None, order: list[str], limit: int,
                offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in order, by the same plan at every depth.

    A sample of the order columns gives bounds around the page; one pass counts
    the rows before the lower bound and up to the upper one.  Only rows between
    the bounds are ordered, over all partitions, so neither the rows before a
    deep page nor a long page meet in one task.  A bound that turns out to cut
    the page is not used.
    """
    page = df if where is None else df.filter(where)
    page = page.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, *order])])
    ensure_checkpoint_dir(df.sparkSession)
    rows = page.count()
    above, below = _around(page, order, rows, offset, offset + limit)
    seen = page.agg(F.count_if(~above).alias("before"), F.count_if(below).alias("up_to")).first()
    before = seen["before"] if seen["before"] <= offset else 0
    if before:
        page = page.filter(above)
    if seen["up_to"] >= min(offset + limit, rows):
        page = page.filter(below)
    numbered = number_rows(page, order)
    start = offset - before
    return numbered.filter(F.col(ROW).between(start, start + limit - 1)).orderBy(ROW).select(*columns)
