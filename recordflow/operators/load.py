"""Whole loads into a stored table: all of the input applies, or the table stays as it was."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from recordflow.operators import keyed
from recordflow.sources import parquet

_SENT = "_sent_op"


@dataclass(frozen=True)
class Loaded:
    """Rows of the input, and how many of them were rejected; a load with rejects is not ``committed``."""

    rows: int
    rejected: int

    @property
    def committed(self) -> bool:
        return self.rejected == 0


def _counts(seen: Observation) -> dict[str, int]:
    """The observed counts; none if the plan lost the branch they were on, as it turned out to be empty."""
    try:
        return seen.get
    except Py4JJavaError as e:
        # Spark hands over an empty row then, which it does not convert
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}


class _Refused(Exception):
    """Ends the write between filling the new folder and the swap."""


def load_whole(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], order: list[str], operation: str,
               ignore_null: bool = False) -> Loaded:
    """Apply ``changes`` to the Parquet table at ``path`` if no row of them is rejected.

    The new table is written beside the old one, and the rows that pass by on
    the way are counted in that same job; then the folders are swapped, or the
    new one is dropped.  So the input is not read again for its counts.  Rows
    counted twice after a lost executor can make a count too large, but never
    turn none into some.  ``order`` is a total order within a key.

    To see the rejected rows of a refused load, apply the operation to the
    unchanged table: ``keyed.insert(spark.read.parquet(path), ...).rejects``.
    """
    if operation not in keyed.ALL_OPERATIONS:
        raise ValueError(f"unknown operation {operation!r}")
    parquet.finish_swap(spark, path)
    stored = spark.read.parquet(path)
    needed = [c for c in changes.columns if c in stored.columns or c in order]
    came, failed = Observation(), Observation()
    null_key = keyed.null_key(keys)
    sent = changes.select(*[F.col(f"`{c}`") for c in needed]).observe(
        came, F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("null_keys"))
    # an IGNORE operation skips the rows that its plain form rejects
    bad = F.col(keyed.REASON).isNotNull() & F.lit(not operation.endswith("_IGNORE"))
    applied = keyed.apply_mixed(
        stored, sent.withColumn(_SENT, F.lit(operation)), keys, order, _SENT, ignore_null,
        watch=lambda marked: marked.observe(failed, F.count_if(bad).alias("failed")))
    done = {}

    def check() -> None:
        first, second = _counts(came), _counts(failed)
        if not first:  # no row has a key: the input ends there
            totals = changes.agg(F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("null_keys")).first()
            first = totals.asDict()
        nulls = 0 if operation.endswith("_IGNORE") else first["null_keys"]
        done["loaded"] = Loaded(first["rows"], nulls + second.get("failed", 0))
        if not done["loaded"].committed:
            raise _Refused

    try:
        parquet.parquet_write(applied.table, path, check=check)
    except _Refused:
        pass
    return done["loaded"]
