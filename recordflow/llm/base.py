"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.operators.batches import ensure_checkpoint_dir

#: A word is a maximal run of characters other than ASCII white space; ``bytes.split()`` splits the same way.
WORD = r"[^\x20\x09-\x0D]+"
#: Words or characters that a task keeps in a table of its own at most, before it starts a new one.
TABLE_SIZE = 1 << 19


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by their exact names, so that ``TEXT`` beside ``text`` is no ambiguity."""
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{df.columns.index(name)}").alias(name) for name in names])


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The named columns beside ``row``, a struct of all columns under positional names."""
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    own = [F.col(f"_{df.columns.index(name)}").alias(name) for name in names]
    return plain.select(F.struct(*plain.columns).alias("row"), *own)


def unpacked(df: DataFrame, like: DataFrame, *more: Column) -> DataFrame:
    """The columns of ``like`` out of ``row``, and further ones, which replace columns of ``like`` of their name in any case."""
    names = [df.select(c).columns[0] for c in more]
    taken = {n.lower() for n in names}
    kept = [(F.col(f"row._{i}"), n) for i, n in enumerate(like.columns) if n.lower() not in taken]
    return df.select(*[c for c, _ in kept], *more).toDF(*[n for _, n in kept], *names)


def saved(df: DataFrame, narrow: bool = False) -> DataFrame:
    """A reliable checkpoint in the folder that all executors share.

    ``narrow`` tables, small beside the shuffle that makes them, are saved in an
    eighth of its tasks, which spares the driver the bookkeeping of empty ones.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if narrow:
        df = df.coalesce(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8))
    return df.checkpoint()


def remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def fraction(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 texts; null is empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def row_groups(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of rows of at most ``most`` units together, or of a single row."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total + size > most and i > start:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def sums_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each consecutive run of ``counts`` values; a run's sum depends on its own values alone."""
    out = np.zeros(len(counts), values.dtype)
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        out[full] = np.add.reduceat(values, starts)
    return out


def output(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, schema.field(n).type) for n, v in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
