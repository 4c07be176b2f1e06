"""Inserts, updates, upserts and deletes on a keyed table, as whole-table DataFrame operations.

Changes are applied in the order of the caller's ``order`` columns, which must
be a total order within a key.  Nothing is collected per key: winners come
from ``row_number() = 1`` (pruned before the shuffle) or ``max_by`` (partially
aggregated before it), and mixed operations reduce to one running "last
operation that set or cleared the key".
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from recordflow.operators.skew import SALT, Hot, Ranges, as_hot, carry_last, find_ranges, range_lookup, salted, salted_lookup

REASON = "_reason"
NULL_KEY = "key must not be null"
KEY_EXISTS = "key already present"
KEY_ABSENT = "key not found"
BAD_OPERATION = "unknown operation"

INSERT, INSERT_IGNORE = "INSERT", "INSERT_IGNORE"
UPDATE, UPDATE_IGNORE = "UPDATE", "UPDATE_IGNORE"
DELETE, DELETE_IGNORE = "DELETE", "DELETE_IGNORE"
UPSERT = "UPSERT"
ROW_OPERATIONS = (INSERT, UPDATE, DELETE, UPSERT)
ALL_OPERATIONS = (INSERT, INSERT_IGNORE, UPSERT, UPDATE, UPDATE_IGNORE, DELETE, DELETE_IGNORE)


@dataclass
class Applied:
    """New table contents, and the change rows that did not apply with their ``_reason``."""

    table: DataFrame
    rejects: DataFrame


class RejectedRows(ValueError):
    """Raised by :func:`all_or_nothing`."""


# ------------------------------------------------------------ rows per key
def _cols(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _one_per_key(df: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    w = Window.partitionBy(*_cols(keys)).orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; each task keeps one row per key before the shuffle."""
    return _one_per_key(df, keys, [c.desc() for c in _cols(order)])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, keys, [c.asc() for c in _cols(order)])


def latest_values_per_key(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Per key and column, the last value that is not null."""
    at = F.struct(*_cols(order))
    return df.groupBy(*_cols(keys)).agg(
        *[F.max_by(c, F.when(c.isNotNull(), at)).alias(n) for n, c in zip(values, _cols(values))]
    )


# ------------------------------------------------------------------ matching
def match_existing(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(target.select(*_cols(keys)), keys, "left_semi")


def match_absent(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target lacks; a null key matches nothing.

    Rows with a null key have nothing to meet, so they are spread over the
    tasks by their content instead of sharing the one that nulls hash to.
    """
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    away = F.when(null_key(keys), F.xxhash64(*_cols(plain))).otherwise(F.lit(0))
    stored = target.select(*_cols(keys), F.lit(0).cast("bigint").alias("_away"))
    return rows.withColumn("_away", away).join(stored, [*keys, "_away"], "left_anti").select(*_cols(rows.columns))


def match_all_columns(rows: DataFrame, target: DataFrame, how: str = "left_semi") -> DataFrame:
    """Match on every shared column, nulls equal to nulls (for a delete that lists all columns)."""
    shared = [c for c in rows.columns if c in target.columns]
    if not shared:
        raise ValueError("no shared columns to match on")
    cond = F.lit(True)
    for c in shared:
        cond = cond & F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`"))
    # one row per combination keeps copies on the right from multiplying the work
    right = target.select(*_cols(shared)).distinct()
    return rows.alias("l").join(right.alias("r"), cond, how)


def merge_by_key(target: DataFrame, changes: DataFrame, keys: list[str], ignore_null: bool = False,
                 insert_missing: bool = True) -> DataFrame:
    """Stored rows with the columns of ``changes`` (one row per key) laid over them, in one join on the keys.

    Spark picks the join: updates alone leave the target in place when the
    changes fit a broadcast; with new keys both sides are shuffled once.
    """
    supplied = [c for c in changes.columns if c in target.columns and c not in keys]
    renamed = changes.select(
        *_cols(keys), *[F.col(f"`{c}`").alias(f"_n_{c}") for c in supplied], F.lit(True).alias("_changed")
    )

    def overlay(c: str) -> Column:
        old, new = F.col(f"`{c}`"), F.col(f"`_n_{c}`")
        if c not in supplied:
            return old
        if ignore_null:
            return F.coalesce(new, old).alias(c)
        return F.when(F.col("_changed"), new).otherwise(old).alias(c)

    joined = target.join(renamed, keys, "full" if insert_missing else "left")
    return joined.select(*[overlay(c) for c in target.columns])


# ------------------------------------------------------------------ routing
def with_reason(df: DataFrame, reason: str) -> DataFrame:
    return df.withColumn(REASON, F.lit(reason))


def null_key(keys: list[str]) -> Column:
    cond = F.lit(False)
    for k in _cols(keys):
        cond = cond | k.isNull()
    return cond


def required_not_null(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with ``_reason``): a key or required column must not be null."""
    reason = F.coalesce(*[F.when(F.col(f"`{c}`").isNull(), F.lit(f"{c} must not be null")) for c in columns],
                        F.lit(None).cast("string"))
    marked = df.withColumn(REASON, reason)
    return marked.filter(F.col(REASON).isNull()).drop(REASON), marked.filter(F.col(REASON).isNotNull())


def split_null_keys(changes: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    bad = null_key(keys)
    return changes.filter(~bad), with_reason(changes.filter(bad), NULL_KEY)


def op_from_column(df: DataFrame, column: str, operations: tuple[str, ...] = ROW_OPERATIONS) -> tuple[DataFrame, DataFrame]:
    """Upper-case the operation column; rows with any other value are rejected."""
    up = df.withColumn(column, F.upper(F.col(f"`{column}`")))
    ok = F.coalesce(F.col(f"`{column}`").isin(list(operations)), F.lit(False))
    return up.filter(ok), with_reason(up.filter(~ok), BAD_OPERATION)


def project_to_target(df: DataFrame, target: DataFrame) -> DataFrame:
    """Drop input columns the target does not have."""
    return df.select(*_cols([c for c in df.columns if c in target.columns]))


def all_or_nothing(applied: Applied) -> DataFrame:
    """The new table, or an error if any row was rejected (stops at the first one found)."""
    first = applied.rejects.select(REASON).limit(1).collect()
    if first:
        raise RejectedRows(first[0][REASON])
    return applied.table


TIE = "_tie"


def _ties_parted(rows: DataFrame, order: list[str]) -> tuple[DataFrame, list[str]]:
    """Rows whose ``order`` ties are ordered by their content; only copies of one row still tie."""
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return rows.withColumn(TIE, F.xxhash64(*_cols(plain))), [*order, TIE]


def _winner_verdict(rows: DataFrame, target: DataFrame, keys: list[str], order: list[str], hot: Hot,
                    apply_if_stored: bool, miss: str, again: str) -> DataFrame:
    """All rows with a ``_reason`` unless they apply: only the first row of a key may, and only if the key is (not) stored.

    One shuffle of the rows numbers them within their key and meets the stored
    keys.  Of copies that tie even in content one is numbered first, whichever.
    Rows of hot keys are numbered by salt, and the least first row of their
    salts (one small row per hot key) is broadcast.
    """
    columns = [c for c in rows.columns if c != TIE]
    stored = target.select(*_cols(keys), F.lit(True).alias("_stored"))
    placed, stored, by = salted(rows, stored, keys, order, hot)
    numbered = placed.withColumn("_rn", F.row_number().over(Window.partitionBy(*_cols(by)).orderBy(*[c.asc() for c in _cols(order)])))
    seen, first = numbered.join(stored, by, "left"), F.col("_rn") == 1
    if hot:
        least = placed.filter(hot.test(keys)).groupBy(*_cols(keys)).agg(F.min(F.struct(*_cols(order), SALT))[SALT].alias("_least"))
        seen = seen.join(F.broadcast(least), keys, "left")
        first = first & (F.coalesce("_least", SALT) == F.col(SALT))
    is_stored = F.coalesce(F.col("_stored"), F.lit(False))
    reason = F.when(is_stored != F.lit(apply_if_stored), F.lit(miss)).when(~first, F.lit(again))
    return seen.select(*_cols(columns), reason.alias(REASON))


# --------------------------------------------------------------- operations
def insert(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], hot: Hot | None = None) -> Applied:
    """Add rows; a row whose key is stored or was already inserted is rejected."""
    rows, null_keys = split_null_keys(changes, keys)
    rows, order = _ties_parted(rows, order)
    hot = as_hot(rows, keys, hot)
    marked = _winner_verdict(rows, target, keys, order, hot, False, KEY_EXISTS, KEY_EXISTS)
    new_rows = project_to_target(marked.filter(F.col(REASON).isNull()).drop(REASON), target)
    table = target.unionByName(new_rows, allowMissingColumns=True)
    return Applied(table, marked.filter(F.col(REASON).isNotNull()).unionByName(null_keys))


def insert_ignore(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add only new keys; the first row of a repeated key wins, the rest are skipped."""
    rows = changes.filter(~null_key(keys))
    new_rows = match_absent(first_per_key(rows, keys, order), target, keys)
    return target.unionByName(project_to_target(new_rows, target), allowMissingColumns=True)


def _last_changes(rows: DataFrame, target: DataFrame, keys: list[str], order: list[str], ignore_null: bool) -> DataFrame:
    if not ignore_null:
        return project_to_target(latest_per_key(rows, keys, order), target)
    values = [c for c in rows.columns if c in target.columns and c not in keys]
    return latest_values_per_key(rows, keys, order, values)


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], ignore_null: bool = False) -> Applied:
    """Insert or overwrite the supplied columns; the last row of a key wins."""
    rows, null_keys = split_null_keys(changes, keys)
    last = _last_changes(rows, target, keys, order, ignore_null)
    return Applied(merge_by_key(target, last, keys, ignore_null), null_keys)


def update_ignore(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str],
                  ignore_null: bool = False) -> DataFrame:
    """Overwrite the supplied columns of stored keys; other rows are skipped."""
    last = _last_changes(changes.filter(~null_key(keys)), target, keys, order, ignore_null)
    return merge_by_key(target, last, keys, ignore_null, insert_missing=False)


def update(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], ignore_null: bool = False,
           hot: Hot | None = None) -> Applied:
    """Overwrite the supplied columns of stored keys; a row with an absent key is rejected."""
    rows, null_keys = split_null_keys(changes, keys)
    table = update_ignore(target, rows, keys, order, ignore_null)
    stored = target.select(*_cols(keys))
    hot = as_hot(rows, keys, hot)
    absent = with_reason(salted_lookup(rows, stored, keys, order, hot, "left_anti"), KEY_ABSENT)
    return Applied(table, absent.select(*_cols(rows.columns), REASON).unionByName(null_keys))


def delete_ignore(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Remove the listed keys."""
    gone = changes.select(*_cols(keys)).filter(~null_key(keys)).distinct()
    return target.join(gone, keys, "left_anti")


def delete(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], hot: Hot | None = None) -> Applied:
    """Remove the listed keys; an absent (or already removed) key is rejected."""
    rows, null_keys = split_null_keys(changes, keys)
    rows, order = _ties_parted(rows, order)
    hot = as_hot(rows, keys, hot)
    marked = _winner_verdict(rows, target, keys, order, hot, True, KEY_ABSENT, KEY_ABSENT)
    return Applied(delete_ignore(target, rows, keys), marked.filter(F.col(REASON).isNotNull()).unionByName(null_keys))


# --------------------------------------------------------- mixed operations
KIND = "_kind"


def _with_kind(rows: DataFrame, op: str) -> DataFrame:
    """Column ``_kind``: the operation without its ignore suffix."""
    return rows.withColumn(KIND, F.regexp_replace(F.col(f"`{op}`"), "_IGNORE$", ""))


def classify_mixed(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str,
                   ranges: Ranges | None = None) -> DataFrame:
    """Each change row with its ``_kind``, ``_present`` (was its key present just before it) and ``_reason`` if it fails.

    An update never changes whether a key is present, so presence before a row
    is decided by the last insert, upsert or delete before it, or else by the
    stored table.
    """
    kind = F.col(KIND)
    sets = F.when(kind != UPDATE, kind != DELETE)
    ranges = find_ranges(changes, keys, order) if ranges is None else ranges
    carried = carry_last(_with_kind(changes, op), keys, order, {"_set": sets}, ranges)
    stored = target.select(*_cols(keys), F.lit(True).alias("_stored"))
    seen = range_lookup(carried, stored, keys, ranges)
    present = F.coalesce(F.col("_set"), F.col("_stored"), F.lit(False))
    reason = F.when((kind == INSERT) & present, F.lit(KEY_EXISTS)).when(
        kind.isin(UPDATE, DELETE) & ~present, F.lit(KEY_ABSENT)
    )
    return seen.withColumn("_present", present).withColumn(REASON, reason).select(
        *_cols(changes.columns), KIND, "_present", REASON
    )


def apply_mixed(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str,
                ignore_null: bool = False, operations: tuple[str, ...] = ALL_OPERATIONS,
                ranges: Ranges | None = None, watch: Callable[[DataFrame], DataFrame] | None = None) -> Applied:
    """Rows that each carry their own operation, applied in order.

    The final row of a key is its last effective write after its last delete,
    so one aggregate per key gives the result for any number of changes.
    ``watch`` may observe the marked change rows on their way into the table.
    """
    rows, null_keys = split_null_keys(changes, keys)
    rows, unknown = op_from_column(rows, op, operations)
    marked = classify_mixed(target, rows, keys, order, op, ranges)

    kind = F.col(KIND)
    at = F.struct(*_cols(order))
    works = F.col(REASON).isNull()
    writes = works & (kind != DELETE)
    supplied = [c for c in rows.columns if c in target.columns and c not in keys]
    sets = F.when(kind != UPDATE, kind != DELETE)
    aggregates = [
        F.max_by(sets, F.when(sets.isNotNull(), at)).alias("_set"),
        F.max(F.when(kind == DELETE, at)).alias("_cleared"),
    ]
    if ignore_null:
        for c in supplied:
            when = F.when(writes & F.col(f"`{c}`").isNotNull(), at)
            aggregates.append(F.max_by(F.struct(F.col(f"`{c}`").alias("v"), at.alias("at")), when).alias(f"_w_{c}"))
    else:
        row = F.struct(at.alias("at"), *[F.col(f"`{c}`").alias(c) for c in supplied])
        aggregates.append(F.max_by(row, F.when(writes, at)).alias("_w"))
    seen = marked if watch is None else watch(marked)
    summary = seen.groupBy(*_cols(keys)).agg(*aggregates).withColumn("_changed", F.lit(True))

    stored = target.withColumn("_stored", F.lit(True))
    both = stored.join(summary, keys, "full")
    cleared = F.col("_cleared").isNotNull()

    def final(c: str) -> Column:
        old = F.col(f"`{c}`")
        if c in keys:
            return old
        kept = F.when(~cleared, old)
        if c not in supplied:
            return kept.alias(c)
        written = F.col(f"`_w_{c}`") if ignore_null else F.col("_w")
        value = written["v"] if ignore_null else written[c]
        live = written.isNotNull() & (~cleared | (written["at"] > F.col("_cleared")))
        return F.when(live, value).otherwise(kept).alias(c)

    present = F.coalesce(F.col("_set"), F.col("_stored"), F.lit(False))
    table = both.filter(present).select(*[final(c) for c in target.columns])
    failed = marked.filter(F.col(REASON).isNotNull() & ~F.col(f"`{op}`").endswith("_IGNORE"))
    rejects = failed.drop("_present", KIND).unionByName(null_keys).unionByName(unknown)
    return Applied(table, rejects)


# ------------------------------------------------------------------- counts
def errors_by_file(rejects: DataFrame, file: str, order: list[str], reason: str = REASON) -> DataFrame:
    """Per source file: number of rejected rows, and every reason with its count, in the order they first occur.

    Rows are counted by file and reason before they meet, so what comes together
    for a file is a row per different reason.
    """
    per = rejects.groupBy(file, F.col(f"`{reason}`").alias("_why")).agg(
        F.min(F.struct(*_cols(order))).alias("_at"), F.count(F.lit(1)).alias("_n"))
    listed = F.array_sort(F.collect_list(F.struct("_at", "_why", "_n")))
    return per.groupBy(file).agg(
        F.sum("_n").alias("rejected"),
        F.transform(listed, lambda x: F.struct(x["_why"].alias("reason"), x["_n"].alias("row_count"))).alias("reasons"),
    )


def counts_by_op(changes: DataFrame, op: str) -> DataFrame:
    return changes.groupBy(F.upper(F.col(f"`{op}`")).alias("operation")).agg(F.count(F.lit(1)).alias("row_count"))


def record_counts(marked: DataFrame, file: str, rejected: Column, batch_rows: int) -> DataFrame:
    """Per source file: rows, rejected rows, accepted rows, and batches of at most ``batch_rows``."""
    bad = F.count_if(rejected)
    total = F.count(F.lit(1))
    return marked.groupBy(file).agg(
        total.alias("total_rows"), bad.alias("rejected_rows"), (total - bad).alias("accepted_rows"),
        F.ceil(total / batch_rows).cast("bigint").alias("batches"),
    )
