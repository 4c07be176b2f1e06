"""Threshold alerts over metric tables: breaches, edges, suppression with recovery, payloads.

Suppression is sequential within a series: an alert starts an interval in which
further breaches stay silent, and the first reading back under the limit after
an alert is a recovery, which starts a new interval.  The state is two values,
so a task streams through sorted rows holding nothing but that.  A very
frequent series is cut into time ranges: each range is first summarised as a
function from entry state to exit state, the few summaries are chained, and
then all ranges run at once from their known entry states.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.functions.timestamps import to_micros
from recordflow.functions.values import data_size_bytes
from recordflow.operators.keyed import required_not_null
from recordflow.operators.skew import CHUNK, Ranges, carry_last, find_ranges, key_match

ALERT, RECOVERED = "ALERT", "RECOVERED"


# ------------------------------------------------------------------ thresholds
def used_amount(total: Column, free: Column) -> Column:
    return total - free


def percent(part: Column, total: Column) -> Column:
    """Share of the total in percent; null on a zero total."""
    return F.when(total != 0, part.cast("double") / total.cast("double") * 100.0)


def usage_percent(df: DataFrame, total: str, free: str) -> DataFrame:
    t, f = F.col(total), F.col(free)
    return df.select(
        "*", used_amount(t, f).alias("used"), percent(used_amount(t, f), t).alias("used_percent"),
        percent(f, t).alias("free_percent"),
    )


def exceeds(used: Column, threshold: str | int | float, capacity: Column | None = None, inclusive: bool = False) -> Column:
    """Breach test for a limit given as ``NN%`` of a capacity, a data size such as ``1 GB``, or a plain count.

    ``inclusive`` compares the percentage itself (``>=``); otherwise the limit is
    the whole part of capacity x percent and the use must be above it.
    """
    if isinstance(threshold, str):
        text = threshold.strip()
        if text.endswith("%"):
            pct = float(text[:-1])
            if capacity is None:
                raise ValueError("a percent threshold needs a capacity")
            if inclusive:
                return F.coalesce(percent(used, capacity) >= pct, F.lit(False))
            return F.coalesce(used > (capacity * (pct / 100.0)).cast("bigint"), F.lit(False))
        size = data_size_bytes(text)
        if size is None:
            raise ValueError(f"not a threshold: {threshold!r}")
        threshold = size
    test = used >= threshold if inclusive else used > threshold
    return F.coalesce(test, F.lit(False))


def threshold_filter(df: DataFrame, used: str, threshold: str | int | float, capacity: str | None = None,
                     inclusive: bool = False) -> DataFrame:
    """Every breaching row (no suppression)."""
    return df.filter(exceeds(F.col(used), threshold, F.col(capacity) if capacity else None, inclusive))


alert_every_breach = threshold_filter


def breach_edges(df: DataFrame, series: list[str], order: list[str], exceeded: Column,
                 ranges: Ranges | None = None) -> DataFrame:
    """Rows where a series goes above (``UP``) or back below (``DOWN``) the limit."""
    marked = df.withColumn("_x", exceeded)
    seen = carry_last(marked, series, order, {"_prev": F.col("_x")}, ranges)
    before = F.coalesce(F.col("_prev"), F.lit(False))
    edge = F.when(F.col("_x") & ~before, F.lit("UP")).when(~F.col("_x") & before, F.lit("DOWN"))
    return seen.withColumn("edge", edge).filter(F.col("edge").isNotNull()).drop("_x", "_prev", CHUNK)


def alert_payload(fields: dict[str, Column], type_name: str) -> Column:
    """Alert fields as one JSON document."""
    return F.to_json(F.struct(F.lit(type_name).alias("type"), *[c.alias(n) for n, c in fields.items()]),
                     {"ignoreNullFields": "false"})


# ------------------------------------------------------------------ suppression
def time_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds of a time column: of the instant, or of the wall clock where it has no zone; never by the session's zone."""
    return F.unix_micros(F.col(ts)) if isinstance(df.schema[ts].dataType, T.TimestampType) else to_micros(F.col(ts))


def untimed(df: DataFrame, ts: str) -> DataFrame:
    """The readings that no rule can place, as their time is null, with ``_reason``."""
    return required_not_null(df, [ts])[1]


def events_in(ts: np.ndarray, breach: np.ndarray, starts: np.ndarray, interval: int, flags: np.ndarray, free_from: list[int | None]) -> np.ndarray:
    """Rows that are events (an alert where ``breach``, else a recovery) in runs of sorted rows, each with its entry state.

    Every row points to the event that would follow it: the next breach that is
    an interval later, or after an alert the next reading under the limit.  The
    events are what the pointers reach from each run's first one; jumps double
    in length, so that takes a logarithm of steps over all runs at once.
    """
    m = len(ts)
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, m)))
    # all runs on one time line, far enough apart that nothing reaches from one into the next
    span = ts[np.append(starts[1:], m) - 1] - ts[starts]
    gap = np.minimum(interval, span + 1)
    offset = np.concatenate([[0], np.cumsum(span + gap + 2)[:-1]])
    place = offset[run] + ts - ts[starts][run]
    at, clear = np.flatnonzero(breach), np.flatnonzero(~breach)
    at_run, clear_run = np.append(run[at], -1), np.append(run[clear], -1)
    at_row, clear_row = np.append(at, m), np.append(clear, m)

    def first(rows: np.ndarray, runs: np.ndarray, k: np.ndarray, own: np.ndarray) -> np.ndarray:
        return np.where(runs[k] == own, rows[k], m)

    every = np.arange(m)
    later = np.maximum(np.searchsorted(place[at], place + gap[run]), np.searchsorted(at, every, side="right"))
    next_alert = first(at_row, at_run, later, run)
    next_clear = first(clear_row, clear_run, np.searchsorted(clear, every, side="right"), run)
    jump = np.append(np.where(breach, np.minimum(next_alert, next_clear), next_alert), m)
    # an entry state is silent until some time, and may recover if it is alerting
    silent = np.array([0 if f is None else min(max(f - int(t), 0), int(s) + 1) for f, t, s in zip(free_from, ts[starts], span)], np.int64)
    own = np.arange(len(starts))
    entry = first(at_row, at_run, np.maximum(np.searchsorted(place[at], offset + silent), np.searchsorted(at, starts)), own)
    recovery = first(clear_row, clear_run, np.searchsorted(clear, starts), own)
    seen = np.zeros(m + 1, bool)
    seen[np.where(flags, np.minimum(entry, recovery), entry)] = True
    while (jump[:m] < m).any():
        seen[jump[seen]] = True
        jump = jump[jump]
    return np.flatnonzero(seen[:m])


def walk(ts: np.ndarray, breach: np.ndarray, interval: int, flag: bool, last: int | None):
    """Events of one sorted stretch of a series from an entry state: (positions, is_alert, flag, last)."""
    ts, breach = np.asarray(ts, np.int64), np.asarray(breach, bool)
    free = None if last is None else last + interval
    where = events_in(ts, breach, np.array([0]), interval, np.array([flag]), [free]) if len(ts) else np.zeros(0, np.int64)
    if len(where):
        flag, last = bool(breach[where[-1]]), int(ts[where[-1]])
    return where.tolist(), breach[where].tolist(), flag, last


def summarise(ts: np.ndarray, breach: np.ndarray, interval: int) -> dict:
    """Exit state of a stretch as a function of its entry state.

    ``limit[i]`` and ``exit_*[i]``: an entry that may alert from time A leaves as
    the first i with A <= limit[i] says.  ``clear_*`` is the way out through the
    first reading under the limit; ``before_clear`` is the last breach before it.
    """
    m = len(ts)
    at, clear = np.flatnonzero(breach), np.flatnonzero(~breach)
    at_ts, none = ts[at], m
    # next event after an alert or a recovery at each row (m = none)
    k = np.searchsorted(at_ts, ts + interval)
    k = np.maximum(k, np.searchsorted(at, np.arange(m), side="right"))
    next_alert = np.append(at, none)[k] if m else np.array([], dtype=int)
    j = np.searchsorted(clear, np.arange(m), side="right")
    next_clear = np.append(clear, none)[j] if m else next_alert
    # nodes: row as alert = row, row as recovery = row + m; a node without a next event points to itself
    after_alert = np.where(next_alert < next_clear, next_alert, np.where(next_clear < none, next_clear + m, np.arange(m)))
    after_recovery = np.where(next_alert < none, next_alert, np.arange(m) + m)
    jump = np.concatenate([after_alert, after_recovery]).astype(np.int64)
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        jump = further
    # an entry can alert at the latest one interval after the start
    reach = min(len(at), int(np.searchsorted(at_ts, ts[0] + interval)) + 1) if m else 0
    ends = jump[at[:reach]]
    keep = np.append(ends[1:] != ends[:-1], True) if reach else np.array([], dtype=bool)
    ends, limits = ends[keep], at_ts[:reach][keep]
    out = {
        "limit": limits.tolist(), "exit_flag": (ends < m).tolist(), "exit_last": ts[ends % m].tolist() if m else [],
        "clear_flag": None, "clear_last": None, "before_clear": None,
    }
    if len(clear):
        end = int(jump[clear[0] + m])
        out["clear_flag"], out["clear_last"] = end < m, int(ts[end % m])
        breaches_before = int(clear[0])
        out["before_clear"] = int(ts[breaches_before - 1]) if breaches_before else None
    return out


def leave(summary, interval: int, flag: bool, last: int | None) -> tuple[bool, int | None]:
    """Apply a summary to an entry state."""
    limits = np.asarray(summary["limit"], dtype=np.int64)
    i = 0 if last is None else int(np.searchsorted(limits, last + interval))
    can_clear = flag and summary["clear_last"] is not None
    if can_clear:
        before = summary["before_clear"]
        alert_first = before is not None and (last is None or last + interval <= before)
        if not alert_first:
            return bool(summary["clear_flag"]), int(summary["clear_last"])
    if i < len(limits):
        return bool(summary["exit_flag"][i]), int(summary["exit_last"][i])
    return flag, last


def _runs(batch: pa.RecordBatch, keys: list[str]) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal keys in sorted rows (nulls equal)."""
    n = batch.num_rows
    change = np.zeros(n, dtype=bool)
    change[:1] = True
    for k in keys:
        col = batch.column(k)
        a, b = col.slice(0, max(n - 1, 0)), col.slice(1)
        differs = pc.fill_null(pc.not_equal(a, b), False)
        one_null = pc.not_equal(pc.is_null(a), pc.is_null(b))
        change[1:] |= pc.or_(differs, one_null).to_numpy(zero_copy_only=False)
    starts = np.append(np.flatnonzero(change), n).tolist()
    return list(zip(starts[:-1], starts[1:]))


def _key(batch: pa.RecordBatch, keys: list[str], row: int) -> tuple:
    return tuple(batch.column(k)[row].as_py() for k in keys)


def _readings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("_t").to_numpy(), batch.column("_x").to_numpy(zero_copy_only=False)


def _emitter(keys: list[str], interval: int, columns: list[str]):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, flag, last = None, False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ts, x = _readings(batch)
            runs = _runs(batch, keys)
            starts = np.array([a for a, _ in runs])
            flags, lasts = np.zeros(len(runs), bool), [None] * len(runs)
            if "_in_last" in batch.schema.names:
                took = pa.array(starts)
                flags = pc.fill_null(batch.column("_in_flag").take(took), False).to_numpy(zero_copy_only=False).copy()
                lasts = batch.column("_in_last").take(took).to_pylist()
            # only the first run of a batch can go on from the batch before
            if current == _key(batch, keys, 0):
                flags[0], lasts[0] = flag, last
            picked = events_in(ts, x, starts, interval, flags, [None if t is None else t + interval for t in lasts])
            flag, last = bool(flags[-1]), lasts[-1]
            if len(picked) and picked[-1] >= starts[-1]:
                flag, last = bool(x[picked[-1]]), int(ts[picked[-1]])
            current = _key(batch, keys, batch.num_rows - 1)
            out = batch.select(columns).take(pa.array(picked, pa.int64()))
            event = pa.array(np.where(x[picked], ALERT, RECOVERED), pa.string())
            yield pa.RecordBatch.from_arrays([*out.columns, event], names=[*columns, "event"])

    return emit


def _summariser(keys: list[str], interval: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, cells, ts, x = None, [], [], []

        def finish() -> pa.RecordBatch:
            s = summarise(np.concatenate(ts), np.concatenate(x), interval)
            types = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.bool_(), pa.int64(), pa.int64()]
            values = [pa.array([v], t) for v, t in zip(s.values(), types)]
            return pa.RecordBatch.from_arrays([*cells, *values], names=[*keys, *s])

        for batch in batches:
            t, b = _readings(batch)
            for start, end in _runs(batch, keys):
                key = _key(batch, keys, start)
                if key != current:
                    if current is not None:
                        yield finish()
                    current, ts, x = key, [], []
                    cells = [batch.column(k).slice(start, 1) for k in keys]
                ts.append(t[start:end])
                x.append(b[start:end])
        if current is not None:
            yield finish()

    return run


_SUMMARY = (
    "limit array<bigint>, exit_flag array<boolean>, exit_last array<bigint>, "
    "clear_flag boolean, clear_last bigint, before_clear bigint"
)


def _entry_states(cut: DataFrame, series: list[str], order: list[str], interval: int) -> DataFrame:
    """Entry state of each range of the hot series (at most hot series x ranges rows)."""
    keys = [*series, CHUNK]
    types = {f.name: f.dataType.simpleString() for f in cut.schema.fields}
    key_ddl = ", ".join(f"`{k}` {types[k]}" for k in keys)
    hot = cut.filter(F.col(CHUNK) > 0).select(*keys, *[F.col(f"`{c}`") for c in order if c not in keys], "_t", "_x")
    placed = hot.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, "_t", "_x")
    summaries = placed.mapInArrow(_summariser(keys, interval), f"{key_ddl}, {_SUMMARY}")

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by(CHUNK)
        flag, last, flags, lasts = False, None, [], []
        for summary in table.select([c for c in table.schema.names if c not in keys]).to_pylist():
            flags.append(flag)
            lasts.append(last)
            flag, last = leave(summary, interval, flag, last)
        out = table.select(keys)
        return out.append_column("_in_flag", pa.array(flags, pa.bool_())).append_column(
            "_in_last", pa.array(lasts, pa.int64())
        )

    # at most one small row per range, so a series' group is bounded
    return summaries.groupBy(*series).applyInArrow(chain, f"{key_ddl}, _in_flag boolean, _in_last bigint")


def alert_events(df: DataFrame, series: list[str], ts: str, exceeded: Column, interval_seconds: float,
                 tiebreak: list[str] = (), ranges: Ranges | None = None, keep: list[str] | None = None) -> DataFrame:
    """Alert and recovery rows with ``event``: at most one alert per interval and series.

    Of the columns, ``keep`` (all by default) come out; others that no rule needs
    aren't read.  Readings without a time are left to :func:`untimed`.
    """
    interval = int(interval_seconds * 1_000_000)
    order = [ts, *tiebreak]
    columns = list(keep or df.columns)
    needed = list(dict.fromkeys([*columns, *series, *order]))
    marked = df.filter(F.col(ts).isNotNull()).select(
        *[F.col(f"`{c}`") for c in needed], time_micros(df, ts).alias("_t"), F.coalesce(exceeded, F.lit(False)).alias("_x")
    )
    ranges = find_ranges(marked, series, order) if ranges is None else ranges
    schema = T.StructType([*[df.schema[c] for c in columns], T.StructField("event", T.StringType())])
    cut = marked.withColumn(CHUNK, ranges.chunk(series))
    keys = [*series, CHUNK]
    if ranges.bounds:
        states = F.broadcast(_entry_states(cut, series, order, interval))
        cond = key_match("r", "s", keys)
        cut = cut.alias("r").join(states.alias("s"), cond, "left").select("r.*", "s._in_flag", "s._in_last")
    placed = cut.repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.mapInArrow(_emitter(keys, interval, columns), schema)


def alert_suppress(df: DataFrame, series: list[str], ts: str, exceeded: Column, interval_seconds: float,
                   tiebreak: list[str] = (), ranges: Ranges | None = None, keep: list[str] | None = None) -> DataFrame:
    return alert_events(df, series, ts, exceeded, interval_seconds, tiebreak, ranges, keep).filter(F.col("event") == ALERT).drop("event")


def alert_recovered(df: DataFrame, series: list[str], ts: str, exceeded: Column, interval_seconds: float,
                    tiebreak: list[str] = (), ranges: Ranges | None = None, keep: list[str] | None = None) -> DataFrame:
    return alert_events(df, series, ts, exceeded, interval_seconds, tiebreak, ranges, keep).filter(F.col("event") == RECOVERED).drop("event")
