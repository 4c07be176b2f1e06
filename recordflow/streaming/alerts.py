"""Alert suppression over a stream of metrics, with the same rule as the batch operator."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.timestamps import from_micros
from recordflow.operators.alerts import ALERT, RECOVERED, time_micros, walk

STATE = "flag boolean, last bigint"


def stream_alert_events(stream: DataFrame, series: str, ts: str, value: str, exceeded: Column,
                        interval_seconds: float) -> DataFrame:
    """(series, ts, value, event) rows; the two-value state of each series outlives the micro-batches."""
    interval = int(interval_seconds * 1_000_000)
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    rows = stream.select(
        F.col(series), time_micros(stream, ts).alias("_t"), F.col(value),
        F.coalesce(exceeded, F.lit(False)).alias("_x"),
    ).filter(F.col("_t").isNotNull())

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        flag, last = state.get if state.exists else (False, None)
        parts = list(frames)
        # without a breach or an alert to recover from there is no event, and the state stays
        if not flag and not any(f["_x"].any() for f in parts):
            return
        rows = (pd.concat(parts) if len(parts) > 1 else parts[0]).sort_values(["_t", value])
        where, kinds, flag, last = walk(rows["_t"].to_numpy(), rows["_x"].to_numpy(), interval, flag, last)
        if last is not None:
            state.update((flag, last))
        if not where:
            return
        out = rows.iloc[where]
        yield pd.DataFrame({
            series: [key[0]] * len(out), "_t": out["_t"].to_numpy(), value: out[value].to_numpy(),
            "event": [ALERT if k else RECOVERED for k in kinds],
        })

    schema = f"`{series}` {types[series]}, _t bigint, `{value}` {types[value]}, event string"
    events = rows.groupBy(series).applyInPandasWithState(step, schema, STATE, "append", "NoTimeout")
    return events.select(
        series, (F.timestamp_micros("_t") if types[ts] == "timestamp" else from_micros(F.col("_t")).cast(types[ts])).alias(ts), value, "event"
    )
