import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.operators import alerts, skew


def naive(ts, breach, interval, flag=False, last=None):
    """The rule, one reading at a time."""
    where, kinds = [], []
    for i, (t, x) in enumerate(zip(ts, breach)):
        if x:
            if last is not None and t < last + interval:
                continue
            flag, last = True, t
            where.append(i)
            kinds.append(True)
        elif flag:
            flag, last = False, t
            where.append(i)
            kinds.append(False)
    return where, kinds, flag, last


def series(rnd, n, step=5):
    t, out = 0, []
    for _ in range(n):
        t += rnd.randrange(step)
        out.append(t)
    p = rnd.random()
    return np.array(out, dtype=np.int64), np.array([rnd.random() < p for _ in range(n)], dtype=bool)


def test_walk_equals_the_rule():
    rnd = random.Random(1)
    for _ in range(400):
        ts, x = series(rnd, rnd.randrange(1, 40))
        interval = rnd.randrange(0, 20)
        start = (rnd.random() < 0.5, int(ts[0]) - rnd.randrange(30)) if rnd.random() < 0.7 else (False, None)
        assert alerts.walk(ts, x, interval, *start) == naive(ts.tolist(), x.tolist(), interval, *start)


def test_summaries_chain_to_the_same_states():
    rnd = random.Random(2)
    for _ in range(600):
        ts, x = series(rnd, rnd.randrange(2, 60))
        interval = rnd.randrange(0, 25)
        cuts = sorted({0, len(ts), *(rnd.randrange(len(ts) + 1) for _ in range(4))})
        flag, last = False, None
        for a, b in zip(cuts[:-1], cuts[1:]):
            want = alerts.walk(ts[a:b], x[a:b], interval, flag, last)[2:]
            got = alerts.leave(alerts.summarise(ts[a:b], x[a:b], interval), interval, flag, last)
            assert got == want, (ts[a:b], x[a:b], interval, flag, last)
            flag, last = want


def events_of(df):
    return sorted(((r["s"], r["seq"], r["event"]) for r in df.select("s", "seq", "event").collect()), key=repr)


@pytest.mark.parametrize("interval", [0, 7, 400])
def test_hot_series_in_ranges_equals_one_scan(spark, interval):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot", "hot", "b", None]), i, rnd.randrange(5000), rnd.random() < 0.6) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, seq int, sec int, x boolean").withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz"))
    ranges = skew.find_ranges(df, ["s"], ["ts", "seq"])
    assert len(ranges.bounds) >= 4
    hot = alerts.alert_events(df, ["s"], "ts", F.col("x"), interval, ["seq"], ranges)
    plain = alerts.alert_events(df, ["s"], "ts", F.col("x"), interval, ["seq"], skew.Ranges())
    assert events_of(hot) == events_of(plain)
    want = []
    for s in ("hot", "b", None):
        mine = sorted((sec, i, x) for k, i, sec, x in rows if k == s)
        where, kinds, _, _ = naive([m[0] for m in mine], [m[2] for m in mine], interval)
        want += [(s, mine[w][1], "ALERT" if k else "RECOVERED") for w, k in zip(where, kinds)]
    assert events_of(hot) == sorted(want, key=repr)


def test_alert_output_keeps_every_column_exactly(spark):
    big = (1 << 60) + 1
    df = spark.createDataFrame([("a", big, 9.0, [1, 2]), ("a", None, 9.5, None)], "s string, n bigint, v double, l array<int>").withColumn(
        "ts", F.timestamp_seconds(F.col("v").cast("bigint")).cast("timestamp_ntz"))
    out = alerts.alert_events(df, ["s"], "ts", F.col("v") > 1, 0, ["v"], skew.Ranges()).orderBy("v").collect()
    assert [(r["n"], r["l"], r["event"]) for r in out] == [(big, [1, 2], "ALERT"), (None, None, "ALERT")]


def test_thresholds(spark):
    df = spark.createDataFrame([(80, 100), (81, 100), (10, 0), (None, 100)], "used bigint, total bigint")
    keep = lambda *a, **k: [r["used"] for r in alerts.threshold_filter(df, "used", *a, **k).collect()]
    assert keep("80%", "total") == [81, 10]                    # above the whole part of the share
    assert keep("80%", "total", inclusive=True) == [80, 81]   # at or above, and no share of nothing
    assert keep(80) == [81] and keep("1 KB") == []
    with pytest.raises(ValueError):
        keep("80%")
    with pytest.raises(ValueError):
        keep("lots")


def test_edges(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate([False, True, True, False, True])], "t int, x boolean").withColumn("s", F.lit(1))
    out = alerts.breach_edges(df, ["s"], ["t"], F.col("x")).orderBy("t").collect()
    assert [(r["t"], r["edge"]) for r in out] == [(1, "UP"), (3, "DOWN"), (4, "UP")]


def test_events_of_many_runs_at_once():
    rnd = random.Random(8)
    for _ in range(300):
        parts = [series(rnd, rnd.randrange(1, 25)) for _ in range(rnd.randrange(1, 6))]
        interval = rnd.choice([0, 3, 12, 10**15])
        states = [(rnd.random() < 0.5, int(ts[0]) - rnd.randrange(30)) if rnd.random() < 0.6 else (False, None) for ts, _ in parts]
        sizes = [len(ts) for ts, _ in parts]
        starts = np.cumsum([0, *sizes[:-1]])
        shift = [rnd.randrange(-(10**15), 10**15) for _ in parts]
        ts, x = np.concatenate([t + s for (t, _), s in zip(parts, shift)]), np.concatenate([b for _, b in parts])
        free = [None if last is None else last + s + interval for (_, last), s in zip(states, shift)]
        got = alerts.events_in(ts, x, starts, interval, np.array([f for f, _ in states]), free).tolist()
        want = [int(a) + i for a, (t, b), st in zip(starts, parts, states) for i in naive(t.tolist(), b.tolist(), interval, *st)[0]]
        assert got == want


def test_events_do_not_depend_on_the_session_zone(spark):
    """A clock of New York skips from 2 to 3 on this day; wall-clock readings don't."""
    rows = spark.createDataFrame([("a", "2024-03-10 01:30:00", 9), ("a", "2024-03-10 03:30:00", 9), ("a", None, 9)], "s string, at string, v int")
    rows = rows.withColumn("at", F.col("at").cast("timestamp_ntz"))
    found = {}
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found[zone] = alerts.alert_suppress(rows, ["s"], "at", F.col("v") > 5, 90 * 60).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(found["UTC"]) == 2 and found["UTC"] == found["America/New_York"]
    assert [(r["v"], r["_reason"]) for r in alerts.untimed(rows, "at").collect()] == [(9, "at must not be null")]


def test_only_needed_columns_are_read(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = alerts.alert_suppress(events, ["user_id"], "ts", F.col("value") > 300.0, 3600, ["event_id"], keep=["event_id", "user_id"])
    assert out.columns == ["event_id", "user_id"]
    schema = out._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
    assert "props" not in schema and "event_type" not in schema
