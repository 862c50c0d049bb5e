"""Queries against their SQL on rows that the smallest tables don't hold."""

import datetime as dt

import duckdb
import pandas as pd
import pytest

from tickloom.plans import market

T = lambda h, m=0, s=0: dt.datetime(2024, 1, 2, h, m, s)


def agrees(spark, path, name: str, events: list[tuple]) -> list[tuple]:
    """The query's rows over these events (id, time, user, type, value), after its SQL has given the same."""
    e = pd.DataFrame(events, columns=["event_id", "ts", "user_id", "event_type", "value"]).assign(props="{}").astype({"ts": "datetime64[us]", "value": float})
    e.to_parquet(f"{path}/events.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet'")
    got = market.queries()[name](spark, str(path))
    want = duck.execute(market.oracle_sql()[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = sorted(map(tuple, got.select(*names).collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str)
    return rows


def test_an_hour_with_a_price_of_zero_is_invalid(spark, tmp_path):
    """F1."""
    hours = [(h, m, v) for h in (10, 11) for m in range(12) for v in [0.0 if h == 10 and m == 3 else 5.0 + m]]
    events = [(k, T(h, m), 1, "click", v) for k, (h, m, v) in enumerate(hours)] + [(80, T(12, 1), 1, "click", 0.0), (81, T(14, 1), 1, "click", 1.0)]
    events += [(90 + k, T(11 + k, 30), 1, "view", 1.0) for k in range(4)]
    rows = agrees(spark, tmp_path, "asof_exact_previous_hour", events)
    assert {r[0]: r[1] for r in rows} == {90: "INVALID_OHLC", 91: "COMPLETE", 92: "INCOMPLETE_HOUR", 93: "MISSING_HOUR"}


def test_a_price_of_zero_is_unreadable(spark, tmp_path):
    """F4."""
    rows = agrees(spark, tmp_path, "stream_clean_events", [(1, T(10), 1, "click", 0.0), (2, T(10), 1, "view", 2.5), (3, T(10), 1, "error", 2.5)])
    assert sorted(rows) == [("bad", 2), ("ok", 1)]


def wire_event(k: int, symbol: int, day: int, ms: int) -> tuple:
    """A click that the live minute's wire holds `ms` after 9:30 of a day."""
    return (k, dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=day * 518_400_000 + ms * 144), symbol * 75, "click", 1.0)


def test_symbols_silent_at_the_end_are_idle(spark, tmp_path):
    """symbol 0 is 100 ms more than an hour behind the newest arrival, symbol 1 an hour, symbol 2 100 ms less."""
    events = [wire_event(k, k - 1, 0, (k - 1) * 100) for k in (1, 2, 3)] + [wire_event(17, 3, 0, 100 + 3_500_200)]  # 17 arrives after 100 s, the others after 0.2 s
    rows = dict(agrees(spark, tmp_path, "live_counters", events))
    assert rows["accepted_events"] == 4 and rows["idle_symbols"] == rows["minute_buckets_evicted"] == 2


def test_symbols_idle_at_the_end_lose_their_minutes(spark, tmp_path):
    """symbol 2 falls silent on the last day, symbol 1 doesn't."""
    events = [wire_event(10 * day + s, s, day, 60_000) for day in range(5) for s in (1, 2)] + [wire_event(100, 1, 4, 3_540_000)]
    rows = agrees(spark, tmp_path, "state_retention", events)
    assert {r for r in rows if r[1] == "idle_symbols"} == {("q1", "idle_symbols", 1), ("q2", "idle_symbols", 1), ("2", "idle_symbols", 1)}
