"""The live minute stream: hand-written rows, cuts of batches, replays, and counters that a listener sees."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tickloom.plans import live as plans
from tickloom.streaming import live

SF = "/root/testdata/sf0.001"
T = lambda m, s=0, ms=0: dt.datetime(2024, 1, 2, 10, m, s, ms * 1000)
BOOK = ([100_000] * 10, [100_200] * 10, [100] * 10, [300] * 10)


def row(seq, ts, recv, channel, kind="", side="", price=100_100, volume=100, book=(None,) * 4):
    return ("a", seq, ts, recv, channel, kind, side, price, volume, *book)


def test_one_minute_by_hand(spark, tmp_path):
    rows = [
        row(1, T(0, 1), T(0, 1), "market", book=BOOK),
        row(2, T(0, 2), T(0, 2), "trans", "trade", "B", 100_200, 10_000_000),
        row(3, T(0, 3), T(0, 3), "order", "add", "B", 99_960, 10),  # within five basis points of 10.00
        row(4, T(0, 4), T(0, 4), "order", "add", "B", 99_940, 10),  # too far
        row(5, T(0, 5), T(0, 5), "trans", "cancel", "B", 100_000, 5),
        row(6, T(0, 0), T(0, 6), "order", "add", "S", 100_000, 5),  # before any book
        row(7, T(0, 7), T(0, 7), "trans", "cancel", "", 100_000, 5),
    ]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, live.EVENT).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(live.EVENT).parquet(source)
    out = plans.sinks(stream, str(tmp_path / "out"), 16)
    (m,) = live.live_metrics(plans.newest(out["minutes"])).collect()
    assert (m.revision, m.event_count, m.accepted_late_event_count, m.volume_1m, m.amount_1m, m.large_buy_amount_1m) == (7, 7, 1, 10_000_000, 1.002e8, 1.002e8)
    assert (m.near_bid_add_amount, m.near_bid_cancel_amount, m.near_ask_add_amount) == (99.96, 50.0, 0.0)
    assert (m.obi_top1, m.mid_price, m.microprice, m.bid_wall_score, m.depth_ask_top10) == (-0.5, 10.01, (10.02 * 100 + 10.0 * 300) / 400, 0.1, 3000)
    assert m.fake_bid_support_score == pytest.approx(50 / 99.96 * 500 / 4000)
    assert m.quality_flags == "cancel_side_unverified|missing_causal_book|out_of_order_received"
    assert {r.counter: r.counted for r in out["counters"].collect()} == {"accepted_events": 7, "accepted_late_events": 1, "missing_causal_book": 1}


def test_cuts_of_batches_change_nothing(spark, tmp_path):
    rows = plans.wire(spark, SF)
    one = str(tmp_path / "one")
    rows.coalesce(1).write.parquet(f"{one}/in")
    whole = plans.sinks(plans.checked(spark.readStream.schema(rows.schema).parquet(f"{one}/in")), one, 16)
    cut = plans.run_live(spark, SF, str(tmp_path / "cut"))
    show = lambda x: sorted(map(str, live.live_metrics(plans.newest(x["minutes"])).collect()))
    assert show(whole) == show(cut)
    count = lambda x: {r[0]: r[1] for r in x["counters"].groupBy("counter").agg(F.sum("counted")).collect()}
    assert count(whole) == count(cut)


class Seen(StreamingQueryListener):
    def __init__(self):
        self.rows = self.counted = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if found := event.progress.observedMetrics.get("live"):
            self.rows += found.rows
            self.counted += found.counted or 0

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def test_a_listener_sees_what_the_sinks_hold(spark, tmp_path):
    seen = Seen()
    spark.streams.addListener(seen)
    try:
        path = str(tmp_path / "x")
        stream = plans.checked(plans.in_batches(plans.wire(spark, SF), f"{path}/in"))
        out = live.run_to_sinks(live.live_minutes(stream), path, {"all": lambda b: b}, "update", "live")["all"]
        want = out.agg(F.count("*"), F.sum("counted")).first()
        for _ in range(100):
            if (seen.rows, seen.counted) == tuple(want):
                break
            time.sleep(0.1)
        assert (seen.rows, seen.counted) == tuple(want)
    finally:
        spark.streams.removeListener(seen)


def test_orders_wait_for_books_of_later_batches(spark, tmp_path):
    schema = "symbol string, ts timestamp, seq long, is_book boolean, price double, amount double, cancel boolean"
    parts = (
        [("a", T(5), 1, True, 1.0, 0.0, False), ("a", T(6), 2, False, 1.0, 9.0, False), ("b", T(1), 3, False, 1.0, 9.0, True)],
        [("a", T(5, 30), 4, True, 2.0, 0.0, False), ("a", T(5, 30), 5, False, 1.0, 9.0, False)],  # a book before the order of the first batch
        [("z", T(50), 6, True, 1.0, 0.0, False)],
    )
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = live.run_to_sinks(live.causal_book(stream, "5 minutes"), str(tmp_path / "out"), {"x": lambda b: b})["x"]
    assert sorted((r.seq, r.mid) for r in got.collect() if r.symbol == "a") == [(2, 2.0), (5, 2.0)]
    assert [r.mid for r in got.collect() if r.symbol == "b"] == [None]


def test_bounds(spark):
    with pytest.raises(ValueError):
        live.live_minutes(spark.readStream.schema(live.EVENT).parquet(SF), late=901)
    with pytest.raises(ValueError):
        live.live_minutes(spark.readStream.schema(live.EVENT).parquet(SF), late=150, retain=2)
