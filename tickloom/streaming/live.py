"""The live minute: trades, orders and ten-level books of one stream, with keyed state, timers, counters and sinks.

Rows count in order of arrival (`recv`, `seq`), so results don't depend on where micro-batches are cut as long as batches
follow that order. The watermark runs on arrival too: no row is late for it, and lateness is judged by each symbol's own
latest event. State is one value, a map of minutes and a list of books for each symbol, all bounded by retention; timers
evict symbols that fall silent. State holds sums only; ratios and scores are column expressions over what it emits.
A symbol's rows of one micro-batch meet in one task; the source's limits on a batch bound them.
"""

from __future__ import annotations

import sys
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.scalars import clip, ratio
from tickloom.streaming.minutes import clean_events

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the process that prepares a stateful stream doesn't share the driver's path

#: symbol, channel (market, trans, order), kind (trade, add, cancel), side (B, S, empty: unknown), times, whole prices in
#: 1/10000, and the ten levels of a market row.
EVENT = "symbol string, seq long, ts timestamp, recv timestamp, channel string, kind string, side string, price long, volume long, bid_price array<long>, ask_price array<long>, bid_volume array<long>, ask_volume array<long>"
MINUTE_US, DAY_US, TICK, LARGE = 60_000_000, 86_400_000_000, 10_000, 500_000
SUMS = ("n", "late", "trades", "adds", "cancels", "trans_cancels", "volume", "amount", "buy_volume", "buy_amount", "sell_volume", "sell_amount", "large_buy", "large_sell", "bid_add", "ask_add", "bid_cancel", "ask_cancel")
BOOK = "us long, recv long, seq long, bid_price array<long>, ask_price array<long>, bid_volume array<long>, ask_volume array<long>"
LEVELS = ("bid_price", "ask_price", "bid_volume", "ask_volume")
_SUMS = ", ".join(f"{c} long" for c in SUMS)
MINUTE = f"revision long, {_SUMS}, first array<long>, last array<long>, high long, low long, delay_us long, flags array<string>, book struct<{BOOK.replace(' ', ':').replace(',:', ', ')}>"
EMITTED = f"symbol string, minute timestamp, revision long, available timestamp, {_SUMS}, open long, high long, low long, close long, delay_us long, flags array<string>, book_us long, {', '.join(f'{c} array<long>' for c in LEVELS)}, close_1 long, close_3 long, close_5 long, prior array<long>, prior_depth long, counter string, counted long"
NAMES = [c.split()[0] for c in EMITTED.split(", ")]


def plain(x):
    """A value from state or Arrow as plain Python."""
    return x.tolist() if isinstance(x, np.ndarray) else x


def replaced(state, rows: list[tuple]) -> None:
    """A list state of these rows; no state at all where there are none."""
    state.put(rows) if rows else state.clear()


class Bucket:
    """One minute of one symbol."""

    def __init__(self, saved: tuple | None = None):
        if saved is None:
            self.revision, self.sum, self.first, self.last, self.high, self.low, self.delay, self.flags, self.book = 0, Counter(), [], [], None, None, 0, set(), None
            return
        self.revision, *sums = saved[: len(SUMS) + 1]
        self.sum = Counter(dict(zip(SUMS, sums, strict=True)))
        first, last, self.high, self.low, self.delay, flags, book = saved[len(SUMS) + 1 :]
        self.first, self.last, self.flags, self.book = list(plain(first)), list(plain(last)), set(flags), book and tuple(plain(x) for x in book)

    def saved(self) -> tuple:
        return (self.revision, *(self.sum[c] for c in SUMS), self.first, self.last, self.high, self.low, self.delay, sorted(self.flags), self.book)

    def priced(self, price: int, order: list[int]) -> None:
        """First and last are the order of a row (event time, arrival, number) and its price."""
        if price <= 0:
            return
        self.first = min(self.first or [*order, price], [*order, price])
        self.last = max(self.last, [*order, price])
        self.high, self.low = max(self.high or price, price), min(self.low or price, price)

    def traded(self, side: str, price: int, volume: int) -> None:
        amount, big = price * volume, price * volume >= LARGE * TICK
        self.sum.update(trades=1, volume=volume, amount=amount)
        for mark, name in (("B", "buy"), ("S", "sell")):
            if side == mark:
                self.sum.update({f"{name}_volume": volume, f"{name}_amount": amount, f"large_{name}": amount * big})

    def ordered(self, causal: tuple | None, channel: str, kind: str, side: str, price: int, volume: int, counts: Counter) -> None:
        """Adds and cancels within five basis points of the best price of their side."""
        cancel = kind == "cancel"
        self.sum["trans_cancels" if channel == "trans" else "cancels" if cancel else "adds"] += 1
        if side not in ("B", "S"):
            self.flags.add("cancel_side_unverified")
        elif not price:
            self.flags.add("unpriced_cancel" if channel == "trans" else "unpriced_order")
        elif not causal or causal[3 if side == "B" else 4][0] <= 0:
            self.flags.add("missing_causal_book")
            counts["missing_causal_book"] += 1
        else:
            best = causal[3 if side == "B" else 4][0]
            if price * 10_000 >= best * 9_995 if side == "B" else price * 10_000 <= best * 10_005:
                self.sum[f"{'bid' if side == 'B' else 'ask'}_{'cancel' if cancel else 'add'}"] += price * volume


class LiveMinutes(StatefulProcessor):
    """Emits each minute that a batch touched once, as it stood after its last accepted row, and the batch's counters.

    Rows of an earlier day than the symbol's latest, older than `late` before its latest event, or of a minute that
    retention has dropped are counted and change nothing. A new day clears the state. A late row changes its minute, but a minute
    older than the newest one emitted isn't emitted again. A symbol without rows for `idle` of the arrival clock loses its
    minutes and books; its latest time stays for `forget` more, so that rows of dropped minutes still count as such.
    """

    def __init__(self, late: float, retain: int, idle: float, forget: float, history: int = 128):
        self.late, self.retain, self.idle, self.forget, self.history = int(late * 1e6), retain, int(idle * 1e3), int(forget * 1e3), history

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "last long, shown long, floor long, recv_ms long")
        self.minutes = handle.getMapState("minutes", "minute long", MINUTE)
        self.books = handle.getListState("books", BOOK)

    def handleInputRows(self, key: tuple, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values(["recv", "seq"], ignore_index=True)
        us, recv = (d[c].to_numpy("datetime64[us]").astype("int64") for c in ("ts", "recv"))
        last, shown, floor, _ = self.head.get() if self.head.exists() else (int(us[0]), -1, -1, 0)
        before = np.maximum.accumulate(np.concatenate([[last], us]))[:-1]
        own, cutoff = us // MINUTE_US, np.maximum(np.maximum(before, us) // MINUTE_US - (self.retain - 1), floor)
        fate = np.select([us // DAY_US < before // DAY_US, (us // DAY_US == before // DAY_US) & (us < before - self.late), own < cutoff], ["previous_day_rejected", "beyond_lateness_rejected", "retention_rejected"], "accepted_events")
        good = fate == "accepted_events"
        newest = np.maximum.accumulate(np.concatenate([[shown], np.where(good, own, -1)]))
        emits = good & (own >= newest[:-1])
        counts = Counter(fate.tolist())
        counts["older_minute_not_emitted"] = int((good & ~emits).sum())
        final = dict(zip(own[emits].tolist(), np.flatnonzero(emits).tolist(), strict=True))  # the last row of each minute
        day = last // DAY_US
        held = {m[0]: Bucket(v) for m, v in self.minutes.iterator()}
        books = {b[0]: tuple(plain(x) for x in b) for b in self.books.get()}
        stored, at, out = set(held), sorted(books), []
        cells = {c: d[c].tolist() for c in ("seq", "channel", "kind", "side", "price", "volume", *LEVELS)}
        for k in np.flatnonzero(good).tolist():
            t, m, order = int(us[k]), int(own[k]), [int(us[k]), int(recv[k]), cells["seq"][k]]
            if t // DAY_US > day:
                held, books, at, day = {}, {}, [], t // DAY_US
                counts["daily_resets"] += 1
            b = held.setdefault(m, Bucket())
            b.sum["n"] += 1
            b.delay = order[1] - t
            if t < before[k] and t // DAY_US == before[k] // DAY_US:
                b.sum["late"] += 1
                b.flags.add("out_of_order_received")
                counts["accepted_late_events"] += 1
            i = bisect_right(at, t)
            causal = books[at[i - 1]] if i else b.book if b.book and b.book[0] <= t else None
            channel, kind, side, price, volume = (cells[c][k] for c in ("channel", "kind", "side", "price", "volume"))
            if channel == "market":
                if t not in books:
                    insort(at, t)
                if t not in books or tuple(order) > books[t][:3]:
                    books[t] = (*order, *(plain(cells[c][k]) for c in LEVELS))
                b.priced(price, order)
            elif kind == "trade":
                b.priced(price, order)
                b.traded(side, price, volume)
            else:
                b.ordered(causal, channel, kind, side, price, volume, counts)
            if i := bisect_right(at, (m + 1) * MINUTE_US - 1):
                b.book = max(b.book or (), books[at[i - 1]])
            old = [x for x in held if x < cutoff[k]]
            gone = max(bisect_right(at, (int(cutoff[k]) - 1) * MINUTE_US - 1), len(at) - self.history)
            counts.update(minute_buckets_evicted=len(old), book_history_evicted=max(gone, 0))
            for x in old:
                del held[x]
            for x in at[: max(gone, 0)]:
                del books[x]
            at = at[max(gone, 0) :]
            if emits[k]:
                b.revision += 1
            if final.get(m) == k:
                out.append(self.shown(key[0], m, b, held, order[1]))
        for m in stored - set(held):
            self.minutes.removeKey((m,))
        for m, b in held.items():
            self.minutes.updateValue((m,), b.saved())
        replaced(self.books, [books[t] for t in at])
        recv_ms = int(recv[-1]) // 1000
        self.head.update((int(max(before[-1], us[-1])), int(newest[-1]), floor, recv_ms))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(recv_ms + self.idle)
        yield self.frame(out, key[0], counts)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, shown, floor, recv_ms = self.head.get()
        counts = Counter()
        if expiredTimerInfo.getExpiryTimeInMs() >= recv_ms + self.idle + self.forget:
            self.head.clear()
            counts["forgotten_symbols"] = 1
        else:
            if self.minutes.exists() or self.books.exists():
                counts.update(minute_buckets_evicted=len(list(self.minutes.keys())), book_history_evicted=len(list(self.books.get())), idle_symbols=1)
                self.minutes.clear()
                self.books.clear()
                self.head.update((last, shown, max(floor, shown + 1), recv_ms))
            self.handle.registerTimer(recv_ms + self.idle + self.forget)
        yield self.frame([], key[0], counts)

    @staticmethod
    def shown(symbol: str, m: int, b: Bucket, held: dict, recv: int) -> dict:
        close = lambda k: held[m - k].last[-1] if m - k in held and held[m - k].last else None
        was = held[m - 1].book if m - 1 in held else None
        row = {"symbol": symbol, "minute": pd.Timestamp(m * MINUTE_US, unit="us"), "available": pd.Timestamp(recv, unit="us"), "revision": b.revision, **{c: b.sum[c] for c in SUMS}}
        row |= {"open": b.first[-1] if b.first else None, "close": b.last[-1] if b.last else None, "high": b.high, "low": b.low, "delay_us": b.delay, "flags": sorted(b.flags)}
        row |= {"close_1": close(1), "close_3": close(3), "close_5": close(5), "prior": [held[x].sum["amount"] for x in sorted(held) if x < m][-10:], "prior_depth": sum(was[5]) + sum(was[6]) if was else None}
        return row | (dict(zip(("book_us", *LEVELS), (b.book[0], *b.book[3:]), strict=True)) if b.book else {})

    @staticmethod
    def frame(rows: list[dict], symbol: str, counts: Counter) -> pd.DataFrame:
        rows = rows + [{"symbol": symbol, "counter": c, "counted": n} for c, n in counts.items() if n]
        return pd.DataFrame([[row.get(c) for c in NAMES] for row in rows], columns=NAMES, dtype=object).astype({c: "datetime64[us]" for c in ("minute", "available")})


def live_minutes(events: DataFrame, late: float = 150, retain: int = 16, idle: float = 3600, forget: float = 86_400) -> DataFrame:
    """The log of `LiveMinutes` over a stream of EVENT rows: rows of minutes, and rows with a counter. Times are seconds."""
    if not 0 <= late <= 900 or not 2 <= retain <= 600 or late > 60 * (retain - 1):
        raise ValueError("lateness of at most 15 minutes and less than the retained minutes, of which there are 2 to 600")
    return events.withWatermark("recv", "0 seconds").groupBy("symbol").transformWithStateInPandas(LiveMinutes(late, retain, idle, forget), T.StructType.fromDDL(EMITTED), "Update", "EventTime")


def _total(levels: str, n: int) -> Column:
    return F.aggregate(F.slice(levels, 1, n), F.lit(0).cast("long"), lambda s, x: s + x)


def _clipped(c: Column) -> Column:
    return clip(c, 0.0, 1.0)


def live_metrics(log: DataFrame) -> DataFrame:
    """The published metrics of each emitted minute, from its sums, its book and the minutes before it."""
    money = lambda c: F.col(c) / float(TICK)
    amounts = {f"{to}": money(c) for to, c in (("open_1m", "open"), ("high_1m", "high"), ("low_1m", "low"), ("close_1m", "close"), ("last_price", "close"), ("amount_1m", "amount"), ("active_buy_amount_1m", "buy_amount"), ("active_sell_amount_1m", "sell_amount"), ("large_buy_amount_1m", "large_buy"), ("large_sell_amount_1m", "large_sell"), ("near_bid_add_amount", "bid_add"), ("near_ask_add_amount", "ask_add"), ("near_bid_cancel_amount", "bid_cancel"), ("near_ask_cancel_amount", "ask_cancel"))}
    counts = {"event_count": "n", "accepted_late_event_count": "late", "trade_count_1m": "trades", "order_add_count_1m": "adds", "order_cancel_count_1m": "cancels", "trans_cancel_count_1m": "trans_cancels", "volume_1m": "volume", "active_buy_volume_1m": "buy_volume", "active_sell_volume_1m": "sell_volume"}
    rows = log.where("minute is not null").withColumns(amounts | {to: F.col(c) for to, c in counts.items()})
    active = F.col("active_buy_amount_1m") + F.col("active_sell_amount_1m")
    vwap = ratio("amount_1m", "volume_1m")
    mean = lambda c: ratio(F.aggregate(c, F.lit(0.0), lambda s, x: s + x), F.size(c))
    prior = F.transform("prior", lambda x: x / float(TICK))
    five = F.slice("_prior", F.greatest(F.size("_prior") - 4, F.lit(1)), 5)
    rows = rows.withColumns({"_prior": prior}).withColumns({"_five": mean(five), "_mean": mean(F.col("_prior"))})
    rows = rows.withColumn("_sd", F.sqrt(mean(F.transform("_prior", lambda x: (x - F.col("_mean")) * (x - F.col("_mean"))))))
    rows = rows.withColumns(
        {
            "vwap_1m": vwap,
            "active_buy_ratio": ratio("active_buy_amount_1m", active),
            "active_sell_ratio": ratio("active_sell_amount_1m", active),
            "large_trade_imbalance": ratio(F.col("large_buy") - F.col("large_sell"), F.col("large_buy") + F.col("large_sell")),
            "bid_cancel_add_ratio": ratio("bid_cancel", "bid_add"),
            "ask_cancel_add_ratio": ratio("ask_cancel", "ask_add"),
            "price_impact_bps": ratio((F.col("close") - F.col("open")) * 10_000, "open"),
            "data_delay_ms": F.col("delay_us") / 1000.0,
            **{f"ret_{k}m": ratio("close", f"close_{k}") - 1 for k in (1, 3, 5)},
            "vol_ratio_1m": F.when((F.size("_prior") > 0) & (F.col("_five") > 0), F.col("amount_1m") / F.col("_five")),
            "trade_intensity_zscore": F.when(F.size("_prior") >= 3, F.when(F.col("_sd") > 1e-9, (F.col("amount_1m") - F.col("_mean")) / F.col("_sd")).otherwise(0.0)),
            "vwap_gap_bps": F.when(vwap > 0, (F.col("close_1m") - vwap) / vwap * 10_000),
            "snapshot_age_ms": (F.unix_micros("available") - F.col("book_us")) / 1000.0,
            **{f"depth_{side}_top{n}": _total(f"{side}_volume", n) for side in ("bid", "ask") for n in (1, 5, 10)},
            **{f"{side}_wall_score": ratio(F.array_max(f"{side}_volume"), _total(f"{side}_volume", 10)) for side in ("bid", "ask")},
        }
    )
    both = lambda n: F.col(f"depth_bid_top{n}") + F.col(f"depth_ask_top{n}")
    bid, ask = (F.try_element_at(f"{s}_price", F.lit(1)) / float(TICK) for s in ("bid", "ask"))
    rows = rows.withColumns({"_bid": bid, "_ask": ask}).withColumn("mid_price", F.when((F.col("_bid") > 0) & (F.col("_ask") > 0), (F.col("_bid") + F.col("_ask")) / 2))
    micro = F.when(F.col("mid_price").isNotNull(), ratio(F.col("_ask") * F.col("depth_bid_top1") + F.col("_bid") * F.col("depth_ask_top1"), both(1)))
    moved = ratio(both(10) - F.col("prior_depth"), "prior_depth")
    rows = rows.withColumns(
        {
            **{f"obi_top{n}": ratio(F.col(f"depth_bid_top{n}") - F.col(f"depth_ask_top{n}"), both(n)) for n in (1, 5, 10)},
            "spread_bps": (F.col("_ask") - F.col("_bid")) * 10_000 / F.col("mid_price"),
            "microprice": micro,
            "microprice_gap_bps": (micro - F.col("mid_price")) / F.col("mid_price") * 10_000,
            "depth_depletion_score": _clipped(-moved),
            "depth_recovery_score": _clipped(moved),
            "fake_bid_support_score": _clipped(F.col("bid_cancel_add_ratio") * ratio("depth_bid_top5", both(10))),
            "fake_ask_pressure_score": _clipped(F.col("ask_cancel_add_ratio") * ratio("depth_ask_top5", both(10))),
        }
    )
    consumed = lambda c: _clipped(F.col("depth_depletion_score") * F.col(c))
    flags = F.array_compact(F.concat("flags", F.array(F.when(F.col("book_us").isNull(), "missing_book_snapshot"), F.when((F.col("cancels") > 0) & (F.col("trans_cancels") > 0), "combined_cancel_scope_unverified"))))
    rows = rows.withColumns({"queue_consume_bid_score": consumed("active_sell_ratio"), "queue_consume_ask_score": consumed("active_buy_ratio"), "quality_flags": F.array_join(F.sort_array(flags), "|"), "trade_date": F.to_date("minute"), "book_snapshot_ts": F.timestamp_micros("book_us")})
    made = ["vwap_1m", "active_buy_ratio", "active_sell_ratio", "large_trade_imbalance", "bid_cancel_add_ratio", "ask_cancel_add_ratio", "price_impact_bps", "data_delay_ms", "ret_1m", "ret_3m", "ret_5m", "vol_ratio_1m", "trade_intensity_zscore", "vwap_gap_bps", "book_snapshot_ts", "snapshot_age_ms", *(f"depth_{s}_top{n}" for s in ("bid", "ask") for n in (1, 5, 10)), "obi_top1", "obi_top5", "obi_top10", "mid_price", "spread_bps", "microprice", "microprice_gap_bps", "bid_wall_score", "ask_wall_score", "depth_depletion_score", "depth_recovery_score", "fake_bid_support_score", "fake_ask_pressure_score", "queue_consume_bid_score", "queue_consume_ask_score", "quality_flags"]
    return rows.select("symbol", "trade_date", "minute", "revision", *counts, *amounts, *made)


class CausalBook(StatefulProcessor):
    """Orders joined with the latest book at or before them, in order of event time.

    Orders and books wait in state until the watermark has passed them, so a book that comes in a later batch than
    an order, but lies before it, is still found. A timer at the earliest waiting row brings the key back without new rows.
    Of the books that were passed only the latest stays.
    """

    HELD = "us long, seq long, is_book boolean, price double, amount double, cancel boolean"
    OUT = "symbol string, ts timestamp, seq long, price double, amount double, cancel boolean, mid double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.HELD)
        self.latest = handle.getValueState("latest", "us long, seq long, mid double")

    def handleInputRows(self, key: tuple, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            us = part["ts"].to_numpy("datetime64[us]").astype("int64").tolist()
            self.waiting.appendList(list(zip(us, *(part[c].tolist() for c in ("seq", "is_book", "price", "amount", "cancel")), strict=True)))
        yield self.passed(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self.passed(key, timerValues.getCurrentWatermarkInMs())

    def passed(self, key: tuple, watermark_ms: int) -> pd.DataFrame:
        """Rows behind the watermark, joined; the others go back to wait for a timer."""
        held = pd.DataFrame(self.waiting.get(), columns=["us", "seq", "is_book", "price", "amount", "cancel"]).sort_values(["us", "is_book", "seq"], ascending=[True, False, True])
        go = held["us"] < watermark_ms * 1000
        now, rest = held[go], held[~go]
        mid = now["price"].where(now["is_book"].astype(bool)).ffill()
        if self.latest.exists():
            mid = mid.fillna(self.latest.get()[2])
        if len(seen := now[now["is_book"].astype(bool)]):
            self.latest.update((int(seen["us"].iloc[-1]), int(seen["seq"].iloc[-1]), float(seen["price"].iloc[-1])))
        replaced(self.waiting, [(int(a), int(b), bool(c), float(d), float(e), bool(f)) for a, b, c, d, e, f in rest.itertuples(index=False)])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if len(rest):
            self.handle.registerTimer(int(rest["us"].iloc[0]) // 1000 + 1)
        out = now.assign(symbol=key[0], mid=mid, ts=pd.to_datetime(now["us"], unit="us"))[~now["is_book"].astype(bool)]
        return out[["symbol", "ts", "seq", "price", "amount", "cancel", "mid"]].astype({"seq": "int64", "price": float, "amount": float, "cancel": bool, "mid": float})


def causal_book(events: DataFrame, late: str = "15 minutes") -> DataFrame:
    """Orders of a stream (symbol, ts, seq, is_book, price, amount, cancel) with `mid`, the price of the latest book at or before them."""
    out = events.withWatermark("ts", late).groupBy("symbol").transformWithStateInPandas(CausalBook(), T.StructType.fromDDL(CausalBook.OUT), "Append", "EventTime")
    return out.withColumn("mid", F.when(~F.isnan("mid"), F.col("mid")))  # an order before any book has none


def near_amounts(orders: DataFrame, width: float = 5e-4) -> DataFrame:
    """Added and cancelled amounts within `width` of the mid, by symbol and minute."""
    amount = lambda c: F.sum(F.when(c, F.col("amount")).otherwise(0.0))
    near = orders.where(F.abs(F.col("price") - F.col("mid")) <= width * F.col("mid"))
    return near.groupBy("symbol", F.date_trunc("minute", "ts").alias("minute")).agg(amount(F.col("cancel")).alias("near_cancel"), amount(~F.col("cancel")).alias("near_add"))


def judged(raw: DataFrame, line: str = "value", seconds: int = 1) -> DataFrame:
    """Wire rows, typed, with the time of capture as an eighth part and a reason to reject: unreadable, or later than capture."""
    out = clean_events(raw, line).withColumn("recv", F.timestamp_millis(F.try_element_at(F.split(F.col(line), ","), F.lit(8)).try_cast("long")))
    future = F.coalesce(F.col("ts") > F.col("recv") + F.make_interval(secs=F.lit(seconds)), F.lit(False))
    return out.withColumn("reason", F.when(F.col("parse_status") == "bad", "unreadable").when(future, "future"))


def clean_sinks(raw: DataFrame, path: str, line: str = "value") -> dict[str, DataFrame]:
    """A stream of wire rows as two tables: typed good rows, and rejected rows kept whole with their reason."""
    good = lambda b: b.where("reason is null").drop("reason", "parse_status")
    return run_to_sinks(judged(raw, line), path, {"good": good, "rejected": lambda b: b.where("reason is not null").select(line, "reason")})


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run_to_sinks(stream: DataFrame, path: str, sinks: dict[str, Callable[[DataFrame], DataFrame]], mode: str = "append", listen: str | None = None, partitions: int | None = None) -> dict[str, DataFrame]:
    """Runs a stream over what is there into several tables, and returns them.

    Each batch writes its part of every table to a folder with the batch's number, so a batch that runs twice replaces
    what it wrote, and the tables hold each batch exactly once. `listen` names the observation whose metrics
    (rows, counted) a listener may read while the stream runs. `partitions` is the number of parts that keyed state is
    dealt into, which a stream keeps for good once it has started; the session's number of shuffle partitions if none is given.
    """
    spark = stream.sparkSession
    if listen:
        counted = F.sum("counted") if "counted" in stream.columns else F.lit(0)
        stream = stream.observe(listen, F.count("*").alias("rows"), counted.alias("counted"))

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # the stateful step runs once for all tables
        for name, part in sinks.items():
            part(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch_id={number}")
        batch.unpersist()

    wanted = {PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}  # keyed maps and timers need it
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    own = {c: spark.conf.get(c, None) for c in wanted}
    try:
        for c, v in wanted.items():
            spark.conf.set(c, v)
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    finally:
        for c, v in own.items():
            spark.conf.set(c, v) if v else spark.conf.unset(c)
    return {name: spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}/batch_id=*") for name in sinks}


def read_state(spark, path: str, name: str) -> DataFrame:
    """A state variable of a stream that has stopped, as its checkpoint under `path` holds it."""
    return spark.read.format("statestore").option("path", f"{path}/checkpoint").option("stateVarName", name).load()


def forget_commit(spark, path: str) -> int:
    """Takes the last batch's commit back, as if the driver had died before it; the next run repeats that batch."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/checkpoint/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, str(last)), False)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f".{last}.crc"), False)
    return last
