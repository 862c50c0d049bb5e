"""Minute bars from an event stream, with revisions, late rows and counters; and their batch twins.

Stateless steps are plain DataFrame code and run on batch and stream alike. The exact per-symbol rules (lateness by the
symbol's own latest event, revisions, retention) need state: `revised_minutes` keeps it with
applyInPandasWithState, keyed by symbol.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import ratio


def clean_events(raw: DataFrame, line: str = "value") -> DataFrame:
    """Wire rows `capture,symbol,channel,ts_ms,price,volume,side` as typed events with a parse status.

    Rows that can't be read keep their text and have status `bad`.
    """
    part = F.split(F.col(line), ",")
    get = lambda k: F.try_element_at(part, F.lit(k + 1))
    out = raw.select("*", get(0).alias("capture_id"), F.upper(F.trim(get(1))).alias("symbol"), get(2).alias("channel"), F.timestamp_millis(get(3).try_cast("long")).alias("ts"), get(4).try_cast("double").alias("price"), get(5).try_cast("double").alias("volume"), get(6).try_cast("int").alias("side"))
    good = F.col("ts").isNotNull() & (F.col("price") > 0) & (F.col("volume") >= 0) & (F.col("symbol") != "")
    return out.withColumn("parse_status", F.when(F.coalesce(good, F.lit(False)), "ok").otherwise("bad"))


def not_future(events: DataFrame, available: str, at: str = "ts", seconds: int = 1) -> DataFrame:
    """Rows whose event time is at most `seconds` past the time they were available."""
    return events.where(F.col(at) <= F.col(available) + F.make_interval(secs=F.lit(seconds)))


def deduplicated(events: DataFrame, key: str = "capture_id", at: str = "ts", late: str = "15 minutes") -> DataFrame:
    """One row for each capture id, with state bounded by the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def minute_bars(events: DataFrame, key: str = "symbol", at: str = "ts", price: str = "price", volume: str = "volume", side: str = "side", order: str = "capture_id", large: float = 1e5) -> DataFrame:
    """One-minute bars with counts, active buys and sells and large trades; ties of time go by `order`."""
    o = F.struct(at, order)
    amount = F.col(price) * F.col(volume)
    return events.groupBy(F.window(at, "1 minute").alias("w"), key).agg(F.min_by(price, o).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, o).alias("close"), F.sum(volume).alias("volume"), F.sum(amount).alias("amount"), F.count("*").alias("n"), F.sum(F.when(F.col(side) == 0, amount).otherwise(0.0)).alias("buy_amount"), F.sum(F.when(F.col(side) == 1, amount).otherwise(0.0)).alias("sell_amount"), F.sum(F.when(amount >= large, amount).otherwise(0.0)).alias("large_amount")).select(key, F.col("w.start").alias("minute"), "open", "high", "low", "close", "volume", "amount", "n", "buy_amount", "sell_amount", "large_amount")


def minute_metrics(bars: DataFrame, key: str = "symbol", at: str = "minute") -> DataFrame:
    """Returns over 1, 3 and 5 minutes, VWAP gap, amount against ten prior minutes, volume against five."""
    w = Window.partitionBy(key).orderBy(F.col(at).cast("timestamp").cast("long"))
    before = lambda n: w.rangeBetween(-60 * n, -60)
    at_minute = lambda c, n: F.max(c).over(w.rangeBetween(-60 * n, -60 * n))
    z = ratio(F.col("amount") - F.avg("amount").over(before(10)), F.stddev_samp("amount").over(before(10)))
    return bars.select("*", *((ratio(F.col("close"), at_minute("close", n)) - 1).alias(f"ret_{n}m") for n in (1, 3, 5)), (ratio(F.col("close"), ratio(F.col("amount"), F.col("volume"))) - 1).alias("vwap_gap"), z.alias("amount_z"), ratio(F.col("volume"), F.avg("volume").over(before(5))).alias("volume_ratio"))


#: The symbols of a bucket with their newest time and day, and the minutes of that day that they keep with the place of their symbol, as parallel arrays.
STATE = "symbol array<string>, last_us array<long>, day array<int>, owner array<int>, minute array<long>, n array<long>, volume array<double>, amount array<double>, close_us array<long>, close array<double>"
REVISED = "symbol string, minute timestamp, revision int, n long, volume double, amount double, close double, counter string"
MINUTE_US, DAY_US = 60_000_000, 86_400_000_000
NAT = np.iinfo("int64").min  # as a datetime64: none


def revised_minutes(events: DataFrame, late_minutes: int = 15, retain: int = 600, buckets: int = 1024) -> DataFrame:
    """Each accepted row emits its minute again with the next revision; rejected rows emit a counter's name.

    Rules by symbol: rows older than its latest event less `late_minutes` are beyond_lateness; of an earlier day,
    previous_day; a new day clears the state; a late row of a minute before the newest is counted but its minute isn't
    emitted; minutes before the last `retain` ones are evicted at the end of a batch. Rows of a batch count in order of
    time. events: symbol, capture_id, ts, price, volume. State is kept by `buckets` of symbols, a number that a
    stream keeps for good, and a bucket's batch is worked on in one pass over plain values: with some ten rows of a symbol
    in a batch, a group, a state or a frame for each would cost more than its rows.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        names, *saved = map(list, state.get) if state.exists else [[] for _ in range(9)]
        heads = {name: (last, day, {}) for name, last, day in zip(names, *saved[:2], strict=True)}
        for owner, m, *rest in zip(*saved[2:], strict=True):
            heads[names[owner]][2][m] = rest
        rows = {}
        for part in batches:
            us = part["ts"].to_numpy("datetime64[us]").astype("int64").tolist()
            for name, *row in zip(part["symbol"].tolist(), us, part["capture_id"].tolist(), part["price"].tolist(), part["volume"].tolist(), strict=True):
                rows.setdefault(name, []).append(row)
        shown = []
        for name, own in rows.items():
            own.sort(key=lambda x: (x[0], x[1] is None or x[1] != x[1], x[1]))
            heads[name] = revise(name, own, *heads.get(name, (0, 0, {})), late_minutes * MINUTE_US, retain, shown)
        symbol, minute, n, volume, amount, close, counter = zip(*shown, strict=True)
        yield pd.DataFrame({"symbol": symbol, "minute": np.array(minute, "datetime64[us]"), "revision": pd.array(n, "Int32"), "n": pd.array(n, "Int64"), "volume": np.array(volume, float), "amount": np.array(amount, float), "close": np.array(close, float), "counter": counter})
        kept = [(k, m, *x) for k, (_, _, held) in enumerate(heads.values()) for m, x in held.items()]
        lasts, days = [h[0] for h in heads.values()], [h[1] for h in heads.values()]
        state.update((list(heads), lasts, days, *(list(c) for c in (zip(*kept, strict=True) if kept else [()] * 7))))

    dealt = events.withColumn("_bucket", F.pmod(F.xxhash64("symbol"), F.lit(buckets)))
    return dealt.groupBy("_bucket").applyInPandasWithState(step, REVISED, STATE, "append", "NoTimeout")


def revise(name: str, rows: list, last: int, day: int, held: dict, late: int, retain: int, shown: list) -> tuple[int, int, dict]:
    """Works one symbol's rows (time, id, price, volume; in order) into its minutes, adds what each row emits to `shown`, and returns the symbol's newest time, day and minutes."""
    top, made, newest, latest = max(held, default=-1), {}, day, last
    for t, _, price, volume in rows:
        own, m = t // DAY_US, t // MINUTE_US
        if own < day or (own == day and t < last - late):
            shown.append((name, NAT, None, None, None, None, "previous_day" if own < day else "beyond_lateness"))
            continue
        was = held.get(m, (0, 0.0, 0.0, -1, math.nan))
        x = made.setdefault(m, [0, 0.0, 0.0, was[3], was[4]])  # what this batch adds, and the last price
        x[0] += 1
        turnover = price * volume
        if volume == volume:
            x[1] += volume
        if turnover == turnover:
            x[2] += turnover
        if t >= x[3]:
            x[3], x[4] = t, price if price == price else x[4]
        if own == day and m < top:
            shown.append((name, NAT, None, None, None, None, "older_minute_not_emitted"))
        else:
            shown.append((name, m * MINUTE_US, was[0] + x[0], was[1] + x[1] if volume == volume else None, was[2] + x[2] if turnover == turnover else None, x[4], "accepted"))
        newest, latest = own, t
    kept = dict(held) if newest == day else {}
    for m, (count, volume, amount, at, close) in made.items():
        if m * MINUTE_US // DAY_US == newest:
            was = held.get(m, (0, 0.0, 0.0))
            kept[m] = (was[0] + count, was[1] + volume, was[2] + amount, at, close)
    return (max(last, latest) if newest == day else latest), newest, {m: kept[m] for m in sorted(kept)[-retain:]}


def newest_revision(log: DataFrame, key: str = "symbol", at: str = "minute") -> DataFrame:
    """The last revision of each minute in a log of updates."""
    w = Window.partitionBy(key, at).orderBy(F.desc("revision"))
    return log.where(F.col(at).isNotNull()).withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def run_to_table(stream: DataFrame, path: str, mode: str = "append", upsert: list[str] | None = None) -> DataFrame:
    """Runs a stream over what is there and returns what it wrote under `path`; its checkpoint lies there too.

    An update stream writes each batch's rows with the batch's number, and the last of each key is the table.
    """
    spark: SparkSession = stream.sparkSession
    to = f"{path}/rows"

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{to}/batch_id={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    rows = spark.read.schema(f"{stream.schema.toDDL()}, batch int").parquet(f"{to}/batch_id=*")
    if not upsert:
        return rows.drop("batch")
    w = Window.partitionBy(*upsert).orderBy(F.desc("batch"))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k", "batch")


def touched_dates(batch: DataFrame, at: str) -> DataFrame:
    """Dates of a batch, whose partitions of a materialized view must be computed again."""
    return batch.select(F.to_date(at).alias("trade_date")).distinct()


def refreshed_view(stream: DataFrame, path: str, at: str, recompute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A view by date that each batch refreshes: rows of the dates it touched are computed again from the whole base.

    `recompute` gets base rows with their trade_date and returns the view's rows, trade_date among them. Base files lie by
    batch and date, so a batch that runs twice replaces its own rows, and dates that it didn't touch aren't read.
    """
    spark: SparkSession = stream.sparkSession

    def refresh(batch: DataFrame, number: int) -> None:
        own = f"{path}/base/batch_id={number}"
        batch.withColumn("trade_date", F.to_date(at)).write.mode("overwrite").partitionBy("trade_date").parquet(own)
        schema = f"{stream.schema.toDDL()}, trade_date date"
        touched = spark.read.schema(schema).parquet(own).select("trade_date").distinct()
        base = spark.read.schema(f"{schema}, batch_id int").parquet(f"{path}/base").drop("batch_id")
        view = recompute(base.join(touched, "trade_date", "left_semi"))
        view.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trade_date").parquet(f"{path}/view")

    stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(refresh).start().awaitTermination()
    return spark.read.parquet(f"{path}/view")


def near_book(events: DataFrame, book: DataFrame, width: float = 5e-4) -> DataFrame:
    """Adds and cancels within `width` of the mid of the latest earlier snapshot of their symbol, by minute."""
    from tickloom.operators.joins import asof_backward

    e = asof_backward(events, book, ["symbol"], "ts", ["mid"], "seq", "q_")
    near: Column = F.abs(F.col("price") - F.col("q_mid")) <= width * F.col("q_mid")
    return e.where(near).groupBy("symbol", F.date_trunc("minute", "ts").alias("minute")).agg(F.sum(F.when(F.col("cancel"), F.col("amount")).otherwise(0.0)).alias("near_cancel"), F.sum(F.when(F.col("cancel"), 0.0).otherwise(F.col("amount"))).alias("near_add"))
