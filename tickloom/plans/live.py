"""The live minute stream over events: books, trades and orders that arrive in several micro-batches, late and out of order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.plans.base import folder, rounded, staged, table
from tickloom.plans.series import rnd
from tickloom.streaming import live

QUERIES: dict = {}

#: Milliseconds: a wire day holds six days of events, pressed into the hour from 9:30.
START, SPAN, PRESS, OPEN, DAY = 1_704_067_200_000, 518_400_000, 144, 34_200_000, 86_400_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


def wire(spark: SparkSession, d: str) -> DataFrame:
    """events as rows of `live.EVENT`: views are books, clicks and signups trades, purchases orders, errors cancels and orders.

    Most rows arrive 200 ms after their time; some 100, 140 or 400 seconds or a day later, some before it.
    """
    e = table(spark, d, "events")
    k = F.col("event_id")
    off = F.unix_millis(F.col("ts").cast("timestamp")) - START
    at = START + F.floor(off / SPAN) * DAY + OPEN + F.floor(off % SPAN / PRESS)
    delay = F.when(k % 97 == 0, -5_000).when(k % 211 == 0, DAY + 600_000).when(k % 53 == 0, 400_000).when(k % 29 == 0, 140_000).when(k % 17 == 0, 100_000).otherwise(200)
    view, purchase, error = (F.col("event_type") == x for x in ("view", "purchase", "error"))
    trade = F.col("event_type").isin("click", "signup")
    gone = error & (k % 3 == 0)
    channel = F.when(view, "market").when(trade | gone, "trans").otherwise("order")
    kind = F.when(view, "").when(trade, "trade").when(gone | (purchase & (k % 2 == 0)), "cancel").otherwise("add")
    side = F.when(view, "").when(trade, F.when(F.col("event_type") == "click", "B").otherwise("S")).when(gone & (k % 31 == 0), "").otherwise(F.when(k % 4 < 2, "B").otherwise("S"))
    price = F.when(view | trade, 100_000 + k % 7 * 100).when(k % 43 == 0, 0).otherwise(100_000 + (k % 9 - 4) * 20)
    volume = (k % 50 + 1) * 100 * F.when(k % 13 == 0, 100).otherwise(1)
    levels = F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))
    bid = F.transform(levels, lambda j: F.when(k % 41 == 0, 0).otherwise(100_000 + k % 5 * 100 - j * 100))
    ask = F.transform(levels, lambda j: 100_000 + k % 5 * 100 + 100 * (1 + k % 3) + j * 100)
    size = lambda m: F.transform(levels, lambda j: ((k * m + j) % 20 + 1) * 100)
    book = lambda c: F.when(view, c).cast("array<long>")
    return e.select(F.floor(F.col("user_id") / 75).cast("string").alias("symbol"), k.alias("seq"), F.timestamp_millis(at).alias("ts"), F.timestamp_millis(at + delay).alias("recv"), channel.alias("channel"), kind.alias("kind"), side.alias("side"), price.alias("price"), volume.alias("volume"), book(bid).alias("bid_price"), book(ask).alias("ask_price"), book(size(3)).alias("bid_volume"), book(size(7)).alias("ask_volume"))


def in_batches(rows: DataFrame, path: str, first: int = 0, last: int = 99) -> DataFrame:
    """rows as a stream of micro-batches that end at 10:00 of a day of arrival."""
    n = F.floor((F.unix_millis("recv") - START + DAY - OPEN - 1_800_000) / DAY).cast("int")
    days = sorted(k for (k,) in rows.select(n).distinct().collect())  # a handful
    return staged(rows.sparkSession, (rows.where(n == k) for k in days if first <= k <= last), path)


def checked(stream: DataFrame) -> DataFrame:
    """Rows whose event time is at most a second past their arrival."""
    return stream.where(F.col("ts") <= F.col("recv") + F.expr("interval 1 second"))


def run_live(spark: SparkSession, d: str, path: str, retain: int = 16, rows: DataFrame | None = None, **more) -> dict[str, DataFrame]:
    stream = checked(in_batches(wire(spark, d) if rows is None else rows, f"{path}/in"))
    return sinks(stream, path, retain, **more)


def sinks(stream: DataFrame, path: str, retain: int, **more) -> dict[str, DataFrame]:
    parts = {"minutes": lambda b: b.where("minute is not null").drop("counter", "counted"), "counters": lambda b: b.where("counter is not null").select("symbol", "counter", "counted")}
    return live.run_to_sinks(live.live_minutes(stream, retain=retain, **more), path, parts, "update", partitions=stream.sparkSession.sparkContext.defaultParallelism)


def newest(minutes: DataFrame) -> DataFrame:
    """The newest revision of each minute, one of each in a batch."""
    rest = [c for c in minutes.columns if c not in ("symbol", "minute")]
    return minutes.groupBy("symbol", "minute").agg(F.max_by(F.struct(*rest), "batch_id").alias("x")).select("symbol", "minute", "x.*")


def _levels(price: str) -> str:
    return f"list_transform(range(0, 10), lambda j: {price})"


def wire_sql(name: str = "w") -> str:
    return f"""{name} AS MATERIALIZED (SELECT *, ts + to_milliseconds(CASE WHEN k % 97 = 0 THEN -5000 WHEN k % 211 = 0 THEN {DAY + 600_000} WHEN k % 53 = 0 THEN 400000 WHEN k % 29 = 0 THEN 140000 WHEN k % 17 = 0 THEN 100000 ELSE 200 END) AS recv FROM (
  SELECT (user_id // 75)::VARCHAR AS symbol, event_id AS k, epoch_ms({START} + (epoch_us(ts) // 1000 - {START}) // {SPAN} * {DAY} + {OPEN} + (epoch_us(ts) // 1000 - {START}) % {SPAN} // {PRESS}) AS ts,
    event_type = 'view' AS book, event_type IN ('click', 'signup') AS trade, event_type = 'error' AND event_id % 3 = 0 AS gone,
    event_type = 'error' AND event_id % 3 = 0 OR event_type = 'purchase' AND event_id % 2 = 0 AS cancel,
    CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'click' THEN 'B' WHEN event_type = 'signup' THEN 'S' WHEN event_type = 'error' AND event_id % 3 = 0 AND event_id % 31 = 0 THEN '' WHEN event_id % 4 < 2 THEN 'B' ELSE 'S' END AS side,
    CASE WHEN event_type IN ('view', 'click', 'signup') THEN 100000 + event_id % 7 * 100 WHEN event_id % 43 = 0 THEN 0 ELSE 100000 + (event_id % 9 - 4) * 20 END AS price,
    (event_id % 50 + 1) * 100 * CASE WHEN event_id % 13 = 0 THEN 100 ELSE 1 END AS volume,
    CASE WHEN event_id % 41 = 0 THEN 0 ELSE 100000 + event_id % 5 * 100 END AS bid, 100000 + event_id % 5 * 100 + 100 * (1 + event_id % 3) AS ask,
    {_levels('((event_id * 3 + j) % 20 + 1) * 100')} AS bv, {_levels('((event_id * 7 + j) % 20 + 1) * 100')} AS av FROM events))"""


def fates_sql(retain: int, source: str = "w") -> str:
    """CTEs: fate of each row that isn't from the future, by order of arrival, and `a`, the accepted ones."""
    return f"""g AS (SELECT * FROM {source} WHERE ts <= recv + INTERVAL 1 SECOND),
m AS (SELECT *, max(ts) OVER (PARTITION BY symbol ORDER BY recv, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g),
f AS MATERIALIZED (SELECT *, date_trunc('minute', ts) AS minute, CASE WHEN ts::DATE < before::DATE THEN 'previous_day_rejected' WHEN ts::DATE = before::DATE AND ts < before - INTERVAL 150 SECOND THEN 'beyond_lateness_rejected'
  WHEN date_trunc('minute', ts) < date_trunc('minute', greatest(before, ts)) - INTERVAL {retain - 1} MINUTE THEN 'retention_rejected' ELSE 'accepted_events' END AS fate FROM m),
a AS MATERIALIZED (SELECT * EXCLUDE (minute, before), ts::DATE AS day, minute, CASE WHEN ts::DATE = before::DATE THEN before END AS before, row_number() OVER (PARTITION BY symbol ORDER BY recv, k) AS i,
  coalesce(minute >= max(minute) OVER (PARTITION BY symbol ORDER BY recv, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS shown FROM f WHERE fate = 'accepted_events')"""


def quiet_sql(idle: int) -> str:
    """CTE `quiet`: symbols that the end of the stream finds idle, their last row `idle` seconds behind the newest arrival, and the day that their state holds.

    A symbol's timer is looked at between batches; before its last row a symbol has rows in every batch (`with_quiet` adds ones that haven't).
    """
    ms = "epoch_us(max(recv)) // 1000"
    return f"quiet AS (SELECT symbol, max(ts)::DATE AS day FROM g GROUP BY 1 HAVING {ms} + {idle * 1000} <= (SELECT {ms} FROM g))"


def books_sql(retain: int) -> str:
    """CTE `x`: accepted rows with the book that their minute held then (ob) and the causal one (cb), by order struct."""
    cut = f"date_trunc('minute', coalesce(e.before, e.ts)) - INTERVAL {retain} MINUTE"
    one = "{'ts': b.ts, 'recv': b.recv, 'k': b.k, 'bid': b.bid, 'ask': b.ask, 'bv': b.bv, 'av': b.av}"
    best = f"max({one}) FILTER (b.i <= e.i AND b.ts < e.minute + INTERVAL 1 MINUTE)", f"max({one}) FILTER (b.i < e.i AND b.ts <= e.ts)"
    return f"""b AS (SELECT * FROM a WHERE book), eb AS MATERIALIZED (SELECT e.symbol, e.i, {best[0]} AS own, {best[1]} AS cb FROM a e LEFT JOIN b ON b.symbol = e.symbol AND b.day = e.day AND b.ts >= {cut} AND b.i <= e.i GROUP BY e.symbol, e.i),
x AS MATERIALIZED (SELECT *, coalesce(cb0, CASE WHEN was.ts <= ts THEN was END) AS cb FROM (SELECT a.*, eb.cb AS cb0, max(own) OVER (PARTITION BY a.symbol, minute ORDER BY a.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was, max(own) OVER (PARTITION BY a.symbol, minute ORDER BY a.i) AS ob FROM a JOIN eb ON eb.symbol = a.symbol AND eb.i = a.i)),
y AS MATERIALIZED (SELECT *, NOT book AND NOT trade AND side <> '' AND price > 0 AS tested, CASE WHEN side = 'B' THEN cb.bid ELSE cb.ask END AS best FROM x)"""


#: Sums and ends of the rows of one minute.
_SUMS = {
    "n": "count(*)", "late": "count(*) FILTER (ts < before)", "trades": "count(*) FILTER (trade)", "adds": "count(*) FILTER (NOT book AND NOT trade AND NOT cancel)", "cancels": "count(*) FILTER (cancel AND NOT gone)", "trans_cancels": "count(*) FILTER (gone)",
    "volume": "coalesce(sum(volume) FILTER (trade), 0)", "amount": "coalesce(sum(price * volume) FILTER (trade), 0)", "bvol": "coalesce(sum(volume) FILTER (trade AND side = 'B'), 0)", "svol": "coalesce(sum(volume) FILTER (trade AND side = 'S'), 0)",
    "bamt": "coalesce(sum(price * volume) FILTER (trade AND side = 'B'), 0)", "samt": "coalesce(sum(price * volume) FILTER (trade AND side = 'S'), 0)", "lbuy": "coalesce(sum(price * volume) FILTER (trade AND side = 'B' AND price * volume >= 5000000000), 0)", "lsell": "coalesce(sum(price * volume) FILTER (trade AND side = 'S' AND price * volume >= 5000000000), 0)",
    **{f"{side}_{what}": f"coalesce(sum(price * volume) FILTER (tested AND best > 0 AND side = '{mark}' AND {'' if what == 'cancel' else 'NOT '}cancel AND price * 10000 {near}), 0)" for side, mark, near in (("bid", "B", ">= best * 9995"), ("ask", "S", "<= best * 10005")) for what in ("add", "cancel")},
    "open": "arg_min(price, (ts, recv, k)) FILTER ((book OR trade) AND price > 0)", "close": "arg_max(price, (ts, recv, k)) FILTER ((book OR trade) AND price > 0)", "high": "max(price) FILTER (book OR trade)", "low": "min(price) FILTER (book OR trade)",
    "delay": "arg_max(epoch_us(recv) - epoch_us(ts), i)", "ob": "max(ob)", "recv": "max(recv)",
    "flags": "list_distinct(list(CASE WHEN NOT book AND NOT trade AND side = '' THEN 'cancel_side_unverified' WHEN NOT book AND NOT trade AND price = 0 THEN CASE WHEN gone THEN 'unpriced_cancel' ELSE 'unpriced_order' END WHEN tested AND coalesce(best, 0) <= 0 THEN 'missing_causal_book' END) || list(CASE WHEN ts < before THEN 'out_of_order_received' END))",
}


def _q(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN ({a})::DOUBLE / ({b}) END"


def _metrics_sql(retain: int) -> str:
    sums = ", ".join(f"{v} AS {c}" for c, v in _SUMS.items())
    money = {"open_1m": "open", "high_1m": "high", "low_1m": "low", "close_1m": "close", "last_price": "close", "amount_1m": "amount", "active_buy_amount_1m": "bamt", "active_sell_amount_1m": "samt", "large_buy_amount_1m": "lbuy", "large_sell_amount_1m": "lsell", "near_bid_add_amount": "bid_add", "near_ask_add_amount": "ask_add", "near_bid_cancel_amount": "bid_cancel", "near_ask_cancel_amount": "ask_cancel"}
    counts = {"event_count": "n", "accepted_late_event_count": "late", "trade_count_1m": "trades", "order_add_count_1m": "adds", "order_cancel_count_1m": "cancels", "trans_cancel_count_1m": "trans_cancels", "volume_1m": "volume", "active_buy_volume_1m": "bvol", "active_sell_volume_1m": "svol"}
    depth = {f"{s}{n}": f"list_sum({v}[1:{n}])" for s, v in (("b", "ob.bv"), ("a", "ob.av")) for n in (1, 5, 10)}
    clip = lambda x: f"CASE WHEN ({x}) IS NOT NULL THEN greatest(least({x}, 1), 0) END"
    bid, ask, mid = "(ob.bid / 1e4)", "(ob.ask / 1e4)", "(CASE WHEN ob.bid > 0 AND ob.ask > 0 THEN (ob.bid / 1e4 + ob.ask / 1e4) / 2 END)"
    micro = f"(CASE WHEN {mid} IS NOT NULL THEN ({ask} * b1 + {bid} * a1) / (b1 + a1) END)"
    vwap = _q("amount / 1e4", "volume")
    moved = _q("b10 + a10 - was", "was")
    bcr, acr, br, sr = _q("bid_cancel", "bid_add"), _q("ask_cancel", "ask_add"), _q("bamt", "bamt + samt"), _q("samt", "bamt + samt")
    deplete = clip(f"-({moved})")
    made = {
        "vwap_1m": vwap, "active_buy_ratio": br, "active_sell_ratio": sr, "large_trade_imbalance": _q("lbuy - lsell", "lbuy + lsell"), "bid_cancel_add_ratio": bcr, "ask_cancel_add_ratio": acr, "price_impact_bps": _q("(close - open) * 10000", "open"), "data_delay_ms": "delay / 1e3",
        **{f"ret_{j}m": f"close::DOUBLE / c{j} - 1" for j in (1, 3, 5)},
        "vol_ratio_1m": "CASE WHEN list_avg(prior[-5:]) > 0 THEN (amount / 1e4) / list_avg(prior[-5:]) END", "trade_intensity_zscore": "CASE WHEN len(prior) >= 3 THEN CASE WHEN list_stddev_pop(prior[-10:]) > 1e-9 THEN (amount / 1e4 - list_avg(prior[-10:])) / list_stddev_pop(prior[-10:]) ELSE 0 END END",
        "vwap_gap_bps": f"(close / 1e4 - {vwap}) / {vwap} * 10000", "snapshot_age_ms": "(epoch_us(recv) - epoch_us(ob.ts)) / 1e3",
        **{f"obi_top{n}": _q(f"b{n} - a{n}", f"b{n} + a{n}") for n in (1, 5, 10)},
        "mid_price": mid, "spread_bps": f"({ask} - {bid}) * 10000 / {mid}", "microprice": micro, "microprice_gap_bps": f"({micro} - {mid}) / {mid} * 10000", "bid_wall_score": _q("list_max(ob.bv)", "b10"), "ask_wall_score": _q("list_max(ob.av)", "a10"),
        "depth_depletion_score": deplete, "depth_recovery_score": clip(moved), "fake_bid_support_score": clip(f"({bcr}) * b5 / (b10 + a10)"), "fake_ask_pressure_score": clip(f"({acr}) * a5 / (b10 + a10)"), "queue_consume_bid_score": clip(f"({deplete}) * ({sr})"), "queue_consume_ask_score": clip(f"({deplete}) * ({br})"),
    }
    whole = {f"depth_{s}_top{n}": f"({s[0]}{n})::BIGINT" for s in ("bid", "ask") for n in (1, 5, 10)}
    return f"""WITH {wire_sql()}, {fates_sql(retain)}, {books_sql(retain)},
l AS (SELECT symbol AS sym, day AS that_day, minute AS own, max(i) AS upto, count(*) AS revision, arg_max(greatest(coalesce(before, ts), ts), i) AS latest FROM a WHERE shown GROUP BY ALL),
s AS (SELECT y.symbol, l.own, l.revision, y.minute, {sums} FROM l JOIN y ON y.symbol = sym AND y.day = that_day AND y.i <= upto AND y.minute <= l.own AND y.minute >= date_trunc('minute', l.latest) - INTERVAL {retain - 1} MINUTE GROUP BY y.symbol, l.own, l.revision, y.minute),
p AS (SELECT symbol, own, {', '.join(f'max(close) FILTER (minute = own - INTERVAL {j} MINUTE) AS c{j}' for j in (1, 3, 5))}, coalesce(list(amount / 1e4 ORDER BY minute) FILTER (minute < own), []) AS prior, max(list_sum(ob.bv) + list_sum(ob.av)) FILTER (minute = own - INTERVAL 1 MINUTE) AS was FROM s GROUP BY ALL),
z AS (SELECT s.*, p.* EXCLUDE (symbol, own), {', '.join(f'{v} AS {c}' for c, v in depth.items())} FROM s JOIN p USING (symbol, own) WHERE s.minute = s.own)
SELECT symbol, minute::DATE AS trade_date, minute, revision, {', '.join(f'({v})::BIGINT AS {c}' for c, v in counts.items())}, {', '.join(f"{rnd(f'{v} / 1e4')} AS {c}" for c, v in money.items())}, {', '.join(f'{rnd(v)} AS {c}' for c, v in made.items())}, {', '.join(f'{v} AS {c}' for c, v in whole.items())}, ob.ts AS book_snapshot_ts,
  list_aggregate(list_sort(list_filter(flags || [CASE WHEN ob IS NULL THEN 'missing_book_snapshot' END, CASE WHEN cancels > 0 AND trans_cancels > 0 THEN 'combined_cancel_scope_unverified' END], lambda v: v IS NOT NULL)), 'string_agg', '|') AS quality_flags FROM z"""


@query(_metrics_sql(16))
def live_minute_metrics(spark, d):
    """All metrics of the newest revision of every minute, trades, orders and books, after six micro-batches."""
    log = newest(run_live(spark, d, folder(spark))["minutes"])
    out = live.live_metrics(log)
    out = rounded(out, *[c for c, kind in out.dtypes if kind == "double"])
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("minute", "book_snapshot_ts")}).withColumn("quality_flags", F.nullif("quality_flags", F.lit("")))


def _counters_sql(retain: int) -> str:
    end = f"date_trunc('minute', latest) - INTERVAL {retain - 1} MINUTE"
    return f"""WITH {wire_sql()}, {fates_sql(retain)}, {books_sql(retain)}, {quiet_sql(3600)}, ends AS (SELECT symbol, day, max(ts) AS latest, (symbol, day) IN (SELECT (symbol, day) FROM quiet) AS idle FROM a GROUP BY ALL), c AS (
SELECT fate AS counter, count(*) AS n FROM f GROUP BY 1
UNION ALL SELECT 'accepted_late_events', count(*) FROM a WHERE ts < before
UNION ALL SELECT 'older_minute_not_emitted', count(*) FROM a WHERE NOT shown
UNION ALL SELECT 'daily_resets', count(*) - count(DISTINCT symbol) FROM ends
UNION ALL SELECT 'missing_causal_book', count(*) FROM y WHERE tested AND coalesce(best, 0) <= 0
UNION ALL SELECT 'minute_buckets_evicted', count(*) FROM (SELECT DISTINCT symbol, day, minute FROM a) JOIN ends USING (symbol, day) WHERE idle OR minute < {end}
UNION ALL SELECT 'book_history_evicted', count(*) FROM (SELECT DISTINCT symbol, day, ts FROM a WHERE book) JOIN ends USING (symbol, day) WHERE idle OR ts < {end} - INTERVAL 1 MINUTE
UNION ALL SELECT 'idle_symbols', count(*) FROM quiet)
SELECT counter, n::BIGINT AS n FROM c WHERE n > 0"""


@query(_counters_sql(4))
def live_counters(spark, d):
    """Counters of the second sink, after the last batch ran twice."""
    path = folder(spark)
    run_live(spark, d, path, 4)
    live.forget_commit(spark, path)
    stream = checked(spark.readStream.schema(wire(spark, d).schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in"))
    return sinks(stream, path, 4)["counters"].groupBy("counter").agg(F.sum("counted").alias("n"))


def with_quiet(rows: DataFrame) -> DataFrame:
    """rows, and for each symbol another one that falls silent after the first day and sends that day's rows again on the fifth."""
    first = rows.where(F.unix_millis("ts") < START + DAY).withColumn("symbol", F.concat(F.lit("q"), "symbol"))
    again = first.withColumns({"recv": F.col("ts") + F.expr("interval 4 days"), "seq": F.col("seq") + 1_000_000_000})
    return rows.unionByName(first).unionByName(again)


_QUIET = f"w AS MATERIALIZED (SELECT * FROM w0 UNION ALL SELECT * REPLACE ('q' || symbol AS symbol) FROM w0 WHERE ts < epoch_ms({START + DAY}) UNION ALL SELECT * REPLACE ('q' || symbol AS symbol, ts + INTERVAL 4 DAY AS recv, k + 1000000000 AS k) FROM w0 WHERE ts < epoch_ms({START + DAY}))"
_GONE = "symbol LIKE 'q%' AND recv >= (SELECT min(recv) FROM w) + INTERVAL 2 DAY"


@query(f"""WITH {wire_sql('w0')}, {_QUIET}, {fates_sql(4)}, {quiet_sql(1200)}, ends AS (SELECT symbol, day, max(ts) AS latest, symbol LIKE 'q%' OR (symbol, day) IN (SELECT (symbol, day) FROM quiet) AS idle FROM a WHERE NOT ({_GONE}) GROUP BY ALL),
own AS (SELECT symbol, max(ts) AS latest FROM g WHERE symbol LIKE 'q%' AND NOT ({_GONE}) GROUP BY 1), c AS (
SELECT symbol, fate AS counter, count(*) AS n FROM f WHERE NOT ({_GONE}) GROUP BY ALL
UNION ALL SELECT symbol, CASE WHEN ts::DATE < latest::DATE THEN 'previous_day_rejected' WHEN ts < latest - INTERVAL 150 SECOND THEN 'beyond_lateness_rejected' ELSE 'retention_rejected' END, count(*) FROM g JOIN own USING (symbol) WHERE {_GONE} GROUP BY ALL
UNION ALL SELECT symbol, 'minute_buckets_evicted', count(*) FROM (SELECT DISTINCT symbol, day, minute FROM a WHERE NOT ({_GONE})) JOIN ends USING (symbol, day) WHERE idle OR minute < date_trunc('minute', latest) - INTERVAL 3 MINUTE GROUP BY 1
UNION ALL SELECT symbol, 'idle_symbols', 1 FROM (SELECT symbol FROM own UNION SELECT symbol FROM quiet))
SELECT symbol, counter, sum(n)::BIGINT AS n FROM c WHERE counter IN ('accepted_events', 'previous_day_rejected', 'beyond_lateness_rejected', 'retention_rejected', 'minute_buckets_evicted', 'idle_symbols') GROUP BY ALL""")
def state_retention(spark, d):
    """Minutes beyond retention go, silent symbols go when their timer fires, and rows that come for either later are counted."""
    names = ["accepted_events", "previous_day_rejected", "beyond_lateness_rejected", "retention_rejected", "minute_buckets_evicted", "idle_symbols"]
    log = run_live(spark, d, folder(spark), 4, with_quiet(wire(spark, d)), idle=1200, forget=30 * 86_400)["counters"]
    return log.where(F.col("counter").isin(names)).groupBy("symbol", "counter").agg(F.sum("counted").alias("n"))


_SHOWN = "l.symbol, l.minute, {part} AS part, count(*) AS events, coalesce(sum(volume) FILTER (trade), 0)::BIGINT AS volume"


@query(f"""WITH {wire_sql()}, {fates_sql(16)}, early AS (SELECT * FROM a WHERE recv < epoch_ms({START + DAY + OPEN + 1_800_000})), l AS (SELECT symbol, minute, max(i) AS i, count(*) AS revision FROM a WHERE shown GROUP BY ALL),
head AS (SELECT symbol, max(day) AS day, max(ts) AS latest FROM early GROUP BY 1)
SELECT symbol, minute, 'state' AS part, coalesce(revision, 0)::BIGINT AS revision, events, volume FROM (SELECT symbol, minute, count(*) AS events, coalesce(sum(volume) FILTER (trade), 0)::BIGINT AS volume, count(*) FILTER (shown) AS revision FROM early JOIN head USING (symbol, day) WHERE minute >= date_trunc('minute', latest) - INTERVAL 15 MINUTE GROUP BY ALL)
UNION ALL SELECT l.symbol, l.minute, 'table', revision, count(*), coalesce(sum(volume) FILTER (trade), 0)::BIGINT FROM l JOIN a ON a.symbol = l.symbol AND a.minute = l.minute AND a.i <= l.i GROUP BY ALL""")
def stream_checkpoint(spark, d):
    """What the state of a stream stopped after its second batch holds, and the table after it went on to the end."""
    path, rows = folder(spark), wire(spark, d)
    sinks(checked(in_batches(rows, f"{path}/in", last=1)), path, 16)
    state = live.read_state(spark, path, "minutes")
    shown = state.select("key.symbol", F.timestamp_micros(F.col("user_map_key.minute") * live.MINUTE_US).alias("minute"), F.lit("state").alias("part"), "user_map_value.revision", F.col("user_map_value.n").alias("events"), "user_map_value.volume")
    shown.write.parquet(f"{path}/snapshot")  # the state changes when the stream goes on
    out = newest(sinks(checked(in_batches(rows, f"{path}/in", first=2)), path, 16)["minutes"])
    table_ = out.select("symbol", "minute", F.lit("table").alias("part"), "revision", F.col("n").alias("events"), "volume")
    return spark.read.parquet(f"{path}/snapshot").unionByName(table_).withColumn("minute", F.col("minute").cast("timestamp_ntz"))


def _lines(spark: SparkSession, d: str, path: str) -> DataFrame:
    """events as wire text in three files: errors can't be read, and every third row is captured five seconds before its time."""
    e = table(spark, d, "events")
    k, ms = F.col("event_id"), F.unix_millis(F.col("ts").cast("timestamp"))
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    line = F.concat_ws(",", k, "user_id", "event_type", ms, F.when(F.col("event_type") == "error", F.concat(F.lit("x"), cents)).otherwise(cents), F.lit("100"), F.lit("0"), ms - F.when(k % 3 == 0, 5_000).otherwise(0))
    for part in range(3):
        e.where(F.floor(k / 7) % 3 == part).select(line.alias("value")).coalesce(1).write.mode("append").text(f"{path}/in")
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{path}/in")


def _twice(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The two tables after the last batch has run twice."""
    path = folder(spark)
    stream = _lines(spark, d, path)
    live.clean_sinks(stream, path)
    live.forget_commit(spark, path)
    return live.clean_sinks(stream, path)


_LINE = "event_id || ',' || user_id || ',' || event_type || ',' || epoch_us(ts) // 1000 || ',' || CASE WHEN event_type = 'error' THEN 'x' ELSE '' END || round(value * 100)::BIGINT || ',100,0,' || (epoch_us(ts) // 1000 - CASE WHEN event_id % 3 = 0 THEN 5000 ELSE 0 END)"
_REASON = "CASE WHEN event_type = 'error' OR round(value * 100) <= 0 THEN 'unreadable' WHEN event_id % 3 = 0 THEN 'future' END"


@query(f"SELECT event_type AS channel, user_id::VARCHAR AS symbol, count(*) AS n, sum(round(value * 100))::DOUBLE AS price, max(epoch_us(ts) // 1000) AS latest FROM events WHERE {_REASON} IS NULL GROUP BY 1, 2")
def stream_clean_rows(spark, d):
    """Typed rows of the good table, by channel and symbol."""
    good = _twice(spark, d)["good"]
    return good.groupBy("channel", "symbol").agg(F.count("*").alias("n"), F.sum("price").alias("price"), F.max(F.unix_millis("ts")).alias("latest"))


@query(f"SELECT {_LINE} AS value, {_REASON} AS reason FROM events WHERE {_REASON} IS NOT NULL")
def stream_rejected_rows(spark, d):
    """Every rejected row whole, with its reason: unreadable ones and those from the future."""
    return _twice(spark, d)["rejected"].select("value", "reason")


@query(f"""WITH {wire_sql()}, b AS (SELECT symbol, ts, last(price / 1e4 ORDER BY k) AS mid FROM w WHERE book GROUP BY ALL),
j AS (SELECT o.*, b.mid FROM (SELECT *, price / 1e4 AS px, price * volume / 1e4 AS amount FROM w WHERE NOT book AND NOT trade) o ASOF JOIN b ON b.symbol = o.symbol AND o.ts >= b.ts)
SELECT symbol, date_trunc('minute', ts) AS minute, {rnd('coalesce(sum(amount) FILTER (cancel), 0)', 4)} AS near_cancel, {rnd('coalesce(sum(amount) FILTER (NOT cancel), 0)', 4)} AS near_add FROM j WHERE abs(px - mid) <= 0.0005 * mid GROUP BY ALL""")
def causal_book_stream(spark, d):
    """Orders joined with the latest book in order of event time, while a fifth of all rows comes after its minute, many in a later batch."""
    rows = wire(spark, d).withColumn("recv", F.col("ts") + F.make_interval(secs=F.when(F.col("seq") % 5 == 0, 400).otherwise(0)))
    end = rows.agg(F.max("ts").alias("ts"), F.max("recv").alias("recv")).select(*(F.lit(None).cast(kind).alias(c) if c not in ("ts", "recv", "symbol", "channel") else F.lit("market" if c == "channel" else "").alias(c) if c in ("symbol", "channel") else (F.col(c) + F.expr("interval 2 days")).alias(c) for c, kind in rows.dtypes))
    path = folder(spark)
    stream = in_batches(rows.where("kind <> 'trade'").unionByName(end), f"{path}/in")
    px = F.col("price") / 1e4
    asked = stream.select("symbol", "ts", F.coalesce("seq", F.lit(0)).alias("seq"), (F.col("channel") == "market").alias("is_book"), F.coalesce(px, F.lit(0.0)).alias("price"), F.coalesce(px * F.col("volume"), F.lit(0.0)).alias("amount"), F.coalesce(F.col("kind") == "cancel", F.lit(False)).alias("cancel"))
    orders = live.run_to_sinks(live.causal_book(asked), path, {"orders": lambda b: b}, partitions=spark.sparkContext.defaultParallelism)["orders"]
    out = live.near_amounts(orders).withColumn("minute", F.col("minute").cast("timestamp_ntz"))
    return rounded(out, "near_cancel", "near_add", n=4)
