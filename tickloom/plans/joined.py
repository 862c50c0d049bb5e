"""As-of, interval and panel joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import joins
from tickloom.plans.base import BARS, MASTER, TICKS, bars, book_orders, book_quotes, master, r, rounded, table, ticks

QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


def _shipments(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n"))


def _prices(spark, d):
    """Order totals as facts of a symbol, several a day."""
    n = F.pmod("o_custkey", F.lit(100))
    return table(spark, d, "orders").select(n.alias("symbol"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("price"))


FACTS = "facts AS (SELECT o_custkey % 100 AS symbol, CAST(o_orderdate AS DATE) AS day, o_orderkey AS seq, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price FROM orders), ships AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1, 2), last AS (SELECT symbol, day, max(seq) AS seq, arg_max_null(price, seq) AS price FROM facts GROUP BY 1, 2), firsts AS (SELECT symbol, day, min(seq) AS seq, arg_min_null(price, seq) AS price FROM facts GROUP BY 1, 2)"


@query(f"WITH {FACTS} SELECT s.symbol, s.day, s.n, f.day AS at, f.price FROM ships s ASOF LEFT JOIN last f ON s.symbol = f.symbol AND s.day >= f.day")
def asof_backward(spark, d):
    return joins.asof_backward(_shipments(spark, d), _prices(spark, d), ["symbol"], "day", ["price"], "seq", segment=joins.months)


@query(f"WITH {FACTS} SELECT s.symbol, s.day, s.n, f.day AS at, f.price, f.seq FROM ships s ASOF LEFT JOIN last f ON s.symbol = f.symbol AND s.day >= f.day")
def asof_backward_columns(spark, d):
    x = _prices(spark, d).withColumn("order", F.col("seq"))
    return joins.asof_backward(_shipments(spark, d), x, ["symbol"], "day", ["price", "seq"], "order")


@query(f"WITH {FACTS} SELECT s.symbol, s.day, s.n, f.day AS at, f.price FROM ships s ASOF LEFT JOIN firsts f ON s.symbol = f.symbol AND s.day + 5 <= f.day")
def asof_forward(spark, d):
    return joins.asof_forward(_shipments(spark, d), _prices(spark, d), ["symbol"], "day", ["price"], "seq", horizon=F.lit(5), segment=joins.months)


@query(f"WITH {FACTS} SELECT s.symbol, s.day, s.n, CASE WHEN f.day + 10 >= s.day THEN f.day END AS at, CASE WHEN f.day + 10 >= s.day THEN f.price END AS price FROM ships s ASOF LEFT JOIN last f ON s.symbol = f.symbol AND s.day >= f.day")
def asof_max_age(spark, d):
    return joins.asof_backward(_shipments(spark, d), _prices(spark, d), ["symbol"], "day", ["price"], "seq", max_age=F.lit(10), segment=joins.months)


@query(f"WITH {FACTS} SELECT s.symbol, s.day, s.n, f.day AS pit_at, f.price AS pit_price FROM ships s ASOF LEFT JOIN last f ON s.symbol = f.symbol AND s.day >= f.day")
def pit_announcement_join(spark, d):
    return joins.point_in_time(_shipments(spark, d), _prices(spark, d).withColumnRenamed("day", "announced"), ["symbol"], "day", "announced", ["price"], "seq")


@query(f"WITH {FACTS}, sessions AS (SELECT DISTINCT day FROM ships WHERE symbol % 10 = 0), avail AS (SELECT f.symbol, f.seq, f.price, s.day FROM facts f ASOF JOIN sessions s ON f.day + 1 <= s.day), l AS (SELECT symbol, day, max(seq) AS seq, arg_max_null(price, seq) AS price FROM avail GROUP BY 1, 2) SELECT s.symbol, s.day, s.n, f.day AS pit_at, f.price AS pit_price FROM ships s ASOF LEFT JOIN l f ON s.symbol = f.symbol AND s.day >= f.day")
def pit_next_session_join(spark, d):
    ships = _shipments(spark, d)
    cal = ships.where("symbol % 10 = 0").select(F.col("day").alias("trade_date")).distinct()
    avail = joins.next_session(_prices(spark, d), cal, "day").where("next_session is not null").drop("day").withColumnRenamed("next_session", "day")
    return joins.point_in_time(ships, avail, ["symbol"], "day", "day", ["price"], "seq")


@query(f"WITH {FACTS} SELECT s.symbol, s.day, s.n, CASE WHEN f.day + 460 >= s.day THEN f.day END AS pit_at, CASE WHEN f.day + 460 >= s.day THEN f.price END AS pit_price FROM ships s ASOF LEFT JOIN last f ON s.symbol = f.symbol AND s.day >= f.day")
def pit_event_join(spark, d):
    facts = _prices(spark, d)
    return joins.point_in_time_events(_shipments(spark, d), facts, "symbol", "day", "day", ["price"], "seq")


@query("WITH m AS (SELECT DISTINCT o_orderpriority AS idx, CAST(date_trunc('month', o_orderdate) AS DATE) AS day, o_custkey AS symbol FROM orders), d AS (SELECT DISTINCT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS day FROM lineitem), s AS (SELECT DISTINCT idx, day FROM m), w AS (SELECT d.day, i.idx FROM d CROSS JOIN (SELECT DISTINCT idx FROM m) i), f AS (SELECT w.day, w.idx, s.day AS snap FROM w ASOF JOIN s ON w.idx = s.idx AND w.day >= s.day) SELECT f.day, f.idx, m.symbol FROM f JOIN m ON m.idx = f.idx AND m.day = f.snap")
def pit_index_membership(spark, d):
    m = table(spark, d, "orders").select(F.col("o_orderpriority").alias("idx"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("day"), F.col("o_custkey").alias("symbol")).distinct()
    dates = table(spark, d, "lineitem").select(F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("day")).distinct()
    return joins.latest_snapshot_members(dates, m, "idx", "day", "symbol")


@query(f"WITH {FACTS}, i AS (SELECT o_custkey % 100 AS symbol, CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) + 60 END AS b, o_orderkey AS seq, o_orderpriority AS v, CAST(o_orderkey % 3 AS INTEGER) AS level FROM orders), j AS (SELECT s.symbol, s.day, first(v ORDER BY CASE WHEN level = 1 THEN 1 ELSE 0 END DESC, a DESC, seq DESC) AS v FROM ships s JOIN i ON s.symbol = i.symbol AND s.day >= a AND (b IS NULL OR s.day < b) GROUP BY 1, 2) SELECT s.symbol, s.day, s.n, v FROM ships s LEFT JOIN j USING (symbol, day)")
def pit_interval_membership(spark, d):
    o = table(spark, d, "orders").select(F.pmod("o_custkey", F.lit(100)).alias("symbol"), F.to_date("o_orderdate").alias("a"), F.when(F.col("o_orderkey") % 4 != 0, F.date_add(F.to_date("o_orderdate"), 60)).alias("b"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("v"), (F.col("o_orderkey") % 3).cast("int").alias("level"))
    return joins.interval_membership(_shipments(spark, d), o, "symbol", "day", "a", "b", "v", "level", "seq")


@query(f"WITH {BARS}, cal AS (SELECT DISTINCT trade_date FROM bars), stop AS (SELECT DISTINCT o_custkey % 100 AS symbol, CAST(o_orderdate AS DATE) AS trade_date, true AS suspended FROM orders), g AS (SELECT c.trade_date, u.symbol FROM cal c CROSS JOIN (SELECT DISTINCT symbol FROM bars) u), f AS (SELECT g.symbol, g.trade_date, b.trade_date AS seen, b.open, b.high, b.low, b.close, b.volume FROM g ASOF LEFT JOIN bars b ON g.symbol = b.symbol AND g.trade_date >= b.trade_date) SELECT symbol, trade_date, ROUND(CASE WHEN seen = trade_date THEN open ELSE close END, 8) AS open, ROUND(CASE WHEN seen = trade_date THEN high ELSE close END, 8) AS high, ROUND(CASE WHEN seen = trade_date THEN low ELSE close END, 8) AS low, ROUND(close, 8) AS close, CASE WHEN seen = trade_date THEN volume ELSE 0.0 END AS volume, seen <> trade_date AS carried FROM f LEFT JOIN stop USING (symbol, trade_date) WHERE seen = trade_date OR (seen IS NOT NULL AND suspended)")
def dense_asof_panel(spark, d):
    b = bars(spark, d)
    stop = table(spark, d, "orders").select(F.pmod("o_custkey", F.lit(100)).alias("symbol"), F.to_date("o_orderdate").alias("trade_date")).distinct()
    return rounded(joins.dense_panel(b, b, b, stop, []), "open", "high", "low", "close", n=8)


@query(f"WITH {BARS}, {MASTER} SELECT b.symbol, b.trade_date, ROUND(close, 8) AS close, industry, e.n AS orders FROM bars b LEFT JOIN master m USING (symbol) LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS trade_date, o_custkey % 100 AS symbol, count(*) AS n FROM orders GROUP BY 1, 2) e USING (symbol, trade_date)")
def status_panel(spark, d):
    b = bars(spark, d).select("symbol", "trade_date", "close")
    m = b.select("symbol", "trade_date").join(master(spark, d).select("symbol", "industry"), "symbol")
    o = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("trade_date"), F.pmod("o_custkey", F.lit(100)).alias("symbol")).agg(F.count("*").alias("orders"))
    return rounded(joins.status_panel(b, [m, o], ["symbol", "trade_date"]), "close", n=8)


@query(f"WITH {BARS}, w AS (SELECT p_brand AS basket, p_partkey % 100 AS symbol, sum(p_retailprice) AS weight FROM part GROUP BY 1, 2) SELECT basket, trade_date, count(*) AS n, ROUND(sum(weight), 6) AS weight FROM bars JOIN w USING (symbol) GROUP BY 1, 2")
def basket_join(spark, d):
    w = table(spark, d, "part").groupBy(F.col("p_brand").alias("basket"), (F.col("p_partkey") % 100).alias("symbol")).agg(F.sum("p_retailprice").alias("weight"))
    return joins.basket_join(bars(spark, d), w, "symbol", "basket").groupBy("basket", "trade_date").agg(F.count("*").alias("n"), r(F.sum("weight")).alias("weight"))


@query(f"WITH {BARS} SELECT b.symbol, b.trade_date, volume, i.n FROM bars b LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS trade_date, o_custkey % 100 AS symbol, count(*) AS n FROM orders GROUP BY 1, 2) i USING (symbol, trade_date) WHERE b.symbol IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)")
def self_l2_identity(spark, d):
    i = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("trade_date"), F.pmod("o_custkey", F.lit(100)).alias("symbol")).agg(F.count("*").alias("n"))
    s = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("symbol"))
    return joins.self_identity(bars(spark, d).select("symbol", "trade_date", "volume"), s, i, "trade_date", "symbol")


@query(f"WITH {TICKS} SELECT symbol, trade_date, t.seq, q.time AS q_at, ROUND(q.price, 6) AS q_price FROM ticks t ASOF LEFT JOIN (SELECT symbol, trade_date, time, last(price ORDER BY seq) AS price FROM ticks WHERE side = 1 GROUP BY 1, 2, 3) q ON t.symbol = q.symbol AND t.trade_date = q.trade_date AND t.time >= q.time WHERE side = 0".replace("SELECT symbol, trade_date, t.seq", "SELECT t.symbol, t.trade_date, t.seq"))
def trade_quote_join(spark, d):
    t = ticks(spark, d)
    out = joins.asof_backward(t.where("side = 0").select("symbol", "trade_date", "seq", "time"), t.where("side = 1"), ["symbol", "trade_date"], "time", ["price"], "seq", "q_")
    return out.select("symbol", "trade_date", "seq", "q_at", r("q_price").alias("q_price"))


@query(f"WITH {TICKS}, o AS (SELECT symbol, trade_date, time, seq, price - 0.01 AS price, CASE WHEN event_type = 'error' THEN -1 ELSE 0 END AS type, CASE WHEN event_type = 'error' THEN (CASE WHEN seq % 2 = 0 THEN 0 ELSE 1 END) ELSE side END AS side FROM ticks), n AS (SELECT symbol, trade_date, side, time, first(price ORDER BY seq) AS price FROM o WHERE type = 0 GROUP BY ALL) SELECT c.symbol, c.trade_date, c.seq, coalesce(n.time - c.time <= 1000 AND abs(n.price - c.price) <= 0.02, false) AS replace_like FROM (SELECT * FROM o WHERE type < 0) c ASOF LEFT JOIN n ON c.symbol = n.symbol AND c.trade_date = n.trade_date AND c.side = n.side AND c.time <= n.time")
def replace_like_match(spark, d):
    buy = F.col("type").between(0, 3) | (F.col("type") == -1)
    o = book_orders(spark, d).withColumn("side", F.when(buy, 0).otherwise(1))
    pick = lambda c: o.where(c).select("symbol", "trade_date", "side", "seq", "time", "price")
    return joins.replace_like(pick("type < 0"), pick("type >= 0"), ["symbol", "trade_date", "side"]).select("symbol", "trade_date", "seq", "replace_like")


@query(f"WITH {TICKS} SELECT symbol, trade_date, time // 60000 AS minute, side, sum(CASE WHEN event_type <> 'error' THEN volume ELSE 0 END) AS traded, sum(CASE WHEN event_type = 'error' THEN volume ELSE 0 END) AS cancelled FROM ticks GROUP BY 1, 2, 3, 4")
def outer_minute_side_join(spark, d):
    t = ticks(spark, d).withColumn("minute", F.floor(F.col("time") / 60000))
    return joins.minute_side_outer(t.where("event_type <> 'error'"), t.where("event_type = 'error'"), ["symbol", "trade_date"])


@query(f"WITH {BARS}, m AS (SELECT trade_date, avg(close) FILTER (symbol % 2 = 0) AS a, avg(close) FILTER (symbol % 2 = 1) AS b FROM bars GROUP BY 1) SELECT trade_date, ROUND(a / b - 1, 6) + 0.0 AS premium FROM m WHERE a IS NOT NULL AND b IS NOT NULL")
def pair_alignment(spark, d):
    b = bars(spark, d).groupBy("trade_date", (F.col("symbol") % 2).alias("k")).agg(F.avg("close").alias("close"))
    return joins.pair_alignment(b.where("k = 0"), b.where("k = 1"), "trade_date").select("trade_date", r("premium").alias("premium"))


@query("WITH h AS (SELECT *, high >= greatest(open, close) AND low <= least(open, close) AND low > 0 AS inside FROM (SELECT date_trunc('hour', ts) AS ts, count(*) AS n, max(value) AS high, min(value) AS low, first(value ORDER BY ts, event_id) AS open, last(value ORDER BY ts, event_id) AS close FROM events WHERE event_type <> 'view' GROUP BY 1)), lim AS (SELECT min(ts) AS a, max(ts) AS b FROM h) SELECT e.event_id, CASE WHEN date_trunc('hour', e.ts) - INTERVAL 1 HOUR < a OR date_trunc('hour', e.ts) - INTERVAL 1 HOUR > b THEN 'OUTSIDE_BATCH' WHEN h.ts IS NULL THEN 'MISSING_HOUR' WHEN n < 12 THEN 'INCOMPLETE_HOUR' WHEN NOT coalesce(inside, false) THEN 'INVALID_OHLC' ELSE 'COMPLETE' END AS spot_status, ROUND(CASE WHEN inside AND n >= 12 THEN h.close END, 6) AS spot_close FROM events e CROSS JOIN lim LEFT JOIN h ON h.ts = date_trunc('hour', e.ts) - INTERVAL 1 HOUR WHERE e.event_type = 'view'")
def asof_exact_previous_hour(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    o = F.struct("ts", "event_id")
    h = e.where("event_type <> 'view'").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg((F.count("*") * 5).alias("n"), F.max("value").alias("high"), F.min("value").alias("low"), F.min_by("value", o).alias("open"), F.max_by("value", o).alias("close")).withColumnRenamed("hour", "ts")
    out = joins.exact_previous_hour(e.where("event_type = 'view'"), {"spot": h})
    return out.select("event_id", "spot_status", r("spot_close").alias("spot_close"))


@query(f"WITH {TICKS}, o AS (SELECT symbol, trade_date, time, seq, CASE WHEN event_type = 'error' THEN (CASE WHEN seq % 2 = 0 THEN 0 ELSE 1 END) ELSE side END AS side, price - 0.01 AS price FROM ticks), q AS (SELECT symbol, trade_date, time, last(price ORDER BY seq) AS price FROM ticks GROUP BY 1, 2, 3) SELECT o.symbol, o.trade_date, o.seq, abs(o.price - (q.price + CASE WHEN side = 0 THEN -0.01 ELSE 0.01 END)) <= 0.01 + 1e-9 AS near_touch FROM o ASOF LEFT JOIN q ON o.symbol = q.symbol AND o.trade_date = q.trade_date AND o.time >= q.time")
def near_touch_flag(spark, d):
    from tickloom.operators.l2 import near_touch

    return near_touch(book_orders(spark, d), book_quotes(spark, d)).select("symbol", "trade_date", "seq", "near_touch")
