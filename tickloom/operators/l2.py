"""Order-book and trade features by symbol and day.

Deals: symbol, trade_date, seq, time (ms of the day), price, volume, side (0 buy, 1 sell; -1 and -11 are cancels, no
trades), buy_id, sell_id. Orders: time, price, volume, type (0-3 buy, 10-13 sell, -1 and -11 their cancels), id,
near_touch. Quotes: time, price, total_bid_volume, total_ask_volume, and bid_price, ask_price, bid_volume, ask_volume as
arrays by level. Missing values are null. Rows are in order of time, then seq.

Every group of features shuffles on (symbol, trade_date). What can't be computed is 0.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import clip, correlation, plain_id, ratio
from tickloom.operators.joins import asof_backward, asof_forward, replace_like

KEY = ["symbol", "trade_date"]
TICK = 0.01
MINUTE, HOUR = 60_000, 3_600_000
#: The sessions of a day, in milliseconds.
OPEN, TEN, MORNING_END, AFTERNOON, CLOSING, CONTINUOUS_END, CLOSE = (h * HOUR + m * MINUTE for h, m in ((9, 30), (10, 0), (11, 30), (13, 0), (14, 30), (14, 57), (15, 0)))
#: Trades of this amount or volume are large; those from MIDDLE to LARGE middling.
LARGE, LARGE_VOLUME, MIDDLE = 1_000_000, 100_000, 200_000


def _or_0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _sum(c: Column, where: Column | None = None) -> Column:
    return _or_0(F.sum(c if where is None else F.when(where, c)))


def _n(c: Column) -> Column:
    return F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).cast("long")


def _mean(c: Column) -> Column:
    return _or_0(F.avg(c))


def _share(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is no positive number."""
    return _or_0(F.when(b > 0, a / b))


def _order() -> Column:
    return F.struct("time", "seq")


def _in_time(*partition: str) -> Window:
    return Window.partitionBy(*(partition or KEY)).orderBy("time", "seq")


def _direction() -> Column:
    return F.when(F.col("side") == 0, 1.0).otherwise(-1.0)


def _identity(c: str) -> Column:
    """An order's id as text, null if nothing is left of it."""
    return F.nullif(plain_id(F.col(c).cast("string")), F.lit(""))


def _add(c: str = "type") -> Column:
    return F.col(c).between(0, 3) | F.col(c).between(10, 13)


def _cancel(c: str = "type") -> Column:
    return F.col(c).isin(-1, -11)


def _buy(c: str = "type") -> Column:
    return F.col(c).between(0, 3) | (F.col(c) == -1)


def executed(deals: DataFrame) -> DataFrame:
    """Trades without cancels, with `amount` and `sign`: 1 for buys and -1 for sells."""
    return deals.where(F.col("side").isin(0, 1)).withColumn("amount", F.col("price") * F.col("volume")).withColumn("sign", _direction())


def book(quotes: DataFrame) -> DataFrame:
    """One row per quote: best prices and volumes, sums of levels, validity, mid and both depths; staged quotes have them."""
    if "depth5" in quotes.columns:
        return quotes
    bp, ap, bv, av = (F.col(c) for c in ("bid_price", "ask_price", "bid_volume", "ask_volume"))
    top = lambda a, n: F.aggregate(F.slice(a, 1, n), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    q = quotes.select(*KEY, "time", "seq", *(c for c in ("_levels",) if c in quotes.columns), F.col("price").alias("last"), "total_bid_volume", "total_ask_volume", bp[0].alias("bid"), ap[0].alias("ask"), bv[0].alias("bid1"), av[0].alias("ask1"), top(bv, 3).alias("bid3"), top(bv, 5).alias("bid5"), top(av, 5).alias("ask5"), *(((bv[k] + av[k]) / 2).alias(f"level{k}") for k in range(5)))
    valid = F.coalesce((F.col("bid") > 0) & (F.col("ask") > 0) & (F.col("ask") > F.col("bid")), F.lit(False))
    return q.select("*", valid.alias("valid"), F.when(valid, (F.col("bid") + F.col("ask")) / 2).alias("mid"), (F.col("bid1") + F.col("ask1")).alias("depth1"), (F.col("bid5") + F.col("ask5")).alias("depth5"))


def _whole_book(quotes: DataFrame) -> DataFrame:
    """`book` with the arrays of levels and the price beside it."""
    made = book(quotes.withColumn("_levels", F.struct("price", "bid_price", "ask_price", "bid_volume", "ask_volume")))
    return made.select("*", "_levels.*").drop("_levels")


def order_flow(q: DataFrame) -> DataFrame:
    """`ofi`: the change of best bid volume less that of best ask volume since the quote before; 0 at invalid quotes."""
    if "ofi" in q.columns:
        return q
    w = _in_time()
    change = F.col("bid1") - F.lag("bid1").over(w) - (F.col("ask1") - F.lag("ask1").over(w))
    return q.withColumn("ofi", F.when(F.col("valid"), _or_0(change)).otherwise(0.0))


def quoted(deals: DataFrame, quotes: DataFrame) -> DataFrame:
    """Deals with the best prices of the latest book and whether it is valid; staged deals have them."""
    return deals if "q_valid" in deals.columns else asof_backward(deals, book(quotes), KEY, "time", ["bid", "ask", "valid"], "seq", "q_")


HORIZONS = (30, 60, 300)


def _with_quotes(deals: DataFrame, q: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """Deals with the latest valid mid (`q_mid`) and the first one some seconds later (`f30_mid` and so on); staged deals have them.

    All lookups share one sort. Each deal becomes a marker for each time that it asks about, and each valid quote holds its own
    mid and the next one's: the first quote at or after a time is the one that follows the last quote before it. Markers
    of later times come before quotes of the same time, those of the deal's own time after them.
    """
    if all(f"f{h}_mid" in deals.columns for h in horizons):
        return deals
    w = _in_time()
    nothing = F.lit(None).cast("double")
    v = q.where("valid").select(*KEY, F.col("time").alias("_t"), F.lit(1).alias("_side"), "seq", F.struct("mid", F.lead("mid").over(w).alias("next")).alias("_held"))
    marks = F.explode(F.array(F.struct(F.lit(0).alias("h"), F.lit(2).alias("side")), *(F.struct(F.lit(h).alias("h"), F.lit(0).alias("side")) for h in horizons))).alias("_m")
    rest = [c for c in deals.columns if c not in KEY]
    asked = deals.withColumn("_id", F.monotonically_increasing_id()).select(*KEY, "_id", *rest, marks)
    kept = [F.when(F.col("_m.h") == 0, F.col(c)).alias(f"_r_{c}") for c in rest]  # one marker carries the deal
    asked = asked.select(*KEY, (F.col("time") + F.col("_m.h") * 1000).alias("_t"), F.col("_m.side").alias("_side"), "seq", "_id", F.col("_m.h").alias("_h"), *kept)
    both = asked.unionByName(v, allowMissingColumns=True)
    run = Window.partitionBy(*KEY).orderBy("_t", "_side", "seq")
    first = F.first("_held.mid", ignorenulls=True).over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    both = both.withColumn("_first", first).withColumn("_held", F.last("_held", ignorenulls=True).over(run.rowsBetween(Window.unboundedPreceding, 0))).where("_id is not null")
    mid = F.when(F.col("_h") == 0, F.col("_held.mid")).when(F.col("_held").isNull(), F.col("_first")).otherwise(F.col("_held.next"))
    both = both.withColumn("_mid", F.coalesce(mid, nothing))
    at = lambda h: F.max(F.when(F.col("_h") == h, F.col("_mid")))
    found = both.groupBy(*KEY, "_id").agg(*(F.any_value(f"_r_{c}", True).alias(c) for c in rest), at(0).alias("q_mid"), *(at(h).alias(f"f{h}_mid") for h in horizons))
    return found.drop("_id")


def near_touch(orders: DataFrame, quotes: DataFrame) -> DataFrame:
    """Orders with a flag: within one tick of the best price of their side at their time."""
    if "near_touch" in orders.columns:
        return orders
    q = quotes.select(*KEY, "time", "seq", F.col("bid_price")[0].alias("bid"), F.col("ask_price")[0].alias("ask"))
    o = asof_backward(orders, q, KEY, "time", ["bid", "ask"], "seq", "q_")
    best = F.when(_buy(), F.col("q_bid")).otherwise(F.col("q_ask"))
    return o.withColumn("near_touch", F.coalesce(F.abs(F.col("price") - best) <= TICK + 1e-9, F.lit(False))).drop("q_at", "q_bid", "q_ask")


# trades by themselves


def l2_aggression(deals: DataFrame, quotes: DataFrame) -> DataFrame:
    """Mean place of trades between bid and ask, and the median gap between trades of one side.

    Without any book the buys' share of the amount stands for the place.
    """
    e = quoted(executed(deals), quotes)
    place = F.when(F.col("q_valid"), clip((F.col("price") - F.col("q_bid")) / (F.col("q_ask") - F.col("q_bid")), 0, 1))
    gap = F.col("time") - F.lag("time").over(_in_time(*KEY, "side"))
    by_amount = F.when(F.sum("amount") > 0, _sum(F.col("amount"), F.col("side") == 0) / F.sum("amount")).otherwise(0.5)
    return e.withColumn("_place", place).withColumn("_gap", gap).groupBy(*KEY).agg(F.coalesce(F.avg("_place"), by_amount).alias("mean_rel_aggro"), _or_0(F.median("_gap")).alias("median_inter_arrival_ms"))


#: Edges of the inter-arrival histogram in milliseconds.
ARRIVALS = (0, 1, 5, 10, 50, 100, 500, 1000)


def l2_algo_entropy(deals: DataFrame, width: int = 5 * MINUTE, least: int = 3, bits: float = 1.5) -> DataFrame:
    """Entropy of inter-arrival times by window and side of continuous trading; low entropy marks algorithms."""
    e = executed(deals).withColumn("_gap", F.col("time") - F.lag("time").over(_in_time(*KEY, "side")))
    e = e.where(F.col("time").between(OPEN, CONTINUOUS_END) & F.col("_gap").isNotNull())
    inside = [(F.col("_gap") >= low) & (F.col("_gap") < high) if high else F.col("_gap") >= low for low, high in zip(ARRIVALS, (*ARRIVALS[1:], None), strict=True)]
    by = e.groupBy(*KEY, F.floor(F.col("time") / width).alias("w"), "side").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"), *(_n(c).alias(f"n{k}") for k, c in enumerate(inside))).where(F.col("n") >= least)
    p = [F.col(f"n{k}") / F.col("n") for k in range(len(ARRIVALS))]
    by = by.withColumn("h", reduce(lambda a, b: a + b, [F.when(x > 0, -x * F.log(x) / math.log(2)).otherwise(0.0) for x in p]))
    algo = F.col("h") < bits
    return by.groupBy(*KEY).agg(_n(algo).alias("algo_windows"), F.count("*").alias("total_windows"), _mean(F.when(algo, F.col("h"))).alias("mean_algo_entropy"), _mean(F.when(~algo, F.col("h"))).alias("mean_retail_entropy"), _sum(F.col("amount"), algo).alias("algo_total_amount"), _sum(F.col("amount"), ~algo).alias("retail_total_amount"))


def wash_windows(deals: DataFrame, quotes: DataFrame, width: int = 10_000) -> DataFrame:
    """Windows of continuous trading with more volume than the day's median in which the best depth hardly moves."""
    w = F.floor(F.col("time") / width).alias("_w")
    t = executed(deals).where(F.col("time").between(OPEN, CONTINUOUS_END)).groupBy(*KEY, w).agg(F.sum("volume").alias("volume"))
    depth = F.col("bid_volume")[0] + F.col("ask_volume")[0]
    d = quotes.groupBy(*KEY, w).agg(F.abs(F.max_by(depth, _order()) - F.min_by(depth, _order())).alias("moved"))
    typical = t.groupBy(*KEY).agg(F.median("volume").alias("typical"))
    washed = (F.col("volume") != 0) & (F.col("moved") / F.col("volume") < 1e-6) & (F.col("volume") > F.col("typical"))
    return t.join(d, [*KEY, "_w"]).join(typical, KEY).where(washed).select(*KEY, "_w", F.lit(True).alias("wash"))


def marked(deals: DataFrame, quotes: DataFrame, width: int = 10_000) -> DataFrame:
    """Trades with `wash`: in continuous trading and in a wash window; staged deals have it."""
    if "wash" in deals.columns:
        return executed(deals)
    e = executed(deals).withColumn("_w", F.floor(F.col("time") / width)).join(wash_windows(deals, quotes, width), [*KEY, "_w"], "left")
    return e.withColumn("wash", F.coalesce("wash", F.lit(False)) & F.col("time").between(OPEN, CONTINUOUS_END)).drop("_w")


def l2_wash(deals: DataFrame, quotes: DataFrame, width: int = 10_000) -> DataFrame:
    """Share and amount of wash trades, and the amount of the others."""
    e, a = marked(deals, quotes, width), F.col("amount")
    return e.groupBy(*KEY).agg(_share(_sum(a, F.col("wash")), F.sum(a)).alias("wash_trade_ratio"), _sum(a, F.col("wash")).alias("wash_amount"), (_or_0(F.sum(a)) - _sum(a, F.col("wash"))).alias("clean_amount"))


def l2_flow_quadrants(deals: DataFrame, quotes: DataFrame, width: int = 5 * MINUTE) -> DataFrame:
    """Windows of clean trades by signs of net flow and price change, flow bought into falling prices, and VWAP skew.

    A window whose price doesn't move has no skew; a window of one trade has a skew of 0.
    """
    e = marked(deals, quotes).where("not wash").withColumn("w", F.floor(F.col("time") / width))
    by = e.groupBy(*KEY, "w").agg(F.sum(F.col("amount") * F.col("sign")).alias("net"), (F.max_by("price", _order()) - F.min_by("price", _order())).alias("change"), (F.sum("amount") / F.sum("volume") - F.median("price")).alias("off"), F.stddev_samp("price").alias("sd"), F.count("*").alias("n"))
    net, change = F.col("net"), F.col("change")
    skew = F.when(F.col("n") == 1, 0.0).when(F.col("sd") > 0, F.col("off") / F.col("sd"))
    return by.groupBy(*KEY).agg(_or_0(F.sum("net")).alias("total_net_flow"), _sum(net, (net > 0) & (change <= 0)).alias("q2_accumulation"), _mean(skew).alias("mean_vwap_skew"), _n((net > 0) & (change > 0)).alias("q1_count"), _n((net > 0) & (change <= 0)).alias("q2_count"), _n((net < 0) & (change < 0)).alias("q3_count"), _n((net < 0) & (change >= 0)).alias("q4_count"))


def l2_funds(deals: DataFrame, quotes: DataFrame) -> DataFrame:
    """Flows of large, middling and all other clean trades, flows of both auctions, and the Gini index of trade sizes."""
    e = marked(deals, quotes)
    total = e.groupBy(*KEY).agg(F.count("*").alias("total_records"))
    e = e.where("not wash").withColumn("_k", F.row_number().over(Window.partitionBy(*KEY).orderBy("amount", "seq")))
    a, signed, bought = F.col("amount"), F.col("amount") * F.col("sign"), F.col("side") == 0
    large = (a >= LARGE) | (F.col("volume") >= LARGE_VOLUME)
    n, all_of = F.count("*"), F.sum(a)
    gini = F.when((n > 1) & (all_of > 0), (2 * F.sum(F.col("_k") * a) - (n + 1) * all_of) / (n * all_of))
    flows = {"main_net_inflow": _sum(signed, large), "retail_funds_net_inflow": _sum(signed, ~large), "main_funds_buy_amount": _sum(a, large & bought), "main_funds_sell_amount": _sum(a, large & ~bought), "mid_tier_net_inflow": _sum(signed, (a >= MIDDLE) & (a < LARGE)), "trade_size_gini": _or_0(gini), "open_auction_net_inflow": _sum(signed, F.col("time") < OPEN), "close_auction_net_inflow": _sum(signed, F.col("time") > CONTINUOUS_END), "clean_records": n, "large_order_records": _n(large)}
    clean = e.groupBy(*KEY).agg(*(c.alias(name) for name, c in flows.items()))
    return total.join(clean, KEY, "left").na.fill(0)


# quality of the day's data


def l2_quality(deals: DataFrame, orders: DataFrame, quotes: DataFrame) -> DataFrame:
    """Counts, states of quotes, and how well orders and trades link by id."""
    ids = orders.select(*KEY, _identity("id").alias("_id")).where("_id is not null").distinct()
    e = executed(deals)
    sides = e.select(*KEY, "seq", F.explode(F.array(_identity("buy_id"), _identity("sell_id"))).alias("_id"))
    matched = sides.join(ids, [*KEY, "_id"], "left_semi").groupBy(*KEY).agg(F.count_distinct("seq").alias("matched"))
    d = deals.groupBy(*KEY).agg(F.count("*").alias("deal_records"), _n(F.col("side").isin(0, 1)).alias("trades"), _n(F.col("side").isin(0, 1) & F.col("time").between(OPEN, CONTINUOUS_END)).alias("continuous")).join(matched, KEY, "left")
    o = orders.groupBy(*KEY).agg(F.count("*").alias("order_records"), F.avg(_identity("id").isNotNull().cast("double")).alias("order_link_coverage"))
    bid, ask = F.col("bid_price")[0], F.col("ask_price")[0]
    both = (bid > 0) & (ask > 0)
    among_five = lambda name, bad: reduce(lambda a, b: a | b, [(F.size(name) > k) & F.coalesce(bad(F.get(name, F.lit(k))), F.lit(True)) for k in range(5)])
    bad_price = lambda name: among_five(name, lambda x: x <= 0)
    bad_depth = lambda name: among_five(name, lambda x: x < 0)
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    q = quotes.groupBy(*KEY).agg(F.count("*").alias("snapshot_records"), share(both & (bid > ask)).alias("crossed_quote_ratio"), share(both & (bid == ask)).alias("locked_quote_ratio"), share(both & (ask > bid)).alias("valid_spread_ratio"), share(bad_price("bid_price") | bad_price("ask_price")).alias("missing_top5_quote_ratio"), share(~bad_depth("bid_volume") & ~bad_depth("ask_volume")).alias("nonnegative_depth_ratio"))
    out = d.join(o, KEY, "full").join(q, KEY, "full").na.fill(0)
    has = lambda n: (F.col(n) > 0)
    match = _share(F.col("matched"), F.col("trades"))
    orphan = _share(F.col("trades") - F.col("matched"), F.col("trades"))
    return out.select(*KEY, has("deal_records").alias("has_deal"), has("order_records").alias("has_order"), has("snapshot_records").alias("has_snapshot"), "deal_records", "order_records", "snapshot_records", _share(F.col("continuous"), F.col("trades")).alias("continuous_auction_ratio"), "crossed_quote_ratio", "locked_quote_ratio", "missing_top5_quote_ratio", "order_link_coverage", match.alias("deal_order_match_ratio"), "nonnegative_depth_ratio", "valid_spread_ratio", orphan.alias("orphan_execution_ratio"))


# orders


def l2_spoofing(deals: DataFrame, orders: DataFrame, quotes: DataFrame) -> DataFrame:
    """Cancelled against traded volume by minute and side, minutes of fake pressure or support, and distance of cancels.

    A side without trades has no ratio; where the other side has one, it counts as 0. Days without cancels or without
    deals have no row.
    """
    minute = F.floor(F.col("time") / MINUTE).alias("minute")
    cancels = orders.where(_cancel())
    zero = F.lit(0.0)
    c = cancels.select(*KEY, minute, F.when(_buy(), F.col("volume")).otherwise(zero).alias("cb"), F.when(_buy(), zero).otherwise(F.col("volume")).alias("cs"), zero.alias("tb"), zero.alias("ts"))
    t = executed(deals).select(*KEY, minute, zero.alias("cb"), zero.alias("cs"), F.when(F.col("side") == 0, F.col("volume")).otherwise(zero).alias("tb"), F.when(F.col("side") == 1, F.col("volume")).otherwise(zero).alias("ts"))
    by = c.unionByName(t).groupBy(*KEY, "minute").agg(*(F.sum(n).alias(n) for n in ("cb", "cs", "tb", "ts")))
    by = by.withColumn("buy", F.when(F.col("tb") != 0, F.col("cb") / F.col("tb"))).withColumn("sell", F.when(F.col("ts") != 0, F.col("cs") / F.col("ts")))
    buy, sell = _or_0(F.col("buy")), _or_0(F.col("sell"))
    pressure, support = (sell > 5) & (buy < 2), (buy > 5) & (sell < 2)
    out = by.groupBy(*KEY).agg(_n(pressure | support).alias("spoof_count"), _n(pressure).alias("fake_pressure_count"), _n(support).alias("fake_support_count"), _mean(F.col("sell")).alias("mean_sell_otr"), _mean(F.col("buy")).alias("mean_buy_otr"))
    seen = asof_backward(cancels.where("price <> 0"), book(quotes), KEY, "time", ["bid", "ask"], "seq", "q_")
    far = F.when(_buy(), F.col("q_bid") - F.col("price")).otherwise(F.col("price") - F.col("q_ask")) / TICK
    days = cancels.select(*KEY).distinct().join(deals.select(*KEY).distinct(), KEY)
    return days.join(out, KEY).join(seen.groupBy(*KEY).agg(F.avg(far).alias("mean_cancel_distance_ticks")), KEY, "left").na.fill(0)


def l2_lifecycle(deals: DataFrame, orders: DataFrame, horizon: int = 1000, apart: float = 0.02) -> DataFrame:
    """Fates of orders by id: cancelled unfilled, partly filled, latencies, passive share, replaced ones.

    An id that is used again is one order: its first submission gives price and side, its volumes add up.
    """
    ident = [*KEY, "id"]
    named = orders.withColumn("id", _identity("id"))
    price = _or_0(F.min_by("price", _order()))
    sub = named.where(_add() & F.col("id").isNotNull()).groupBy(*ident).agg(F.min("time").alias("t0"), price.alias("price"), F.min_by(_buy(), _order()).alias("buy"), _or_0(F.sum("volume")).alias("given"))
    can = named.where(_cancel() & F.col("id").isNotNull()).groupBy(*ident).agg(F.min("time").alias("tc"), _or_0(F.sum("volume")).alias("vc"))
    e = executed(deals)
    side = lambda c, buy: e.select(*KEY, _identity(c).alias("id"), F.lit(buy).alias("buy"), "time", "volume", F.when(F.col("side") == (1 if buy else 0), F.col("volume")).otherwise(0.0).alias("passive"))
    fill = side("buy_id", True).unionByName(side("sell_id", False)).where("id is not null").groupBy(*ident, "buy").agg(F.min("time").alias("tf"), _or_0(F.sum("volume")).alias("vf"), _or_0(F.sum("passive")).alias("passive"))
    life = sub.join(can, ident, "left").join(fill, [*ident, "buy"], "left")
    volume = F.greatest(F.col("given"), F.lit(0.0))
    capped = F.least(volume, _or_0(F.col("vf")))
    filled, cancelled = capped > 0, F.col("tc").isNotNull()
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    large = F.col("given") * F.col("price") >= LARGE
    wait = lambda c: _or_0(F.median(F.when(F.col(c) >= F.col("t0"), F.col(c) - F.col("t0"))))
    out = life.groupBy(*KEY).agg(share(cancelled & ~filled).alias("cancel_without_fill_ratio"), share(cancelled & filled & (capped < volume)).alias("partial_fill_ratio"), wait("tc").alias("median_cancel_time_ms"), wait("tf").alias("median_first_fill_time_ms"), _share(_sum(F.col("passive")), F.sum("vf")).alias("passive_fill_ratio"), _share(_sum(capped, large), _sum(volume, large)).alias("large_order_fill_rate"), share((F.col("vc") > 0) & (F.col("vc") < volume)).alias("partial_cancel_ratio"))
    sided = orders.withColumn("buy", _buy())
    c, n = (sided.where(cond).select(*KEY, "buy", "seq", "time", "price") for cond in (_cancel(), _add()))
    c = c.join(n.select(*KEY, "buy").distinct(), [*KEY, "buy"], "left_semi")
    like = replace_like(c, n, [*KEY, "buy"], horizon, apart).groupBy(*KEY).agg(F.avg(F.col("replace_like").cast("double")).alias("replace_like_ratio"))
    return out.join(like, KEY, "left").na.fill(0)


# the book


def l2_microstructure(deals: DataFrame, orders: DataFrame, quotes: DataFrame) -> DataFrame:
    """Spread, imbalances, depths and their shape, microprice, order flow, impact of trades, refill and illiquidity."""
    q = order_flow(book(quotes))
    w = _in_time()
    on = lambda c: F.when(F.col("valid"), c)
    bid, ask, b1, a1, mid = (F.col(c) for c in ("bid", "ask", "bid1", "ask1", "mid"))
    micro = ((ask * b1 + bid * a1) / F.nullif(b1 + a1, F.lit(0.0)) - mid) / mid
    obi = lambda b, a: on((b - a) / F.nullif(b + a, F.lit(0.0)))
    lv = [F.col(f"level{k}") for k in range(5)]
    shaped = F.col("valid") & reduce(lambda x, y: x & y, [x.isNotNull() for x in lv]) & (lv[0] > 0)
    slope = F.when(shaped, (-2 * lv[0] - lv[1] + lv[3] + 2 * lv[4]) / 10 / lv[0])
    bend = F.when(shaped, reduce(lambda x, y: x + y, [lv[k + 2] - 2 * lv[k + 1] + lv[k] for k in range(3)]) / 3 / lv[0])
    x = q.select("*", on((ask - bid) / bid).alias("_spread"), obi(b1, a1).alias("_obi1"), obi(F.col("bid5"), F.col("ask5")).alias("_obi5"), on(F.col("depth1")).alias("_d1"), on(F.col("depth5")).alias("_d5"), on(micro).alias("_shift"), slope.alias("_slope"), bend.alias("_bend"), F.lag("ofi").over(w).alias("_before"))
    sd = lambda c: _or_0(F.stddev_pop(c))
    some = F.sum(F.when(F.col("ofi") != 0, 1.0))
    state = x.groupBy(*KEY).agg(_mean(F.col("_spread")).alias("mean_spread"), _mean(F.col("_obi5")).alias("mean_obi_top5"), _mean(F.col("_obi1")).alias("obi_top1_mean"), sd("_obi5").alias("obi_top5_std"), sd("_obi1").alias("obi_top1_std"), _mean(F.col("_d1")).alias("depth_top1_mean"), _mean(F.col("_d5")).alias("depth_top5_mean"), _mean(F.col("_slope")).alias("depth_slope"), _mean(F.col("_bend")).alias("depth_convexity"), _mean(F.col("_shift")).alias("microprice_minus_mid_mean"), sd("_shift").alias("microprice_minus_mid_std"), _mean(F.col("ofi")).alias("ofi_mean"), sd("ofi").alias("ofi_std"), _or_0(correlation("_before", "ofi")).alias("ofi_persistence"), _share(F.sum(F.when(F.col("ofi") > 0, 1.0).otherwise(0.0)), some).alias("ofi_positive_ratio"), _share(F.sum(F.when(F.col("ofi") < 0, 1.0).otherwise(0.0)), some).alias("ofi_negative_ratio"), F.min_by("last", F.when(F.col("last") > 0, _order())).alias("_q_open"), F.max_by("last", F.when(F.col("last") > 0, _order())).alias("_q_close"))
    deep = q.where("valid and depth1 is not null").select(*KEY, "time", "seq", "depth1")
    drop = deep.withColumn("_was", F.lag("depth1").over(w)).withColumn("_n", F.count("*").over(Window.partitionBy(*KEY))).where("_n >= 3 and depth1 < _was and _was > 0")
    later = asof_forward(drop, deep, KEY, "time", ["depth1"], "seq", "f_", horizon=F.lit(30_000))
    refill = later.groupBy(*KEY).agg((_mean((F.col("f_depth1") - F.col("depth1")) / F.col("_was")) / 30).alias("orderbook_replenish_speed"))
    near = orders.where("near_touch").groupBy(*KEY).agg(_share(_n(_cancel()), _n(_add())).alias("near_touch_cancel_add_ratio"))
    e = _with_quotes(deals.select(*KEY, "time", "seq", "price", "volume", "side", *(c for c in ("q_mid", "f30_mid", "f60_mid", "f300_mid") if c in deals.columns)), q, HORIZONS)
    m, p, s = F.col("q_mid"), F.col("price"), _direction()
    priced, turnover = F.when(p > 0, p), p * F.col("volume")
    ends = [f("price", F.when(priced.isNotNull(), _order())).alias(name) for f, name in ((F.min_by, "_open"), (F.max_by, "_close"))]
    hit = e.groupBy(*KEY).agg(_mean(2 * F.abs(p - m) / m).alias("effective_spread_mean"), _mean(2 * s * (p - F.col("f60_mid")) / m).alias("realized_spread_1m"), _mean(s * (F.col("f30_mid") - m) / m).alias("impact_30s"), _mean(s * (F.col("f300_mid") - m) / m).alias("impact_5m"), F.sum(F.when(turnover > 0, turnover)).alias("_amount"), *ends)
    out = reduce(lambda a, b: a.join(b, KEY, "left"), (refill, near, hit), state)
    start = F.coalesce("_open", "_q_open")
    end = F.when(F.col("_open").isNotNull(), F.col("_close")).otherwise(F.col("_q_close"))
    out = out.withColumn("amihud_illiquidity", _or_0(F.abs(end - start) / start / (F.col("_amount") / 1e9)))
    return out.drop("_open", "_close", "_q_open", "_q_close", "_amount").na.fill(0)


def l2_lob_transition(deals: DataFrame, orders: DataFrame, quotes: DataFrame) -> DataFrame:
    """Recovery of depth after 5 s, depletions of a best queue to a fifth, turnover, decay of pressure, and flow at the touch."""
    q = book(quotes)
    w = _in_time()
    pressure = (F.col("bid5") - F.col("ask5")) / F.nullif(F.col("depth5"), F.lit(0.0))
    x = q.select("*", pressure.alias("bp"), *(F.lag(c).over(w).alias(f"_{c}") for c in ("bid1", "ask1", "depth5")))
    fell = lambda c: F.coalesce((F.col(f"_{c}") > 0) & (F.col(c) <= F.col(f"_{c}") * 0.2), F.lit(False))
    state = x.groupBy(*KEY).agg(_share(_n(fell("bid1") | fell("ask1")), _n((F.col("_bid1") > 0) | (F.col("_ask1") > 0))).alias("best_quote_depletion_rate"), _share(F.avg(F.abs(F.col("depth5") - F.col("_depth5"))), F.avg("depth5")).alias("depth_turnover_top5"))
    pairs = x.where("bp is not null").withColumn("_bp", F.lag("bp").over(w))
    decay = pairs.groupBy(*KEY).agg(F.when(F.count("*") >= 3, _or_0(clip(1 - correlation("_bp", "bp"), 0, 2))).otherwise(0.0).alias("book_pressure_decay"))
    deep = q.where("depth1 is not null").select(*KEY, "time", "seq", "depth1")
    all_of = q.groupBy(*KEY).agg(F.count("*").alias("_n"))
    drop = deep.withColumn("_was", F.lag("depth1").over(w)).withColumn("_t", F.lag("time").over(w)).where("_was > depth1").join(all_of, KEY)
    later = asof_forward(drop, deep, KEY, "time", ["depth1"], "seq", "f_", horizon=F.lit(5_000))
    lost, seconds = F.col("_was") - F.col("depth1"), (F.col("time") - F.col("_t")) / 1000
    back = F.when((F.col("_n") >= 3) & (F.col("_was") > 0), clip((F.col("f_depth1") - F.col("depth1")) / lost, 0, 1))
    speed = F.when((F.col("_was") != 0) & (seconds != 0), lost / F.col("_was") / seconds)
    queues = later.groupBy(*KEY).agg(_mean(back).alias("depth_recovery_5s"), _mean(speed).alias("queue_depletion_speed"))
    seen = quoted(deals, q)
    at_touch = (F.col("q_bid") > 0) & (F.col("q_ask") > 0) & ((F.col("price") >= F.col("q_ask")) | (F.col("price") <= F.col("q_bid")))
    done = seen.where(at_touch).groupBy(*KEY).agg(_or_0(F.sum("volume")).alias("_done"))
    near = orders.where("near_touch").groupBy(*KEY).agg(_sum(F.col("volume"), _add()).alias("_added"), _sum(F.col("volume"), _cancel()).alias("_gone"))
    out = reduce(lambda a, b: a.join(b, KEY, "full"), (decay, queues, done, near), state).na.fill(0)
    return out.withColumn("add_cancel_execute_ratio_top1", _share(F.col("_added"), F.col("_gone") + F.col("_done"))).drop("_added", "_gone", "_done")


def l2_intraday_segments(deals: DataFrame, quotes: DataFrame) -> DataFrame:
    """Spread of the first half hour, imbalance and impact of the last, depth at midday, reversal of the order flow."""
    q = order_flow(book(quotes))
    t, good = F.col("time"), F.col("valid")
    first, middle, last = (t >= OPEN) & (t < TEN), (t >= TEN) & (t < CLOSING), t.between(CLOSING, CLOSE)
    mean = lambda where, c: F.avg(F.when(where, c))
    obi = (F.col("bid5") - F.col("ask5")) / F.nullif(F.col("depth5"), F.lit(0.0))
    by = q.groupBy(*KEY).agg(_or_0(mean(first & good, (F.col("ask") - F.col("bid")) / F.col("bid"))).alias("open_30m_spread_mean"), _or_0(mean(last & good, obi)).alias("close_30m_obi_mean"), mean(first & good, F.col("depth5")).alias("od"), mean(middle & good, F.col("depth5")).alias("md"), mean(t.between(OPEN, MORNING_END), F.col("ofi")).alias("mo"), mean(t.between(AFTERNOON, CLOSE), F.col("ofi")).alias("ao"))
    fall = _or_0(F.when((F.col("od") > 0) & (F.col("md") > 0), (F.col("od") - F.col("md")) / F.col("od")))
    turned = _or_0(F.when((F.col("mo") != 0) & (F.col("ao") != 0) & (F.signum("mo") != F.signum("ao")), 1.0))
    by = by.select(*KEY, "open_30m_spread_mean", "close_30m_obi_mean", fall.alias("midday_liquidity_drop"), turned.alias("afternoon_ofi_reversal"))
    e = _with_quotes(deals.withColumn("_s", _direction()), q, (30,))
    impact = F.when(last, F.col("_s") * (F.col("f30_mid") - F.col("q_mid")) / F.col("q_mid") + 0 * F.col("price"))
    v = e.groupBy(*KEY).agg(_share(_sum(F.col("volume"), first), _sum(F.col("volume"), last)).alias("open_close_vol_ratio"), _mean(impact).alias("close_30m_impact_mean"))
    return by.join(v, KEY, "full").na.fill(0)


def l2_trade_sign(deals: DataFrame, quotes: DataFrame) -> DataFrame:
    """Given sides against the quote rule, and inside a valid spread against the tick rule. Days without quotes have no row."""
    e = quoted(executed(deals).where("price is not null"), quotes)
    w = _in_time()
    move = F.signum(F.col("price") - F.lag("price").over(w))
    e = e.withColumn("_tick", F.when(move != 0, move)).withColumn("_tick", F.last("_tick", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    valid = F.coalesce("q_valid", F.lit(False))
    above, below = F.col("price") >= F.col("q_ask"), F.col("price") <= F.col("q_bid")
    inside = valid & ~above & ~below
    e = e.withColumn("_inside", F.coalesce(inside, F.lit(False))).withColumn("_guess", F.when(valid & above, 1.0).when(valid & below, -1.0).when(inside, F.col("_tick")))
    match = F.when(F.col("_guess").isNotNull(), (F.col("_guess") == F.col("sign")).cast("double"))
    out = e.groupBy(*KEY).agg(_mean(match).alias("aggressor_label_match_ratio"), _mean(F.when(F.col("_inside"), match)).alias("mid_cross_match_ratio"), F.avg(F.col("_inside").cast("double")).alias("tick_rule_fallback_ratio"), F.avg(F.col("_guess").isNull().cast("double")).alias("unclassified_trade_ratio"))
    return out.join(quotes.select(*KEY).distinct(), KEY, "left_semi")


def l2_intensity(deals: DataFrame, quotes: DataFrame, width: int = 5 * MINUTE) -> DataFrame:
    """Sweeps of one buyer, escort by the bids, premium over large buys' VWAP, slope of the order flow, and a score.

    Only days with trades and quotes have a row.
    """
    e = executed(deals)
    bought, large = F.col("side") == 0, F.col("amount") >= LARGE
    runs = e.where(bought & F.col("buy_id").isNotNull()).groupBy(*KEY, "buy_id").agg(F.sum("amount").alias("a"), F.sum("volume").alias("v"), F.count("*").alias("n")).where("n >= 3 and a >= 5e5")
    runs = runs.groupBy(*KEY).agg(F.sum("v").alias("swept"), F.avg("n").alias("each"))
    t = e.groupBy(*KEY).agg(F.sum("volume").alias("volume"), _share(_sum(F.col("amount"), bought & large), _sum(F.col("volume"), bought & large)).alias("vwap"))
    q = book(quotes)
    total = F.col("total_bid_volume") - F.lag("total_bid_volume").over(_in_time()) - (F.col("total_ask_volume") - F.lag("total_ask_volume").over(_in_time()))
    own = Window.partitionBy(*KEY, "w").orderBy("time", "seq")
    flow = q.withColumn("w", F.floor(F.col("time") / width)).withColumn("_f", _or_0(total)).withColumn("_c", F.sum("_f").over(own.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_i", F.row_number().over(own))
    slopes = flow.groupBy(*KEY, "w").agg(F.count("*").alias("n"), (F.covar_pop("_i", "_c") / F.var_pop("_i")).alias("s")).where("n >= 30").groupBy(*KEY).agg(F.avg("s").alias("slope"))
    near = F.col("bid3") - F.col("ask5")
    b = q.groupBy(*KEY).agg(F.count("*").alias("quotes"), (_share(F.sum("bid3"), F.sum("ask5")) * 0.95).alias("mfi_escort"), (F.max_by(near, _order()) - F.min_by(near, _order())).alias("gained"), F.max_by("last", _order()).alias("close"))
    x = t.join(b, KEY).join(runs, KEY, "left").join(slopes, KEY, "left")
    pulse = _or_0(F.when((F.col("volume") > 0) & F.col("each").isNotNull(), F.col("swept") / F.col("volume") * F.log1p("each")))
    drift = F.tanh(F.col("gained") / 1e6)
    premium = F.greatest((F.col("close") - F.col("vwap")) / F.col("vwap"), F.lit(0.0))
    precip = _or_0(F.when((F.col("vwap") > 0) & (drift > 0), drift * premium * 100))
    slope = F.when(F.col("quotes") > 10, F.tanh(_or_0(F.col("slope")) / 1000)).otherwise(0.0)
    x = x.select(*KEY, pulse.alias("mfi_pulse"), "mfi_escort", precip.alias("mfi_precip"), slope.alias("ofi_slope"))
    return x.withColumn("mfi_score", F.greatest(0.4 * F.tanh(F.col("mfi_pulse") * 10) + 0.3 * F.tanh(F.col("mfi_escort") / 2) + 0.3 * F.tanh("mfi_precip"), F.lit(0.0)))


# the mixture of minutes


def minute_table(deals: DataFrame, orders: DataFrame, quotes: DataFrame) -> DataFrame:
    """Each minute with deals or orders: mean deal, orders, cancelled share, mean relative spread, buys' share; volume and net amount."""
    minute = F.floor(F.col("time") / MINUTE).alias("minute")
    gone, bought = F.col("side").isin(-1, -11), F.col("side") == 0
    d = deals.groupBy(*KEY, minute).agg(F.count("*").alias("deals"), _or_0(F.sum("volume")).alias("volume"), _n(gone).alias("cancels"), _sum(F.col("volume"), gone).alias("gone"), _n(bought).alias("buys"), _sum(F.col("volume"), bought).alias("bought"), _sum(F.col("price") * F.col("volume") * _direction()).alias("net"))
    o = orders.groupBy(*KEY, minute).agg(F.count("*").alias("orders"), _or_0(F.sum("volume")).alias("ordered"))
    spread = (F.col("ask_price")[0] - F.col("bid_price")[0]) / (F.col("bid_price")[0] + 1e-6)
    q = quotes.groupBy(*KEY, minute).agg(F.avg(spread).alias("spread"))
    x = d.join(o, [*KEY, "minute"], "full").join(q, [*KEY, "minute"], "left").na.fill(0)
    x = x.join(deals.select(*KEY).distinct(), KEY, "left_semi")
    return x.select(*KEY, "minute", _share(F.col("volume"), F.col("deals")).alias("mean_deal"), F.col("orders").cast("double").alias("orders"), F.when(F.col("cancels") > 0, clip(F.col("gone") / (F.col("ordered") + 1e-6), 0, 1)).otherwise(0.0).alias("cancelled"), "spread", F.when(F.col("buys") > 0, F.col("bought") / (F.col("volume") + 1e-6)).otherwise(0.0).alias("buy_share"), "volume", "net")


PARTS = 3


def started(x: np.ndarray, seed: int = 42) -> np.ndarray:
    """Clusters of rows by k-means with greedy k-means++ seeding: the labels that start the mixture."""
    x = x - x.mean(0)
    draw = np.random.RandomState(seed).random_sample
    away = lambda centers: ((x[:, None] - centers) ** 2).sum(2)
    chosen = [min(int(draw() * len(x)), len(x) - 1)]
    near = away(x[chosen])[:, 0]
    for _ in range(1, PARTS):
        marks = [draw() for _ in range(PARTS)]
        tried = [min(int(np.searchsorted(np.cumsum(near), m * near.sum())), len(x) - 1) for m in marks]
        left = [np.minimum(near, away(x[[k]])[:, 0]) for k in tried]
        best = int(np.argmin([v.sum() for v in left]))
        chosen.append(tried[best])
        near = left[best]
    centers, labels = x[chosen], None
    for _ in range(300):
        distance = away(centers)
        fresh = distance.argmin(1)
        groups = [fresh == c for c in range(PARTS)]
        moved = np.array([x[g].mean(0) if g.any() else x[distance.min(1).argmax()] for g in groups])
        shift, centers = ((centers - moved) ** 2).sum(), moved
        if labels is not None and (labels == fresh).all():
            return fresh
        labels = fresh
        if shift <= x.var(0).mean() * 1e-4:
            break
    return away(centers).argmin(1)


def mixture(x: np.ndarray, rounds: int = 100, least: float = 1e-3, ridge: float = 1e-6) -> tuple[np.ndarray, np.ndarray] | None:
    """Labels and means of a mixture of PARTS full Gaussians, by expectation and maximization; None where it breaks down."""
    n, size = x.shape
    share = np.eye(PARTS)[started(x)]
    bound = -np.inf

    def fitted():
        count = share.sum(0) + 10 * np.finfo(float).eps
        mean = share.T @ x / count[:, None]
        parts = [((x - m).T * share[:, c]) @ (x - m) / count[c] + ridge * np.eye(size) for c, m in enumerate(mean)]
        return count / count.sum(), mean, [np.linalg.cholesky(p) for p in parts]

    def logs(weight, mean, roots):
        z = [np.linalg.solve(root, (x - m).T) for root, m in zip(roots, mean, strict=True)]
        return np.column_stack([np.log(w) - 0.5 * (size * math.log(2 * math.pi) + (v**2).sum(0)) - np.log(np.diag(r)).sum() for w, v, r in zip(weight, z, roots, strict=True)])

    try:
        model = fitted()
        for _ in range(rounds):
            log = logs(*model)
            norm = np.logaddexp.reduce(log, axis=1)
            if not np.isfinite(norm).all():
                return None
            share = np.exp(log - norm[:, None])
            model = fitted()
            if abs(norm.mean() - bound) < least:
                break
            bound = norm.mean()
        return logs(*model).argmax(1), model[1]
    except np.linalg.LinAlgError:
        return None


MIXED = ("gmm_main_force_ratio", "gmm_hft_ratio", "gmm_retail_ratio", "gmm_main_force_net_inflow")


def l2_gmm_split(deals: DataFrame, orders: DataFrame, quotes: DataFrame, least: int = 5) -> DataFrame:
    """Volume shares of three kinds of minutes and the net amount of the main one. A symbol's day has 1440 minutes at most.

    The kind with the most orders is high-frequency, the one with the largest mean deal main (the second, if that is
    the high-frequency one), the rest retail.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, out = rows.sort_values("minute"), dict.fromkeys(MIXED, 0.0)
        x = rows[["mean_deal", "orders", "cancelled", "spread", "buy_share"]].to_numpy(float)
        total = rows["volume"].sum()
        if len(rows) >= least and total and np.isfinite(x).all():
            scale = np.where(x.std(0) > 1e-12 * np.maximum(1, np.abs(x.mean(0))), x.std(0), 1.0)
            found = mixture((x - x.mean(0)) / scale)
            if found:
                label, mean = found[0], found[1] * scale + x.mean(0)
                fast, ranked = int(mean[:, 1].argmax()), np.argsort(-mean[:, 0], kind="stable")
                main = int(ranked[0] if ranked[0] != fast else ranked[1])
                part = lambda c: rows["volume"].to_numpy()[label == c].sum() / total
                rest = next(c for c in range(PARTS) if c not in (fast, main))
                out = dict(zip(MIXED, (part(main), part(fast), part(rest), rows["net"].to_numpy()[label == main].sum()), strict=True))
        return pd.DataFrame([{"symbol": rows["symbol"].iloc[0], "trade_date": rows["trade_date"].iloc[0], **out}])

    made = minute_table(deals, orders, quotes)
    return made.groupBy(*KEY).applyInPandas(run, f"symbol {made.schema['symbol'].dataType.simpleString()}, trade_date date, " + ", ".join(f"{c} double" for c in MIXED))


def staged(deals: DataFrame, orders: DataFrame, quotes: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables with what several groups of features share, written once under `folder`.

    Quotes get the columns of `book` and `order_flow`, deals the latest book, the mids at all horizons and the wash flag,
    orders the near-touch flag. The groups know these columns and don't make them again.
    """
    spark = deals.sparkSession

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.repartition(*KEY).write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    q = saved(order_flow(_whole_book(quotes)), "quotes")
    d = _with_quotes(quoted(deals, q).drop("q_at"), q, HORIZONS)
    washed = wash_windows(deals, q)
    d = d.withColumn("_w", F.floor(F.col("time") / 10_000)).join(washed, [*KEY, "_w"], "left")
    wash = F.coalesce("wash", F.lit(False)) & F.col("time").between(OPEN, CONTINUOUS_END) & F.col("side").isin(0, 1)
    d = saved(d.withColumn("wash", F.coalesce(wash, F.lit(False))).drop("_w"), "deals")
    return d, saved(near_touch(orders, q), "orders"), q


def l2_daily_features(deals: DataFrame, orders: DataFrame, quotes: DataFrame, folder: str | None = None, mixed: bool = True) -> DataFrame:
    """All groups on one key, with 0 where a group has no row; a column that two groups own is an error.

    With a folder, shared inputs are staged there, so the ticks are read a few times and not by each group. Without `mixed`
    the mixture of minutes, a fit of its own for each symbol's day, isn't made and its columns are missing.
    """
    if folder:
        deals, orders, quotes = staged(deals, orders, quotes, folder)
    groups = [l2_quality(deals, orders, quotes), l2_lifecycle(deals, orders), l2_intraday_segments(deals, quotes), l2_trade_sign(deals, quotes), l2_lob_transition(deals, orders, quotes), l2_aggression(deals, quotes), l2_algo_entropy(deals), l2_wash(deals, quotes), l2_spoofing(deals, orders, quotes), l2_flow_quadrants(deals, quotes), l2_funds(deals, quotes), l2_microstructure(deals, orders, quotes), *([l2_gmm_split(deals, orders, quotes)] if mixed else []), l2_intensity(deals, quotes)]
    if folder:  # a row for each symbol and day: small tables, so no plan holds all groups
        for k, g in enumerate(groups):
            g.write.parquet(f"{folder}/group{k}")
            groups[k] = g.sparkSession.read.schema(g.schema).parquet(f"{folder}/group{k}")
    out, owned = None, set(KEY)
    for g in groups:
        twice = owned & {c for c in g.columns if c not in KEY}
        if twice:
            raise ValueError(f"two groups own {sorted(twice)}")
        owned |= set(g.columns)
        out = g if out is None else out.join(g, KEY, "left")
    return out.na.fill(0)
