"""Order-book and trade features, and streams, over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import l2
from tickloom.plans.base import LEVEL2, folder, level2, r, rounded, staged, table
from tickloom.plans.series import rnd
from tickloom.streaming import minutes as st

QUERIES: dict = {}
KEYS, BY = "symbol, trade_date", "PARTITION BY symbol, trade_date"
IN_TIME = f"({BY} ORDER BY time, seq)"
#: Trades with their wash windows, as CTEs.
MARKED = f"""{LEVEL2}, wt AS (SELECT {KEYS}, time // 10000 AS w, sum(volume) AS volume FROM e WHERE time BETWEEN 34200000 AND 53820000 GROUP BY ALL),
wd AS (SELECT {KEYS}, time // 10000 AS w, abs(last(depth1 ORDER BY time, seq) - first(depth1 ORDER BY time, seq)) AS moved FROM q GROUP BY ALL),
wm AS (SELECT {KEYS}, median(volume) AS typical FROM wt GROUP BY ALL),
washed AS (SELECT {KEYS}, w, true AS washed FROM wt JOIN wd USING ({KEYS}, w) JOIN wm USING ({KEYS}) WHERE moved / volume < 1e-6 AND volume > typical),
m AS (SELECT e.*, coalesce(washed, false) AND time BETWEEN 34200000 AND 53820000 AS wash FROM (SELECT *, time // 10000 AS w FROM e) e LEFT JOIN washed USING ({KEYS}, w)),
clean AS (SELECT * FROM m WHERE NOT wash)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


def _all(df, n: int = 6):
    return rounded(df, *[c for c, kind in df.dtypes if kind == "double"], n=n)


def _money(df, *columns: str):
    return rounded(rounded(df, *[c for c, kind in df.dtypes if kind == "double" and c not in columns]), *columns, n=2)


def _sql(columns: dict[str, str], source: str, money: tuple[str, ...] = (), counts: tuple[str, ...] = ()) -> str:
    """Columns by symbol and day; all but counts are rounded and 0 where missing."""
    made = [f"{x} AS {c}" if c in counts else f"{rnd(f'coalesce({x}, 0)', 2 if c in money else 6)} AS {c}" for c, x in columns.items()]
    return f"SELECT {KEYS}, {', '.join(made)} FROM {source} GROUP BY {KEYS}"


def _near(spark, d):
    """level2 with near-touch flags on the orders."""
    deals, orders, quotes = level2(spark, d)
    return deals, l2.near_touch(orders, quotes), quotes


@query(f"WITH {LEVEL2}, p AS (SELECT e.*, CASE WHEN valid THEN least(greatest((price - bid) / (ask - bid), 0), 1) END AS place, e.time - lag(e.time) OVER (PARTITION BY e.symbol, e.trade_date, side ORDER BY e.time, e.seq) AS gap FROM e ASOF LEFT JOIN qb ON e.symbol = qb.symbol AND e.trade_date = qb.trade_date AND e.time >= qb.time) " + _sql({"mean_rel_aggro": "avg(place)", "median_inter_arrival_ms": "median(gap)"}, "p"))
def l2_aggression(spark, d):
    deals, _, quotes = level2(spark, d)
    return _all(l2.l2_aggression(deals, quotes))


_BINS = ((0, 1), (1, 5), (5, 10), (10, 50), (50, 100), (100, 500), (500, 1000), (1000, None))
_COUNTS = ", ".join(f"count(*) FILTER (gap >= {a}{f' AND gap < {b}' if b else ''}) AS n{k}" for k, (a, b) in enumerate(_BINS))
_ENTROPY = " + ".join(f"CASE WHEN n{k} > 0 THEN -(n{k} / n) * ln(n{k} / n) / ln(2) ELSE 0 END" for k in range(8))


@query(f"WITH {LEVEL2}, g AS (SELECT *, time - lag(time) OVER (PARTITION BY symbol, trade_date, side ORDER BY time, seq) AS gap FROM e), b AS (SELECT {KEYS}, time // 300000 AS w, side, count(*) AS n, sum(amount) AS amount, {_COUNTS} FROM g WHERE gap IS NOT NULL AND time BETWEEN 34200000 AND 53820000 GROUP BY ALL), h AS (SELECT *, {_ENTROPY} AS h FROM b WHERE n >= 3) " + _sql({"algo_windows": "count(*) FILTER (h < 1.5)", "total_windows": "count(*)", "mean_algo_entropy": "avg(h) FILTER (h < 1.5)", "mean_retail_entropy": "avg(h) FILTER (h >= 1.5)", "algo_total_amount": "sum(amount) FILTER (h < 1.5)", "retail_total_amount": "sum(amount) FILTER (h >= 1.5)"}, "h", ("algo_total_amount", "retail_total_amount"), ("algo_windows", "total_windows")))
def l2_algo_entropy(spark, d):
    return _money(l2.l2_algo_entropy(level2(spark, d)[0]), "algo_total_amount", "retail_total_amount")


@query(f"WITH {MARKED} " + _sql({"wash_trade_ratio": "sum(amount) FILTER (wash) / sum(amount)", "wash_amount": "sum(amount) FILTER (wash)", "clean_amount": "sum(amount) - coalesce(sum(amount) FILTER (wash), 0)"}, "m", ("wash_amount", "clean_amount")))
def l2_wash(spark, d):
    deals, _, quotes = level2(spark, d)
    return _money(l2.l2_wash(deals, quotes), "wash_amount", "clean_amount")


@query(f"WITH {MARKED}, w AS (SELECT {KEYS}, time // 300000 AS w, sum(amount * sign) AS net, last(price ORDER BY time, seq) - first(price ORDER BY time, seq) AS change, sum(amount) / sum(volume) - median(price) AS off, stddev_samp(price) AS sd, count(*) AS n FROM clean GROUP BY ALL) " + _sql({"total_net_flow": "sum(net)", "q2_accumulation": "sum(net) FILTER (net > 0 AND change <= 0)", "mean_vwap_skew": "avg(CASE WHEN n = 1 THEN 0 WHEN sd > 1e-12 THEN off / sd END)", "q1_count": "count(*) FILTER (net > 0 AND change > 0)", "q2_count": "count(*) FILTER (net > 0 AND change <= 0)", "q3_count": "count(*) FILTER (net < 0 AND change < 0)", "q4_count": "count(*) FILTER (net < 0 AND change >= 0)"}, "w", ("total_net_flow", "q2_accumulation"), ("q1_count", "q2_count", "q3_count", "q4_count")))
def l2_flow_quadrants(spark, d):
    deals, _, quotes = level2(spark, d)
    return _money(l2.l2_flow_quadrants(deals, quotes), "total_net_flow", "q2_accumulation")


_BIG = "(amount >= 1e6 OR volume >= 1e5)"
_FUNDS = {"main_net_inflow": f"sum(amount * sign) FILTER {_BIG}", "retail_funds_net_inflow": f"sum(amount * sign) FILTER (NOT {_BIG})", "main_funds_buy_amount": f"sum(amount) FILTER ({_BIG} AND side = 0)", "main_funds_sell_amount": f"sum(amount) FILTER ({_BIG} AND side = 1)", "mid_tier_net_inflow": "sum(amount * sign) FILTER (amount >= 2e5 AND amount < 1e6)", "open_auction_net_inflow": "sum(amount * sign) FILTER (time < 34200000)", "close_auction_net_inflow": "sum(amount * sign) FILTER (time > 53820000)"}


@query(f"WITH {MARKED}, r AS (SELECT *, row_number() OVER ({BY} ORDER BY amount, seq) AS i FROM clean), f AS ({_sql(_FUNDS | {'trade_size_gini': 'CASE WHEN count(*) > 1 THEN (2 * sum(i * amount) - (count(*) + 1) * sum(amount)) / (count(*) * sum(amount)) END', 'clean_records': 'count(*)', 'large_order_records': f'count(*) FILTER {_BIG}'}, 'r', tuple(_FUNDS), ('clean_records', 'large_order_records'))}) SELECT f.*, total_records FROM f JOIN (SELECT {KEYS}, count(*) AS total_records FROM m GROUP BY ALL) USING ({KEYS})")
def l2_funds(spark, d):
    deals, _, quotes = level2(spark, d)
    return _money(l2.l2_funds(deals, quotes), *_FUNDS)


_LINKED = " ".join(f"LEFT JOIN i {t} ON {t}.symbol = d.symbol AND {t}.trade_date = d.trade_date AND {t}.id = d.{c}" for t, c in (("b", "buy_id"), ("s", "sell_id")))
_QUOTED = {"crossed_quote_ratio": "avg((bid > 0 AND bid > ask)::INTEGER)", "locked_quote_ratio": "avg((bid > 0 AND bid = ask)::INTEGER)", "valid_spread_ratio": "avg(valid::INTEGER)", "missing_top5_quote_ratio": "avg((bid = 0)::INTEGER)", "nonnegative_depth_ratio": "1.0", "snapshot_records": "count(*)"}


@query(f"WITH {LEVEL2}, i AS (SELECT DISTINCT {KEYS}, id FROM orders2), l AS (SELECT d.*, b.id IS NOT NULL OR s.id IS NOT NULL AS linked FROM deals d {_LINKED}), dd AS (SELECT {KEYS}, count(*) AS deal_records, count(*) FILTER (side IN (0, 1)) AS trades, count(*) FILTER (side IN (0, 1) AND time BETWEEN 34200000 AND 53820000) AS continuous, count(*) FILTER (side IN (0, 1) AND linked) AS matched FROM l GROUP BY ALL), o AS (SELECT {KEYS}, count(*) AS order_records FROM orders2 GROUP BY ALL), qq AS ({_sql(_QUOTED, 'q', counts=('snapshot_records',))}) SELECT {KEYS}, true AS has_deal, true AS has_order, true AS has_snapshot, deal_records, order_records, qq.* EXCLUDE ({KEYS}), 1.0::DOUBLE AS order_link_coverage, {rnd('continuous / trades')} AS continuous_auction_ratio, {rnd('matched / trades')} AS deal_order_match_ratio, {rnd('(trades - matched) / trades')} AS orphan_execution_ratio FROM dd JOIN o USING ({KEYS}) JOIN qq USING ({KEYS})")
def l2_quality(spark, d):
    return _all(l2.l2_quality(*level2(spark, d)))


@query(f"WITH {LEVEL2}, u AS (SELECT {KEYS}, time // 60000 AS minute, CASE WHEN buy THEN volume ELSE 0 END AS cb, CASE WHEN buy THEN 0 ELSE volume END AS cs, 0 AS tb, 0 AS ts FROM orders2 WHERE type < 0 UNION ALL SELECT {KEYS}, time // 60000, 0, 0, CASE WHEN side = 0 THEN volume ELSE 0 END, CASE WHEN side = 1 THEN volume ELSE 0 END FROM e), g AS (SELECT {KEYS}, minute, CASE WHEN sum(tb) <> 0 THEN sum(cb) / sum(tb) END AS buy, CASE WHEN sum(ts) <> 0 THEN sum(cs) / sum(ts) END AS sell FROM u GROUP BY ALL), f AS (SELECT c.symbol, c.trade_date, avg(CASE WHEN c.buy THEN qb.bid - c.price ELSE c.price - qb.ask END / 0.01::DOUBLE) AS far FROM (SELECT * FROM orders2 WHERE type < 0) c ASOF JOIN qb ON c.symbol = qb.symbol AND c.trade_date = qb.trade_date AND c.time >= qb.time GROUP BY ALL) SELECT g.symbol, g.trade_date, count(*) FILTER (coalesce(sell, 0) > 5 AND coalesce(buy, 0) < 2 OR coalesce(buy, 0) > 5 AND coalesce(sell, 0) < 2) AS spoof_count, count(*) FILTER (coalesce(sell, 0) > 5 AND coalesce(buy, 0) < 2) AS fake_pressure_count, count(*) FILTER (coalesce(buy, 0) > 5 AND coalesce(sell, 0) < 2) AS fake_support_count, {rnd('coalesce(avg(sell), 0)')} AS mean_sell_otr, {rnd('coalesce(avg(buy), 0)')} AS mean_buy_otr, {rnd('any_value(far)')} AS mean_cancel_distance_ticks FROM g JOIN f ON f.symbol = g.symbol AND f.trade_date = g.trade_date GROUP BY ALL")
def l2_spoofing(spark, d):
    return _all(l2.l2_spoofing(*level2(spark, d)))


_LIFE = {"cancel_without_fill_ratio": "avg((tc IS NOT NULL AND NOT capped > 0)::INTEGER)", "partial_fill_ratio": "avg((tc IS NOT NULL AND capped > 0 AND capped < given)::INTEGER)", "median_cancel_time_ms": "median(tc - t0) FILTER (tc >= t0)", "median_first_fill_time_ms": "median(tf - t0) FILTER (tf >= t0)", "passive_fill_ratio": "sum(passive) / sum(vf)", "large_order_fill_rate": "sum(capped) FILTER (given * price >= 1e6) / sum(given) FILTER (given * price >= 1e6)", "partial_cancel_ratio": "avg(coalesce(vc > 0 AND vc < given, false)::INTEGER)"}


@query(f"WITH {LEVEL2}, s AS (SELECT {KEYS}, id, min(time) AS t0, first(price ORDER BY time, seq) AS price, first(buy ORDER BY time, seq) AS buy, sum(volume) AS given FROM orders2 WHERE type >= 0 GROUP BY {KEYS}, id), c AS (SELECT {KEYS}, id, min(time) AS tc, sum(volume) AS vc FROM orders2 WHERE type < 0 GROUP BY ALL), f0 AS (SELECT {KEYS}, buy_id AS id, true AS buy, time, volume, CASE WHEN side = 1 THEN volume ELSE 0 END AS passive FROM e UNION ALL SELECT {KEYS}, sell_id, false, time, volume, CASE WHEN side = 0 THEN volume ELSE 0 END FROM e WHERE sell_id IS NOT NULL), f AS (SELECT {KEYS}, id, buy, min(time) AS tf, sum(volume) AS vf, sum(passive) AS passive FROM f0 GROUP BY ALL), l AS (SELECT *, least(given, coalesce(vf, 0)) AS capped FROM s LEFT JOIN c USING ({KEYS}, id) LEFT JOIN f USING ({KEYS}, id, buy)), n AS (SELECT {KEYS}, buy, time, first(price ORDER BY seq) AS price FROM orders2 WHERE type >= 0 GROUP BY ALL), r AS (SELECT c.symbol, c.trade_date, avg(coalesce(n.time - c.time <= 1000 AND abs(n.price - c.price) <= 0.02, false)::INTEGER) AS like FROM (SELECT * FROM orders2 WHERE type < 0) c ASOF LEFT JOIN n ON c.symbol = n.symbol AND c.trade_date = n.trade_date AND c.buy = n.buy AND c.time <= n.time GROUP BY ALL), a AS ({_sql(_LIFE, 'l')}) SELECT a.*, {rnd('r.like')} AS replace_like_ratio FROM a JOIN r USING ({KEYS})".replace(" AS like", " AS alike").replace("r.like", "r.alike"))
def l2_lifecycle(spark, d):
    deals, orders, _ = level2(spark, d)
    return _all(l2.l2_lifecycle(deals, orders))


_VALID = {"mean_spread": "avg((ask - bid) / bid)", "mean_obi_top5": "avg((bid5 - ask5) / depth5)", "obi_top1_mean": "avg((bid1 - ask1) / depth1)", "obi_top5_std": "stddev_pop((bid5 - ask5) / depth5)", "obi_top1_std": "stddev_pop((bid1 - ask1) / depth1)", "depth_top1_mean": "avg(depth1)", "depth_top5_mean": "avg(depth5)", "depth_slope": "avg((-2 * l0 - l1 + l3 + 2 * l4) / 10 / l0)", "depth_convexity": "avg((l2 - 2 * l1 + l0 + l3 - 2 * l2 + l1 + l4 - 2 * l3 + l2) / 3 / l0)", "microprice_minus_mid_mean": "avg(((ask * bid1 + bid * ask1) / depth1 - mid) / mid)", "microprice_minus_mid_std": "stddev_pop(((ask * bid1 + bid * ask1) / depth1 - mid) / mid)"}
_FLOW = {"ofi_mean": "avg(ofi)", "ofi_std": "stddev_pop(ofi)", "ofi_persistence": "corr(before, ofi)", "ofi_positive_ratio": "count(*) FILTER (ofi > 0) / count(*) FILTER (ofi <> 0)", "ofi_negative_ratio": "count(*) FILTER (ofi < 0) / count(*) FILTER (ofi <> 0)"}
_HIT = {"effective_spread_mean": "avg(2 * abs(price - m0) / m0)", "realized_spread_1m": "avg(2 * dir * (price - m60) / m0)", "impact_30s": "avg(dir * (m30 - m0) / m0)", "impact_5m": "avg(dir * (m300 - m0) / m0)"}
_DRY = {"amihud_illiquidity": "abs(last(price ORDER BY time, seq) - first(price ORDER BY time, seq)) / first(price ORDER BY time, seq) / (sum(amount) / 1e9)"}
_OFI = f"fl AS (SELECT *, lag(ofi) OVER {IN_TIME} AS before FROM (SELECT *, CASE WHEN valid THEN coalesce(bid1 - lag(bid1) OVER {IN_TIME} - (ask1 - lag(ask1) OVER {IN_TIME}), 0) ELSE 0 END AS ofi FROM q))"


def _later(source: str, seconds: int, to: str, table: str = "vf") -> str:
    return f"SELECT t.*, v.{'mid' if table.startswith('v') else 'depth1'} AS {to} FROM ({source}) t ASOF LEFT JOIN {table} v ON t.symbol = v.symbol AND t.trade_date = v.trade_date AND t.time + {seconds * 1000} <= v.time"


_MIDS = f"SELECT d.*, CASE WHEN side = 0 THEN 1 ELSE -1 END AS dir, v.mid AS m0 FROM deals d ASOF LEFT JOIN vb v ON d.symbol = v.symbol AND d.trade_date = v.trade_date AND d.time >= v.time"


@query(f"WITH {LEVEL2}, {_OFI}, h AS ({_later(_later(_later(_MIDS, 30, 'm30'), 60, 'm60'), 300, 'm300')}), df AS (SELECT {KEYS}, time, arg_min(depth1, seq) AS depth1 FROM q WHERE valid GROUP BY ALL), dr AS (SELECT * FROM (SELECT *, lag(depth1) OVER {IN_TIME} AS was, count(*) OVER ({BY}) AS n FROM q WHERE valid) WHERE n >= 3 AND depth1 < was), re AS ({_later('SELECT symbol, trade_date, time, depth1 AS own, was FROM dr', 30, 'depth30', 'df')}), a AS ({_sql(_VALID, '(SELECT * FROM q WHERE valid)')}), b AS ({_sql(_FLOW, 'fl')}), c AS ({_sql(_HIT, 'h')}), dd AS ({_sql(_DRY, 'deals')}), ee AS ({_sql({'orderbook_replenish_speed': 'avg((depth30 - own) / was) / 30'}, 're')}), nn AS ({_sql({'near_touch_cancel_add_ratio': 'count(*) FILTER (type < 0) / count(*) FILTER (type >= 0)'}, '(SELECT * FROM near WHERE near_touch)')}) SELECT * FROM a JOIN b USING ({KEYS}) JOIN c USING ({KEYS}) JOIN dd USING ({KEYS}) JOIN ee USING ({KEYS}) JOIN nn USING ({KEYS})")
def l2_microstructure(spark, d):
    return _all(l2.l2_microstructure(*_near(spark, d)))


_STATE = {"best_quote_depletion_rate": "avg((bid1 <= pb * 0.2 OR ask1 <= pa * 0.2)::INTEGER) FILTER (pb IS NOT NULL)", "depth_turnover_top5": "avg(abs(depth5 - p5)) / avg(depth5)", "book_pressure_decay": "CASE WHEN count(*) >= 3 THEN least(greatest(1 - corr(pp, bp), 0), 2) END"}


@query(f"WITH {LEVEL2}, z AS (SELECT *, (bid5 - ask5) / depth5 AS bp, lag(bid1) OVER {IN_TIME} AS pb, lag(ask1) OVER {IN_TIME} AS pa, lag(depth5) OVER {IN_TIME} AS p5, lag((bid5 - ask5) / depth5) OVER {IN_TIME} AS pp, lag(depth1) OVER {IN_TIME} AS was, lag(time) OVER {IN_TIME} AS pt, count(*) OVER ({BY}) AS n FROM q), df AS (SELECT {KEYS}, time, arg_min(depth1, seq) AS depth1 FROM q GROUP BY ALL), re AS ({_later('SELECT symbol, trade_date, time, depth1 AS own, was, pt, n FROM z WHERE was > depth1', 5, 'depth5s', 'df')}), ex AS (SELECT d.symbol, d.trade_date, sum(volume) AS done FROM deals d ASOF JOIN qb ON d.symbol = qb.symbol AND d.trade_date = qb.trade_date AND d.time >= qb.time WHERE bid > 0 AND ask > 0 AND (price >= ask OR price <= bid) GROUP BY ALL), nr AS (SELECT {KEYS}, coalesce(sum(volume) FILTER (type >= 0), 0) AS added, coalesce(sum(volume) FILTER (type < 0), 0) AS gone FROM near WHERE near_touch GROUP BY ALL), a AS ({_sql(_STATE, 'z')}), b AS ({_sql({'depth_recovery_5s': 'avg(least(greatest((depth5s - own) / (was - own), 0), 1)) FILTER (n >= 3 AND depth5s IS NOT NULL)', 'queue_depletion_speed': 'avg((was - own) / was / ((time - pt) / 1000)) FILTER (time <> pt)'}, 're')}) SELECT a.*, b.* EXCLUDE ({KEYS}), {rnd('added / (gone + done)')} AS add_cancel_execute_ratio_top1 FROM a JOIN b USING ({KEYS}) JOIN ex USING ({KEYS}) JOIN nr USING ({KEYS})")
def l2_lob_transition(spark, d):
    return _all(l2.l2_lob_transition(*_near(spark, d)))


_HALF = {"open_30m_spread_mean": "avg((ask - bid) / bid) FILTER (valid AND time >= 34200000 AND time < 36000000)", "close_30m_obi_mean": "avg((bid5 - ask5) / depth5) FILTER (valid AND time BETWEEN 52200000 AND 54000000)", "midday_liquidity_drop": "1 - avg(depth5) FILTER (valid AND time >= 36000000 AND time < 52200000) / avg(depth5) FILTER (valid AND time >= 34200000 AND time < 36000000)", "afternoon_ofi_reversal": "(sign(avg(ofi) FILTER (time BETWEEN 34200000 AND 41400000)) * sign(avg(ofi) FILTER (time BETWEEN 46800000 AND 54000000)) < 0)::INTEGER::DOUBLE"}


@query(f"WITH {LEVEL2}, {_OFI}, h AS ({_later(_MIDS, 30, 'm30')}), a AS ({_sql(_HALF, 'fl')}), b AS ({_sql({'open_close_vol_ratio': 'sum(volume) FILTER (time >= 34200000 AND time < 36000000) / sum(volume) FILTER (time BETWEEN 52200000 AND 54000000)', 'close_30m_impact_mean': 'avg(dir * (m30 - m0) / m0) FILTER (time BETWEEN 52200000 AND 54000000)'}, 'h')}) SELECT * FROM a JOIN b USING ({KEYS})")
def l2_intraday_segments(spark, d):
    deals, _, quotes = level2(spark, d)
    return _all(l2.l2_intraday_segments(deals, quotes))


_SIGNS = {"aggressor_label_match_ratio": "avg((guess = sign)::INTEGER)", "mid_cross_match_ratio": "avg((guess = sign)::INTEGER) FILTER (inside)", "tick_rule_fallback_ratio": "avg(coalesce(inside, false)::INTEGER)", "unclassified_trade_ratio": "avg((guess IS NULL)::INTEGER)"}


@query(f"WITH {LEVEL2}, t AS (SELECT *, last_value(CASE WHEN move <> 0 THEN sign(move) END IGNORE NULLS) OVER ({BY} ORDER BY time, seq ROWS UNBOUNDED PRECEDING) AS tick FROM (SELECT *, price - lag(price) OVER {IN_TIME} AS move FROM e)), j AS (SELECT t.*, valid AND price < ask AND price > bid AS inside, CASE WHEN valid AND price >= ask THEN 1 WHEN valid AND price <= bid THEN -1 WHEN valid THEN tick END AS guess FROM t ASOF LEFT JOIN qb ON t.symbol = qb.symbol AND t.trade_date = qb.trade_date AND t.time >= qb.time) " + _sql(_SIGNS, "j"))
def l2_trade_sign(spark, d):
    deals, _, quotes = level2(spark, d)
    return _all(l2.l2_trade_sign(deals, quotes))


@query(f"WITH {LEVEL2}, sw AS (SELECT {KEYS}, sum(v) AS swept, avg(n) AS each FROM (SELECT {KEYS}, buy_id || tail AS b, sum(amount) AS a, sum(volume) AS v, count(*) AS n FROM e WHERE side = 0 GROUP BY ALL) WHERE n >= 3 AND a >= 5e5 GROUP BY ALL), t AS (SELECT {KEYS}, sum(volume) AS volume, coalesce(sum(amount) FILTER (side = 0 AND amount >= 1e6) / sum(volume) FILTER (side = 0 AND amount >= 1e6), 0) AS vwap FROM e GROUP BY ALL), f0 AS (SELECT *, time // 300000 AS w, coalesce(tb - lag(tb) OVER {IN_TIME} - (ta - lag(ta) OVER {IN_TIME}), 0) AS f FROM q), f1 AS (SELECT *, sum(f) OVER (PARTITION BY symbol, trade_date, w ORDER BY time, seq ROWS UNBOUNDED PRECEDING) AS c, row_number() OVER (PARTITION BY symbol, trade_date, w ORDER BY time, seq) AS i FROM f0), sl AS (SELECT {KEYS}, avg(s) AS slope FROM (SELECT {KEYS}, w, covar_pop(i, c) / var_pop(i) AS s, count(*) AS n FROM f1 GROUP BY ALL) WHERE n >= 30 GROUP BY ALL), b AS (SELECT {KEYS}, count(*) AS quotes, sum(bid3) / sum(ask5) * 0.95 AS escort, last(bid3 - ask5 ORDER BY time, seq) - first(bid3 - ask5 ORDER BY time, seq) AS gained, last(last ORDER BY time, seq) AS close FROM q GROUP BY ALL), y AS (SELECT {KEYS}, coalesce(swept / volume * ln(1 + each), 0) AS pulse, escort, CASE WHEN vwap > 0 AND gained > 0 THEN tanh(gained / 1e6) * greatest((close - vwap) / vwap, 0) * 100 ELSE 0 END AS precip, CASE WHEN quotes > 10 THEN tanh(coalesce(slope, 0) / 1000) ELSE 0 END AS slope FROM t JOIN b USING ({KEYS}) LEFT JOIN sw USING ({KEYS}) LEFT JOIN sl USING ({KEYS})) SELECT {KEYS}, {rnd('pulse')} AS mfi_pulse, {rnd('escort')} AS mfi_escort, {rnd('precip')} AS mfi_precip, {rnd('slope')} AS ofi_slope, {rnd('greatest(0.4 * tanh(pulse * 10) + 0.3 * tanh(escort / 2) + 0.3 * tanh(precip), 0)')} AS mfi_score FROM y")
def l2_intensity(spark, d):
    deals, _, quotes = level2(spark, d)
    return _all(l2.l2_intensity(deals, quotes))


@query()
def l2_gmm_split(spark, d):
    return _all(l2.l2_gmm_split(*level2(spark, d)), 4)


@query()
def l2_daily_features(spark, d):
    return _all(l2.l2_daily_features(*level2(spark, d), folder(spark)), 4)


_ROW = ("l2_quality", "l2_lifecycle", "l2_intraday_segments", "l2_trade_sign", "l2_lob_transition", "l2_aggression", "l2_algo_entropy", "l2_wash", "l2_spoofing", "l2_flow_quadrants", "l2_funds", "l2_microstructure", "l2_intensity")


@query("SELECT * FROM " + " JOIN ".join(f"({QUERIES[part][1]}) AS {part}{f' USING ({KEYS})' if k else ''}" for k, part in enumerate(_ROW)))
def l2_daily_row(spark, d):
    """The joined row of all groups but the mixture of minutes, from staged inputs."""
    out = l2.l2_daily_features(*level2(spark, d), folder(spark), mixed=False)
    return _money(out, *_FUNDS, "wash_amount", "clean_amount", "total_net_flow", "q2_accumulation", "algo_total_amount", "retail_total_amount")


MINUTES = f"SELECT user_id AS symbol, date_trunc('minute', ts) AS minute, {rnd('first(value ORDER BY ts, event_id)')} AS open, {rnd('max(value)')} AS high, {rnd('min(value)')} AS low, {rnd('last(value ORDER BY ts, event_id)')} AS close, count(*) AS n FROM events GROUP BY 1, 2"


def _events(spark, d):
    return table(spark, d, "events").select(F.col("user_id").alias("symbol"), F.col("event_id").alias("capture_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.lit(100.0).alias("volume"), F.when(F.col("event_type") == "click", 0).otherwise(1).alias("side"))


def _stream(spark, d):
    """The events table as a file stream."""
    raw = table(spark, d, "events")
    e = spark.readStream.schema(raw.schema).parquet(f"{d}/events.parque[t]")
    return e.select(F.col("user_id").alias("symbol"), F.col("event_id").alias("capture_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.lit(100.0).alias("volume"), F.when(F.col("event_type") == "click", 0).otherwise(1).alias("side"))


def _shown(bars):
    out = bars.select("symbol", F.col("minute").cast("timestamp_ntz").alias("minute"), "open", "high", "low", "close", "n")
    return rounded(out, "open", "high", "low", "close")


@query(MINUTES)
def minute_bars(spark, d):
    return _shown(st.minute_bars(_events(spark, d)))


@query(MINUTES)
def minute_bars_stream(spark, d):
    bars = st.minute_bars(_stream(spark, d).withWatermark("ts", "15 minutes"))
    return _shown(st.run_to_table(bars, folder(spark), "update", ["symbol", "minute"]))


@query("SELECT event_type AS k, count(DISTINCT event_id) AS n FROM events GROUP BY 1")
def stream_dedup(spark, d):
    raw = table(spark, d, "events")
    e = spark.readStream.schema(raw.schema).parquet(f"{d}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
    twice = e.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return st.run_to_table(st.deduplicated(twice, "event_id").select("event_type", "event_id"), folder(spark)).groupBy(F.col("event_type").alias("k")).agg(F.count("*").alias("n"))


def _in_batches(spark, d):
    """events as a stream of three micro-batches: two halves of the days, then repeated, late and old rows."""
    e = _events(spark, d).withColumn("symbol", F.col("symbol").cast("string"))
    last = e.groupBy("symbol").agg(F.max(F.struct("ts", *(c for c in e.columns if c not in ("symbol", "ts")))).alias("x")).select("symbol", "x.*").select(*e.columns)
    shifted = last.withColumn("ts", F.explode(F.array(*(F.col("ts") - F.make_interval(mins=F.lit(k)) for k in (0, 5, 20)))))
    half = F.to_date("ts") < F.lit("2024-01-16")
    return staged(spark, (e.where(half), e.where(~half), e.where("capture_id % 50 = 0").unionByName(shifted)), folder(spark))


#: What becomes of the rows of the third batch; those of the first two are accepted.
_LATE = """m AS (SELECT user_id, max(ts) AS l FROM events GROUP BY 1), third AS (SELECT user_id, ts, value FROM events WHERE event_id % 50 = 0 UNION ALL SELECT user_id, l - to_minutes(k), v FROM (SELECT user_id, max(ts) AS l, arg_max(value, (ts, event_id)) AS v FROM events GROUP BY 1), (SELECT unnest([0, 5, 20]) AS k)),
fate AS (SELECT t.*, CASE WHEN t.ts::DATE < l::DATE THEN 'previous_day' WHEN t.ts < l - INTERVAL 15 MINUTE THEN 'beyond_lateness' WHEN date_trunc('minute', t.ts) < date_trunc('minute', l) THEN 'older_minute_not_emitted' ELSE 'accepted' END AS counter FROM third t JOIN m USING (user_id))"""


@query(f"WITH {_LATE}, shown AS (SELECT user_id, date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1, 2), again AS (SELECT user_id, date_trunc('minute', ts) AS minute, count(*) AS n FROM fate WHERE counter = 'accepted' GROUP BY 1, 2) SELECT s.user_id AS symbol, s.minute, s.n + coalesce(g.n, 0) AS revision, s.n + coalesce(g.n, 0) AS n, (s.n + coalesce(g.n, 0)) * 100.0::DOUBLE AS volume FROM shown s LEFT JOIN again g USING (user_id, minute)")
def minute_revisions(spark, d):
    """The newest revision of every minute after repeated and late rows in a later micro-batch."""
    log = st.run_to_table(st.revised_minutes(_in_batches(spark, d)), folder(spark))
    return st.newest_revision(log).select(F.col("symbol").cast("long").alias("symbol"), F.col("minute").cast("timestamp_ntz").alias("minute"), F.col("revision").cast("long").alias("revision"), "n", "volume")


@query(f"WITH {_LATE} SELECT counter, count(*) AS n FROM (SELECT counter FROM fate UNION ALL SELECT 'accepted' FROM events) GROUP BY 1")
def late_counters(spark, d):
    log = st.run_to_table(st.revised_minutes(_in_batches(spark, d)), folder(spark))
    return log.groupBy("counter").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN event_type <> 'error' AND value > 0 THEN 'ok' ELSE 'bad' END AS parse_status, count(*) AS n FROM events GROUP BY 1")
def stream_clean_events(spark, d):
    e = table(spark, d, "events")
    line = F.concat_ws(",", "event_id", "user_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")), F.when(F.col("event_type") == "error", F.lit("x")).otherwise(F.col("value").cast("string")), F.lit("100"), F.lit("0"))
    return st.clean_events(e.select(line.alias("value"))).groupBy("parse_status").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (event_id % 3 <> 0) AS n FROM events")
def stream_future_reject(spark, d):
    e = _events(spark, d).withColumn("available", F.col("ts") - F.make_interval(secs=F.when(F.col("capture_id") % 3 == 0, 5).otherwise(0)))
    return st.not_future(e, "available").agg(F.count("*").alias("n"))


@query(f"WITH m AS (SELECT user_id AS symbol, date_trunc('minute', ts) AS minute, last(value ORDER BY ts, event_id) AS close, count(*) * 100.0::DOUBLE AS volume FROM events GROUP BY 1, 2) SELECT symbol, minute, {rnd('CASE WHEN abs(max(close) OVER w) > 1e-12 THEN close / max(close) OVER w END - 1')} AS ret_5m, {rnd('volume / avg(volume) OVER v')} AS volume_ratio FROM m WINDOW w AS (PARTITION BY symbol ORDER BY minute RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND INTERVAL 5 MINUTE PRECEDING), v AS (PARTITION BY symbol ORDER BY minute RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND INTERVAL 1 MINUTE PRECEDING)")
def minute_metrics(spark, d):
    m = st.minute_metrics(st.minute_bars(_events(spark, d)))
    return m.select("symbol", F.col("minute").cast("timestamp_ntz").alias("minute"), r("ret_5m").alias("ret_5m"), r("volume_ratio").alias("volume_ratio"))


@query(f"WITH x AS (SELECT user_id AS symbol, ts, event_id, value, event_type FROM events), b AS (SELECT symbol, ts, last(value ORDER BY event_id) AS mid FROM x WHERE event_type = 'view' GROUP BY 1, 2), j AS (SELECT x.*, mid FROM x ASOF JOIN b ON x.symbol = b.symbol AND x.ts >= b.ts WHERE event_type <> 'view') SELECT symbol, date_trunc('minute', ts) AS minute, {rnd('coalesce(sum(value) FILTER (event_type = $$error$$), 0)')} AS near_cancel, {rnd('coalesce(sum(value) FILTER (event_type <> $$error$$), 0)')} AS near_add FROM j WHERE abs(value - mid) <= 0.5 * mid GROUP BY 1, 2")
def causal_book_join(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), F.col("value").alias("price"), F.col("value").alias("amount"), (F.col("event_type") == "error").alias("cancel"), "event_type")
    out = st.near_book(e.where("event_type <> 'view'").drop("event_type"), e.where("event_type = 'view'").withColumn("mid", F.col("price")), 0.5)
    return rounded(out.select("symbol", F.col("minute").cast("timestamp_ntz").alias("minute"), "near_cancel", "near_add"), "near_cancel", "near_add")


@query(f"SELECT user_id AS symbol, CAST(ts AS DATE) AS trade_date, count(*) AS n, {rnd('max(value)')} AS high, {rnd('min(value)')} AS low FROM events GROUP BY 1, 2")
def streaming_mv(spark, d):
    by_day = lambda e: e.groupBy("symbol", "trade_date").agg(F.count("*").alias("n"), r(F.max("price")).alias("high"), r(F.min("price")).alias("low"))
    return st.refreshed_view(_stream(spark, d), folder(spark), "ts", by_day)
