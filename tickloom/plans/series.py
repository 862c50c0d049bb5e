"""Time-series windows, daily and monthly aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions import rolling as w_
from tickloom.operators import aggregates as agg
from tickloom.operators import timeseries as ts
from tickloom.plans.base import BARS, RET, bars, r, returns, rounded, table

QUERIES: dict = {}
WIN = "OVER (PARTITION BY symbol ORDER BY trade_date"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


def own_time():
    """Each symbol's rows by date; a window needs a session, so it's made on use."""
    return w_.ordered("symbol", "trade_date")


def rows_(n: int) -> str:
    return f"{WIN} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def safe(a: str, b: str) -> str:
    return f"CASE WHEN abs({b}) > 1e-12 THEN ({a}) / ({b}) END"


def rnd(expr: str, n: int = 6) -> str:
    return f"ROUND({expr}, {n}) + 0.0"


@query(f"WITH {BARS} SELECT symbol, trade_date, {rnd(f'lag(close, 2) {WIN})', 8)} AS shifted, {rnd(f'volume - lag(volume, 3) {WIN})')} AS delta3, {rnd(safe('volume', f'lag(volume) {WIN})') + ' - 1')} AS change FROM bars")
def shift_delta(spark, d):
    return bars(spark, d).select("symbol", "trade_date", r(w_.shift("close", 2, own_time()), 8).alias("shifted"), r(w_.delta("volume", 3, own_time())).alias("delta3"), r(w_.pct_change("volume", 1, own_time())).alias("change"))


@query(f"WITH {BARS} SELECT symbol, trade_date, {rnd(f'last_value(CASE WHEN volume > 25 THEN close END IGNORE NULLS) {WIN} ROWS UNBOUNDED PRECEDING)', 8)} AS filled FROM bars")
def forward_fill(spark, d):
    return bars(spark, d).withColumn("c", F.when(F.col("volume") > 25, F.col("close"))).select("symbol", "trade_date", r(w_.forward_fill("c", own_time()), 8).alias("filled"))


@query(f"WITH {BARS} SELECT symbol, trade_date, CASE WHEN count(volume) {rows_(20)} >= 10 THEN {rnd(f'avg(volume) {rows_(20)}')} END AS mean, CASE WHEN count(volume) {rows_(20)} >= 10 THEN {rnd(f'stddev_samp(volume) {rows_(20)}')} END AS std, CASE WHEN count(volume) {rows_(5)} >= 3 THEN sum(volume) {rows_(5)} END AS total, CASE WHEN count(volume) {rows_(10)} >= 5 THEN max(volume) {rows_(10)} END AS highest, CASE WHEN count(volume) {rows_(10)} >= 5 THEN min(volume) {rows_(10)} END AS lowest FROM bars")
def rolling_statistics(spark, d):
    return bars(spark, d).select("symbol", "trade_date", r(w_.rolling_mean("volume", 20, 10, own_time())).alias("mean"), r(w_.rolling_std("volume", 20, 10, own_time())).alias("std"), w_.rolling_sum("volume", 5, 3, own_time()).alias("total"), w_.rolling_max("volume", 10, 5, own_time()).alias("highest"), w_.rolling_min("volume", 10, 5, own_time()).alias("lowest"))


@query(f"WITH RECURSIVE {BARS}, n AS (SELECT symbol, trade_date, volume AS v, row_number() {WIN}) AS k FROM bars), e AS (SELECT symbol, trade_date, k, v AS ema FROM n WHERE k = 1 UNION ALL SELECT n.symbol, n.trade_date, n.k, e.ema * (1 - 2.0::DOUBLE / 6) + n.v * (2.0::DOUBLE / 6) FROM e JOIN n ON n.symbol = e.symbol AND n.k = e.k + 1) SELECT symbol, trade_date, {rnd('ema')} AS ema FROM e")
def ema(spark, d):
    return ts.ema(bars(spark, d).select("symbol", "trade_date", "volume"), ["symbol"], "trade_date", {"ema": ("volume", 5)}).select("symbol", "trade_date", r("ema").alias("ema"))


def _mean_of_rows(c: str, n: int, least: int) -> str:
    return f"CASE WHEN count({c}) {rows_(n)} >= {least} THEN avg({c}) {rows_(n)} END"


def _std_of_rows(c: str, n: int, least: int) -> str:
    return f"CASE WHEN count({c}) {rows_(n)} >= {least} THEN CASE WHEN min({c}) {rows_(n)} = max({c}) {rows_(n)} THEN 0 ELSE stddev_samp({c}) {rows_(n)} END END"


def _momentum(far: int, near: int) -> str:
    return safe(f"lag(close, {near}) {WIN})", f"lag(close, {far}) {WIN})") + " - 1"


def _kept(c: str, span: int) -> str:
    """A step of an exponential mean whose state decays over `gap` rows."""
    a, d = f"(2.0::DOUBLE / {span + 1})", f"(1 - 2.0::DOUBLE / {span + 1}) ** e.gap"
    return f"CASE WHEN e.{c} IS NULL THEN n.v WHEN n.v IS NULL THEN e.{c} ELSE (e.{c} * {d} + n.v * {a}) / ({d} + {a}) END"


#: What bars lack of a daily table, in Spark and in SQL.
DAILY_INPUTS = {"turnover": "sqrt(volume)", "market_value": "close * 100", "pe": "CASE WHEN symbol % 5 = 0 THEN -1 ELSE close / 10 END", "pb": "close / 100", "ps": "close / 50", "up_limit": "CASE WHEN symbol % 4 = 0 THEN high ELSE close * 1.1 END", "down_limit": "CASE WHEN symbol % 4 = 1 THEN low ELSE close * 0.9 END", "free_market_value": "close * 60", "is_st": "CASE WHEN symbol % 7 = 0 THEN 1 ELSE 0 END", "is_suspended": "CASE WHEN volume < 3 THEN 1 ELSE 0 END"}
_STRENGTH = f"((100 - 100 / (1 + ({_mean_of_rows('rise', 14, 7)}) / (({_mean_of_rows('fell', 14, 7)}) + 1e-12))) - 50) / 50"
_BAND = f"({safe('close - (' + _mean_of_rows('close', 20, 10) + ') + 2 * (' + _std_of_rows('close', 20, 10) + ')', '4 * (' + _std_of_rows('close', 20, 10) + ')')})"
_TREND = safe(_mean_of_rows("volume", 5, 3), _mean_of_rows("volume", 20, 10)) + " - 1"
_DAILY = {
    **{f"ret_{n}": f"ret_{n}" for n in (1, 3, 5, 20, 60, 120)},
    "volume_momentum": "vm",
    **{f"vol_{n}": _std_of_rows("ret_1", n, max(2, n // 2)) for n in (20, 60, 120, 252)},
    "downside_vol_60": _std_of_rows("down", 60, 10),
    **{f"amount_mean_{n}": f"({_mean_of_rows('amount', n, least)}) / 12345.67" for n, least in ((5, 3), (20, 10), (60, 30))},
    "turnover_mean_20": _mean_of_rows("turnover", 20, 10),
    "abnormal_turnover": f"turnover / ({_mean_of_rows('turnover', 20, 10)})",
    "liquidity_shock": f"amount / ({_mean_of_rows('amount', 20, 10)})",
    "log_size": "ln(market_value)",
    **{f"{name}_to_price": safe("1", c) for name, c in (("book", "pb"), ("earnings", "pe"), ("sales", "ps"))},
    "momentum_12_1": _momentum(252, 21),
    "momentum_6_1": _momentum(126, 21),
    "momentum_12_2": _momentum(252, 42),
    "amihud_20": f"({_mean_of_rows('illiq', 20, 10)}) * 1e6",
    "rsi_14": safe(_mean_of_rows("gain", 14, 7), f"({_mean_of_rows('gain', 14, 7)}) + ({_mean_of_rows('loss', 14, 7)})"),
    "ma_trend": f"({_mean_of_rows('close', 5, 3)}) / ({_mean_of_rows('close', 20, 10)}) - 1",
    "acceleration": "ret_5 - ret_20 / 4",
    "bollinger_position": f"(close - ({_mean_of_rows('close', 20, 10)})) / nullif(2 * ({_std_of_rows('close', 20, 10)}), 0)",
    "divergence": "ret_5 - vm",
    "rotation": "CASE WHEN (ret_5 IS NOT NULL)::INTEGER + (ret_20 IS NOT NULL)::INTEGER + (ret_60 IS NOT NULL)::INTEGER >= 2 THEN list_avg([ret_5, ret_20, ret_60]) END",
    "limit_up_distance": "up_limit / close - 1",
    "limit_down_distance": "1 - down_limit / close",
    "ret": "ret_1",
    **{f"downside_{n}": _std_of_rows("fall", n, n // 2) for n in (60, 252)},
    "amount_mean_3": f"({_mean_of_rows('amount', 3, 1)}) / 12345.67",
    "turnover_21": _mean_of_rows("turnover", 21, 15),
    "turnover_252": _mean_of_rows("turnover", 252, 120),
    "abturnover": safe(_mean_of_rows("turnover", 21, 15), _mean_of_rows("turnover", 252, 120)),
    "log_free_size": "CASE WHEN free_market_value > 0 THEN ln(free_market_value) END",
    "momentum_12m": _momentum(252, 21),
    "rsi_strength": _STRENGTH,
    "price_acceleration": "ret_5 - ret_20",
    "macd_strength": safe("fast - slow - signal", "slow"),
    "bollinger_band": f"CASE WHEN {_BAND} IS NOT NULL THEN least(greatest({_BAND}, 0), 1) END",
    "volume_trend": f"({_TREND}) / 1.234567",
    "price_volume_divergence": f"ret_20 - ({_TREND})",
    "rotation_composite": f"0.3 * ({_STRENGTH}) + 0.4 * ret_20 + 0.3 * ({_TREND})",
    "distance_to_down_limit": safe("close", "down_limit") + " - 1",
    "drawdown_20": f"CASE WHEN count(close) {rows_(20)} >= 10 THEN close / (max(close) {rows_(20)}) - 1 END",
}
_GONE = ", ".join(f"{safe('filled', f'lag(filled, {n}) {WIN})')} - 1 AS ret_{n}" for n in (1, 3, 5, 20, 60, 120))
FEATURES = f"""WITH RECURSIVE {RET}, p AS (SELECT * EXCLUDE (ret_1), last_value(close IGNORE NULLS) {WIN} ROWS UNBOUNDED PRECEDING) AS filled, row_number() OVER (ORDER BY symbol, trade_date) AS id, row_number() {WIN}) AS k FROM ret), g AS (SELECT *, {_GONE} FROM p),
n AS (SELECT id, k, close AS v FROM p),
e AS (SELECT id, k, 1 AS gap, v AS fast, v AS slow, v - v AS signal FROM n WHERE k = 1
  UNION ALL SELECT id, k, gap, fast, slow, CASE WHEN signal IS NULL THEN fast - slow ELSE signal * (1 - 2.0::DOUBLE / 10) + (fast - slow) * (2.0::DOUBLE / 10) END FROM (
    SELECT n.id, n.k, CASE WHEN n.v IS NULL AND e.fast IS NOT NULL THEN e.gap + 1 ELSE 1 END AS gap, {_kept('fast', 12)} AS fast, {_kept('slow', 26)} AS slow, e.signal FROM e JOIN n ON n.id = e.id + 1 AND n.k = e.k + 1)),
f AS (SELECT *, {', '.join(f'{x} AS {c}' for c, x in DAILY_INPUTS.items())}, {safe('volume', f'lag(volume, 5) {WIN})')} - 1 AS vm, abs(ret_1) / amount AS illiq, CASE WHEN ret_1 < 0 THEN ret_1 END AS down, CASE WHEN ret_1 < 0 THEN ret_1 WHEN ret_1 IS NOT NULL THEN 0 END AS fall, greatest(close - prev, 0) AS gain, greatest(prev - close, 0) AS loss, CASE WHEN close - prev IS NOT NULL THEN greatest(close - prev, 0) END AS rise, CASE WHEN close - prev IS NOT NULL THEN greatest(prev - close, 0) END AS fell FROM g JOIN (SELECT id, fast, slow, signal FROM e) USING (id))
SELECT symbol, trade_date, {', '.join(f'{rnd(x)} AS {c}' for c, x in _DAILY.items())}, {rnd('close', 8)} AS price, {rnd('open', 8)} AS open_price, (high >= up_limit - 1e-6 OR low <= down_limit + 1e-6)::INTEGER AS limit_touch, (volume > 0)::INTEGER AS tradable,
  coalesce(high >= up_limit * (1 - 1e-6), false)::INTEGER AS limit_touch_up, coalesce(low <= down_limit * (1 + 1e-6), false)::INTEGER AS limit_touch_down, coalesce(is_st = 0 AND is_suspended = 0 AND amount > 0, false)::INTEGER AS is_tradable FROM f"""


@query(FEATURES)
def daily_features(spark, d):
    """All daily inputs of factors."""
    f = ts.daily_windows(bars(spark, d).withColumns({c: F.expr(x) for c, x in DAILY_INPUTS.items()}))
    f = f.withColumns({"amihud_20": F.col("amihud_20") * 1e6, "volume_trend": F.col("volume_trend") / 1.234567} | {f"amount_mean_{n}": F.col(f"amount_mean_{n}") / 12345.67 for n in (3, 5, 20, 60)})
    shown = [c for c in _DAILY if c != "macd_strength"]
    f = rounded(rounded(f, *shown), "price", "open_price", n=8)
    f = f.select("symbol", "trade_date", *shown, "price", "open_price", "limit_touch", "tradable", "limit_touch_up", "limit_touch_down", "is_tradable", "close")
    return rounded(ts.with_macd(f), "macd_strength").drop("close")  # rounded before, so that fewer columns pass the means


@query(f"WITH {BARS} SELECT symbol, trade_date, volume AS effective_volume FROM bars")
def effective_volume(spark, d):
    return ts.effective_volume(bars(spark, d)).select("symbol", "trade_date", "effective_volume")


@query(f"WITH {BARS}, z AS (SELECT symbol, trade_date, CASE WHEN stddev_pop(ln(amount)) OVER d > 1e-12 THEN ((ln(amount) - avg(ln(amount)) OVER d) / stddev_pop(ln(amount)) OVER d) ** 3 END AS c FROM bars WINDOW d AS (PARTITION BY trade_date)) SELECT symbol, trade_date, {rnd('c - avg(c) OVER (PARTITION BY trade_date)')} AS nonlinear_size FROM z")
def nonlinear_size(spark, d):
    return ts.nonlinear_size(bars(spark, d).withColumn("log_size", F.log("amount"))).select("symbol", "trade_date", r("nonlinear_size").alias("nonlinear_size"))


@query(f"WITH {RET}, m AS (SELECT trade_date, avg(ret_1) AS m FROM ret GROUP BY 1), x AS (SELECT symbol, trade_date, ret_1 AS y, CASE WHEN ret_1 IS NOT NULL THEN m END AS x FROM ret JOIN m USING (trade_date)), c AS (SELECT symbol, trade_date, count(y) {rows_(252)} AS n, avg(x * y) {rows_(252)} - avg(x) {rows_(252)} * avg(y) {rows_(252)} AS cov, avg(x * x) {rows_(252)} - avg(x) {rows_(252)} ** 2 AS var, avg(y * y) {rows_(252)} - avg(y) {rows_(252)} ** 2 AS own FROM x) SELECT symbol, trade_date, CASE WHEN n >= 60 THEN {rnd('cov / var', 5)} END AS beta, CASE WHEN n >= 60 THEN {rnd('sqrt(greatest(own - cov / var * cov, 0))', 5)} END AS residual_vol FROM c")
def market_beta(spark, d):
    return ts.market_risk(returns(spark, d)).select("symbol", "trade_date", r("beta_252", 5).alias("beta"), r("residual_vol_252", 5).alias("residual_vol"))


@query(f"WITH {BARS} SELECT symbol, trade_date, date_diff('day', min(trade_date) OVER (PARTITION BY symbol), trade_date) AS listing_days FROM bars")
def listing_days(spark, d):
    b = bars(spark, d).withColumn("listed", F.min("trade_date").over(Window.partitionBy("symbol")))
    return ts.listing_days(b, "listed").select("symbol", "trade_date", F.col("listing_days").cast("long").alias("listing_days"))


@query(f"WITH {RET}, m AS (SELECT trade_date, median(ret_1) AS m FROM ret GROUP BY 1), x AS (SELECT symbol, trade_date, ret_1 AS y, CASE WHEN ret_1 IS NOT NULL THEN m END AS x FROM ret JOIN m USING (trade_date)), c AS (SELECT symbol, trade_date, count(y) {rows_(60)} AS n, avg(x * y) {rows_(60)} - avg(x) {rows_(60)} * avg(y) {rows_(60)} AS cov, avg(x * x) {rows_(60)} - avg(x) {rows_(60)} ** 2 AS var FROM x) SELECT symbol, trade_date, CASE WHEN n >= 30 THEN {rnd('cov / var', 5)} END AS beta FROM c")
def etf_beta60(spark, d):
    return ts.etf_beta(returns(spark, d).withColumnRenamed("ret_1", "ret")).select("symbol", "trade_date", r("beta_60", 5).alias("beta"))


@query(f"WITH {RET}, x AS (SELECT *, CASE WHEN count(close) {rows_(20)} >= 10 THEN close / (max(close) {rows_(20)}) - 1 END AS dd FROM ret) SELECT symbol, trade_date, {rnd('ret_1')} AS ret, CASE WHEN count(amount) {rows_(20)} >= 10 THEN {rnd(f'amount / avg(amount) {rows_(20)}')} END AS amount_ratio, CASE WHEN count(ret_1) {rows_(5)} >= 3 THEN {rnd(f'stddev_samp(ret_1) {rows_(5)}')} END AS vol_5, CASE WHEN count(dd) {rows_(5)} >= 3 THEN {rnd(f'min(dd) {rows_(5)}')} END AS recent_drawdown FROM x")
def etf_market_features(spark, d):
    f = ts.etf_market_features(bars(spark, d))
    return rounded(f.select("symbol", "trade_date", "ret", "amount_ratio", "vol_5", "recent_drawdown"), "ret", "amount_ratio", "vol_5", "recent_drawdown")


@query(f"WITH {BARS}, s AS (SELECT symbol, trade_date, close, last_value(CASE WHEN volume > 10 THEN volume * 100 END IGNORE NULLS) {WIN} ROWS UNBOUNDED PRECEDING) AS shares FROM bars), f AS (SELECT *, (shares - lag(shares) {WIN})) * close AS flow, shares * close AS aum FROM s) SELECT symbol, trade_date, shares, {rnd('aum', 4)} AS aum, {rnd(safe('shares', f'lag(shares, 5) {WIN})') + ' - 1')} AS share_change_5, CASE WHEN count(flow) {rows_(5)} >= 3 AND abs(aum) > 1e-12 THEN {rnd(f'(sum(flow) {rows_(5)}) / aum')} END AS flow_intensity, CASE WHEN count(flow) {rows_(5)} >= 3 THEN {rnd(f'avg(sign(flow)) {rows_(5)}')} END AS flow_persistence FROM f")
def etf_share_flow(spark, d):
    b = bars(spark, d).select("symbol", "trade_date", "close", F.when(F.col("volume") > 10, F.col("volume") * 100).alias("shares"))
    f = ts.etf_share_flow(b).select("symbol", "trade_date", "shares", r("aum", 4).alias("aum"), "share_change_5", "flow_intensity", "flow_persistence")
    return rounded(f, "share_change_5", "flow_intensity", "flow_persistence")


@query(f"WITH {RET}, t AS (SELECT symbol, trade_date, CASE WHEN count(*) {rows_(20)} >= 10 THEN avg(volume) {rows_(20)} END AS t FROM bars WHERE volume > 20) SELECT r.symbol, r.trade_date, CASE WHEN count(ret_1) OVER w >= 120 THEN {rnd('exp(sum(ln(1 + ret_1)) OVER w) - 1', 4)} END AS ret_252, {rnd('t')} AS turnover_20 FROM ret r LEFT JOIN t USING (symbol, trade_date) WINDOW w AS (PARTITION BY r.symbol ORDER BY r.trade_date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)")
def csi_temporal(spark, d):
    b = bars(spark, d)
    t = b.where("volume > 20").select("symbol", "trade_date", F.col("volume").alias("turnover"))
    return ts.csi_temporal(b, t).select("symbol", "trade_date", r("ret_252", 4).alias("ret_252"), r("turnover_20").alias("turnover_20"))


_PRICES = ("open", "high", "low", "close")
_SPLIT = "CASE WHEN day(trade_date) <= 7 AND month(trade_date) = 1 THEN 1.37 ELSE 1 END::DOUBLE"


@query(f"""WITH {BARS}, q AS (SELECT symbol, trade_date, volume, {', '.join(f'{c} * sqrt(0.5) AS {c}' for c in _PRICES)}, {_SPLIT} AS split, close * sqrt(0.5) * sqrt(0.83 + symbol % 10 / 100.0) AS adjclose FROM bars), x AS (SELECT *, coalesce(exp(sum(ln(split)) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)), 1) AS factor FROM q)
SELECT symbol, trade_date, {rnd('factor', 4)} AS factor, {rnd('volume / factor')} AS volume, {', '.join(f"{rnd(f'{c} * factor', 3)} AS {c}, {rnd(f'{c} * adjclose / close')} AS adj_{c}" for c in _PRICES)} FROM x""")
def split_unadjust(spark, d):
    """Raw and adjusted prices and volumes behind several splits."""
    day = F.when((F.dayofmonth("trade_date") <= 7) & (F.month("trade_date") == 1), 1.37).otherwise(1.0)
    q = bars(spark, d).withColumns({c: F.col(c) * F.sqrt(F.lit(0.5)) for c in _PRICES}).withColumn("split", day).withColumn("adjclose", F.col("close") * F.sqrt(0.83 + F.col("symbol") % 10 / 100))
    out = rounded(rounded(ts.split_unadjust(q), *_PRICES, n=3), "volume", *(f"adj_{c}" for c in _PRICES))
    return rounded(out, "factor", n=4).select("symbol", "trade_date", "factor", "volume", *(x for c in _PRICES for x in (c, f"adj_{c}")))


#: The change of the adjustment ratio that a day's split and dividend ask for; every tenth symbol forgets its splits.
_STEP = "split * (1 + dividend / (before - dividend))"


@query(f"""WITH {BARS}, p AS (SELECT symbol, trade_date, close, lag(close) {WIN}) AS before, {_SPLIT} AS split FROM bars), q AS (SELECT *, CASE WHEN day(trade_date) = 15 THEN 0.02 * least(close, before) ELSE 0 END AS dividend FROM p),
s AS (SELECT *, CASE WHEN before IS NULL THEN 1 WHEN symbol % 10 = 0 THEN 1 + dividend / (before - dividend) ELSE {_STEP} END AS step FROM q), t AS (SELECT *, exp(sum(ln(step)) {WIN} ROWS UNBOUNDED PRECEDING)) AS adjustment FROM s)
SELECT symbol, trade_date, {rnd('CASE WHEN before IS NOT NULL THEN ' + _STEP + ' END')} AS expected_ratio, {rnd(f'adjustment / lag(adjustment) {WIN})')} AS actual_ratio, abs(adjustment / lag(adjustment) {WIN}) - {_STEP}) <= 1e-3 AS agrees FROM t""")
def corporate_action_check(spark, d):
    """Splits and dividends against the change of the adjusted close; some of them disagree."""
    w = Window.partitionBy("symbol").orderBy("trade_date")
    day = F.when((F.dayofmonth("trade_date") <= 7) & (F.month("trade_date") == 1), 1.37).otherwise(1.0)
    q = bars(spark, d).select("symbol", "trade_date", "close", F.lag("close").over(w).alias("before"), day.alias("split"))
    q = q.withColumn("dividend", F.when(F.dayofmonth("trade_date") == 15, 0.02 * F.least("close", "before")).otherwise(0.0))
    paid = 1 + F.col("dividend") / (F.col("before") - F.col("dividend"))
    step = F.when(F.col("before").isNull(), 1.0).when(F.col("symbol") % 10 == 0, paid).otherwise(F.col("split") * paid)
    q = q.withColumn("adj_close", F.col("close") * F.exp(F.sum(F.log(step)).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return rounded(ts.corporate_action_check(q).select("symbol", "trade_date", "expected_ratio", "actual_ratio", "agrees"), "expected_ratio", "actual_ratio")


QUARTERS = "q AS (SELECT o_custkey % 50 AS symbol, year(o_orderdate) AS y, last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS period, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3), c AS (SELECT symbol, y, period, sum(v) OVER (PARTITION BY symbol, y ORDER BY period) AS v FROM q)"


@query(f"WITH {QUARTERS}, x AS (SELECT *, lag(period) OVER w AS p, lag(v) OVER w AS pv FROM c WINDOW w AS (PARTITION BY symbol, y ORDER BY period)) SELECT symbol, period, {rnd('CASE WHEN p IS NULL THEN v WHEN month(period) - month(p) = 3 THEN v - pv END', 2)} AS quarter_value FROM x")
def ytd_to_quarter(spark, d):
    o = table(spark, d, "orders").groupBy(F.pmod("o_custkey", F.lit(50)).alias("symbol"), F.year("o_orderdate").alias("y"), F.last_day(F.add_months(F.date_trunc("quarter", "o_orderdate"), 2)).alias("period")).agg(F.sum("o_totalprice").alias("q"))
    c = o.withColumn("v", F.sum("q").over(Window.partitionBy("symbol", "y").orderBy("period"))).withColumn("available", F.date_add("period", 40))
    return ts.ytd_to_quarter(c, ["symbol", "y"], "period", "available", "v").select("symbol", "period", r("quarter_value", 2).alias("quarter_value"))


@query(f"WITH {BARS}, s AS (SELECT trade_date AS date, CASE symbol % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' END AS series, sum(volume) AS value FROM bars GROUP BY 1, 2), p AS (SELECT date, max(value) FILTER (series = 'A') AS a, max(value) FILTER (series = 'B') AS b, max(value) FILTER (series = 'C') AS c FROM s WHERE dayofweek(date) = 3 GROUP BY 1) SELECT date, a - b - 1000 * c AS net_liquidity FROM p WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL")
def liquidity_proxy(spark, d):
    b = bars(spark, d).groupBy(F.col("trade_date").alias("date"), (F.col("symbol") % 3).alias("k")).agg(F.sum("volume").alias("value"))
    return ts.liquidity_proxy(b.withColumn("series", F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), F.col("k").cast("int") + 1)).drop("k"))


@query(f"WITH {BARS}, p AS (SELECT trade_date, sum(volume) AS a, sum(amount) AS b FROM bars GROUP BY 1), x AS (SELECT a - lag(a, 4) OVER (ORDER BY trade_date) AS x, b - lag(b, 4) OVER (ORDER BY trade_date) AS y FROM p) SELECT count(*) AS n, {rnd('corr(x, y)')} AS corr FROM x WHERE x IS NOT NULL AND y IS NOT NULL")
def macro_change_corr(spark, d):
    b = bars(spark, d).groupBy("trade_date").agg(F.sum("volume").alias("a"), F.sum("amount").alias("b"))
    return rounded(ts.change_correlation(b, "trade_date", "a", "b"), "corr")


@query(f"WITH v AS (SELECT user_id AS symbol, CAST(ts AS DATE) AS day, count(*) AS v FROM events GROUP BY 1, 2), g AS (SELECT symbol, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM v GROUP BY 1), m AS (SELECT symbol, day, CASE WHEN count(v) OVER w >= 3 THEN avg(v) OVER w END AS a FROM g LEFT JOIN v USING (symbol, day) WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) SELECT symbol, day, {rnd('a')} AS activity, {rnd('a / first_value(a IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)')} AS normalized FROM m")
def normalized_activity(spark, d):
    v = table(spark, d, "events").groupBy(F.col("user_id").alias("symbol"), F.to_date("ts").alias("day")).agg(F.count("*").alias("v"))
    return rounded(ts.normalized_activity(v, "symbol", "day", "v", 3), "activity", "normalized")


@query(f"WITH y AS (SELECT o_custkey AS symbol, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2) SELECT symbol, y AS fiscal_year, {rnd('CASE WHEN lag(y) OVER w = y - 1 THEN v / lag(v) OVER w - 1 END')} AS v_growth FROM y WINDOW w AS (PARTITION BY symbol ORDER BY y)")
def annual_growth(spark, d):
    y = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("symbol"), F.year("o_orderdate").cast("long").alias("fiscal_year")).agg(F.sum("o_totalprice").alias("v"))
    return rounded(ts.annual_growth(y, "symbol", "fiscal_year", ["v"]).drop("v"), "v_growth")


@query(f"SELECT event_type AS key, CAST(date_trunc('month', ts) AS DATE) AS period, count(*) AS events, {rnd('sum(value)', 4)} AS total_rate FROM events GROUP BY 1, 2")
def monthly_funding(spark, d):
    return rounded(ts.period_funding(table(spark, d, "events").withColumnRenamed("event_type", "key"), "ts", "value", "key"), "total_rate", n=4)


@query(f"WITH {RET}, x AS (SELECT *, close / max(close) {WIN} ROWS UNBOUNDED PRECEDING) - 1 AS dd FROM ret), a AS (SELECT symbol, count(*) AS n, arg_max(close, trade_date) / arg_min(close, trade_date) - 1 AS t, stddev_samp(ret_1) * sqrt(252) AS v, avg(ret_1) * 252 AS m, min(dd) AS dd FROM x GROUP BY 1) SELECT symbol, n, {rnd('t')} AS total_return, {rnd('CASE WHEN n > 1 THEN (1 + t) ** (252.0 / (n - 1)) - 1 END')} AS annual_return, {rnd('v')} AS volatility, {rnd('CASE WHEN abs(v) > 1e-12 THEN m / v END')} AS sharpe, {rnd('dd')} AS max_drawdown FROM a")
def nav_metrics(spark, d):
    return rounded(ts.nav_metrics(bars(spark, d), "symbol", "trade_date", "close"), "total_return", "annual_return", "volatility", "sharpe", "max_drawdown")


@query(f"WITH {BARS}, x AS (SELECT symbol, trade_date, (volume - 25) / 1000 AS ret FROM bars), c AS (SELECT *, sum(ln(1 + ret)) {WIN} ROWS UNBOUNDED PRECEDING) - ln(1 + ret) AS c FROM x), m AS (SELECT symbol, CAST(date_trunc('month', trade_date) AS DATE) AS month, arg_min(c, trade_date) AS c FROM c GROUP BY 1, 2) SELECT a.symbol, a.month, y.years, {rnd('exp((b.c - a.c) / years) - 1')} AS cagr FROM m a CROSS JOIN (SELECT unnest([1, 2, 5]) AS years) y JOIN m b ON b.symbol = a.symbol AND b.month = a.month + INTERVAL 1 YEAR * y.years")
def rolling_cagr(spark, d):
    x = bars(spark, d).withColumn("ret", (F.col("volume") - 25) / 1000)
    return rounded(ts.rolling_cagr(x, "symbol", "trade_date", "ret", [1, 2, 5]), "cagr")


@query(f"WITH {BARS}, x AS (SELECT symbol, trade_date, (volume - 25) / 1000 AS ret FROM bars) SELECT symbol, CASE WHEN trade_date < DATE '1998-01-01' THEN 'early' ELSE 'late' END AS period, count(ret) AS n, {rnd('exp(sum(ln(1 + ret))) - 1')} AS total_return, {rnd('stddev_samp(ret)')} AS deviation FROM x WHERE trade_date >= DATE '1996-01-01' AND trade_date < DATE '2000-01-01' GROUP BY 1, 2")
def segment_stats(spark, d):
    x = bars(spark, d).withColumn("ret", (F.col("volume") - 25) / 1000)
    p = spark.createDataFrame([("early", "1996-01-01", "1998-01-01"), ("late", "1998-01-01", "2000-01-01")], "period string, a string, b string").select("period", F.col("a").cast("date").alias("start"), F.col("b").cast("date").alias("end"))
    return rounded(ts.segment_stats(x, p, "symbol", "trade_date", "ret"), "total_return", "deviation")


@query(f"WITH {BARS}, x AS (SELECT symbol, trade_date, (volume - 25) / 1000 AS own FROM bars), m AS (SELECT trade_date, round(avg(own), 9) AS b FROM x GROUP BY 1) SELECT symbol, CASE WHEN b > 0 THEN 'up' WHEN b < 0 THEN 'down' ELSE 'flat' END AS side, count(*) AS n, {rnd('sum(ln(1 + own) - ln(1 + b))', 5)} AS excess_log FROM x JOIN m USING (trade_date) GROUP BY 1, 2")
def return_attribution(spark, d):
    x = bars(spark, d).select("symbol", "trade_date", ((F.col("volume") - 25) / 1000).alias("own"))
    m = x.groupBy("trade_date").agg(F.round(F.avg("own"), 9).alias("b"))
    return rounded(ts.return_attribution(x.join(m, "trade_date"), "symbol", "own", "b"), "excess_log", n=5)


@query()
def block_bootstrap(spark, d):
    x = bars(spark, d).groupBy("trade_date").agg(F.avg("volume").alias("v"))
    return rounded(ts.block_bootstrap(x, "trade_date", "v", 200, 20), "mean", "p05", "p50", "p95")


@query(f"WITH {BARS}, t AS (SELECT symbol, trade_date, close, CASE WHEN count(close) {rows_(20)} >= 20 THEN avg(close) {rows_(20)} END AS m, {safe('close', f'lag(close, 10) {WIN})')} - 1 AS mom FROM bars), l AS (SELECT symbol, trade_date, lag(close) {WIN}) AS p, lag(m) {WIN}) AS m, lag(mom) {WIN}) AS mom FROM t), k AS (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY mom DESC NULLS LAST, symbol) AS k, count(*) OVER (PARTITION BY trade_date) AS n FROM l WHERE p IS NOT NULL) SELECT symbol, trade_date, {rnd('1.0 / n')} AS equal, {rnd('CASE WHEN coalesce(p > m, false) THEN 1.0 / n ELSE 0 END')} AS trend, CASE WHEN k <= 2 AND mom > 0 THEN 0.5 ELSE 0 END AS momentum, CASE WHEN k <= 2 AND mom > 0 AND coalesce(p > m, false) THEN 0.5 ELSE 0 END AS momentum_trend FROM k")
def signal_target(spark, d):
    return rounded(ts.signal_target(bars(spark, d), trend=20, look_back=10), "equal", "trend")


@query(f"WITH {RET} SELECT trade_date, count(*) AS total, count(*) FILTER (ret_1 > 0) AS up, count(*) FILTER (ret_1 < 0) AS down, count(*) FILTER (ret_1 = 0) AS flat, {rnd('avg(ret_1)')} AS avg_change, {rnd('sum(amount) / 1e5', 8)} AS total_amount FROM ret GROUP BY 1")
def market_breadth_daily(spark, d):
    return rounded(agg.market_breadth_daily(returns(spark, d), change="ret_1"), "avg_change").withColumn("total_amount", r("total_amount", 8))


@query(f"SELECT CAST(l_shipdate AS DATE) AS trade_date, count(*) AS n, {rnd('avg(l_quantity)')} AS avg_l_quantity, {rnd('avg(l_discount)')} AS avg_l_discount, {rnd('sum(l_extendedprice) / 1e8', 11)} AS sum_l_extendedprice FROM lineitem GROUP BY 1")
def retail_sentiment_daily(spark, d):
    x = table(spark, d, "lineitem").withColumn("trade_date", F.to_date("l_shipdate"))
    return rounded(rounded(agg.retail_sentiment_daily(x, "trade_date", ["l_quantity", "l_discount"], ["l_extendedprice"]), "avg_l_quantity", "avg_l_discount"), "sum_l_extendedprice", n=11)


@query(f"WITH {BARS} SELECT trade_date, count(DISTINCT symbol) AS etfs, sum(volume) AS total_shares, {rnd('sqrt(sum(volume * close) / 1e4)')} AS root_value FROM bars GROUP BY 1")
def etf_market_overview(spark, d):
    b = bars(spark, d)
    out = agg.etf_market_overview(b.withColumnRenamed("volume", "shares"), b, "symbol", "trade_date")
    return out.select("trade_date", "etfs", "total_shares", r(F.sqrt("total_value")).alias("root_value"))  # a root has no ties to round


@query(f"SELECT CAST(l_shipdate AS DATE) AS trade_date, {rnd('sum(l_extendedprice)', 2)} AS l_extendedprice, count(*) FILTER (l_suppkey % 3 = 0) AS rows_sh, count(*) FILTER (l_suppkey % 3 = 1) AS rows_sz, 0 AS rows_bj, count(*) FILTER (l_suppkey % 3 = 2) AS rows_unknown FROM lineitem GROUP BY 1")
def margin_totals(spark, d):
    x = table(spark, d, "lineitem").withColumn("trade_date", F.to_date("l_shipdate")).withColumn("code", F.concat(F.col("l_suppkey").cast("string"), F.element_at(F.array(F.lit(".SH"), F.lit(".SZ"), F.lit(".XX")), (F.col("l_suppkey") % 3).cast("int") + 1)))
    return rounded(agg.margin_totals(x, "trade_date", "code", ["l_extendedprice"]), "l_extendedprice", n=2)


@query("SELECT CAST(l_shipdate AS DATE) AS trade_date, ROUND(sum(l_quantity * (1 - l_discount)), 4) AS net, ROUND(sum(l_quantity - l_linenumber), 4) AS large_net FROM lineitem GROUP BY 1")
def flow_totals(spark, d):
    x = table(spark, d, "lineitem").withColumn("trade_date", F.to_date("l_shipdate")).withColumn("net", F.col("l_quantity") * (1 - F.col("l_discount"))).withColumn("n", F.col("l_linenumber").cast("double"))
    return rounded(agg.flow_totals(x, "trade_date", "net", ["l_quantity"], ["n"]), "net", "large_net", n=4)


@query(f"""WITH {RET}, x AS (SELECT *, {', '.join(f'{DAILY_INPUTS[c]} AS {c}' for c in ('turnover', 'up_limit', 'down_limit'))}, CASE WHEN count(close) {rows_(20)} >= 10 THEN max(close) {rows_(20)} END AS h, CASE WHEN count(close) {rows_(20)} >= 10 THEN min(close) {rows_(20)} END AS l FROM ret),
g AS (SELECT trade_date, count(*) FILTER (ret_1 > 0) AS up, count(*) FILTER (ret_1 < 0) AS down, CASE WHEN count(h) > 0 THEN count(*) FILTER (close >= h) / count(h) END AS new_high_ratio, CASE WHEN count(l) > 0 THEN count(*) FILTER (close <= l) / count(l) END AS new_low_ratio, count(*) FILTER (close >= up_limit - 1e-6) AS limit_up, count(*) FILTER (close <= down_limit + 1e-6) AS limit_down,
  sum(amount) AS amount, median(turnover) AS median_turnover, avg(ret_1) AS mean_return, stddev_samp(ret_1) AS return_std, CASE WHEN count(*) FILTER (ret_1 < 0) > 0 THEN count(*) FILTER (ret_1 > 0) / count(*) FILTER (ret_1 < 0) END AS up_down_ratio FROM x GROUP BY 1)
SELECT trade_date, up, down, limit_up, limit_down, {rnd('amount', 2)} AS amount, {', '.join(f'{rnd(c)} AS {c}' for c in ('new_high_ratio', 'new_low_ratio', 'median_turnover', 'mean_return', 'return_std', 'up_down_ratio'))},
  {rnd('CASE WHEN count(mean_return) OVER v >= 10 THEN stddev_samp(mean_return) OVER v END')} AS volatility_20 FROM g WINDOW v AS (ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def market_state(spark, d):
    """Every column of the market's state by day."""
    b = bars(spark, d).withColumns({c: F.expr(DAILY_INPUTS[c]) for c in ("turnover", "up_limit", "down_limit")})
    m = agg.market_state(b).withColumn("amount", r("amount", 2))
    return rounded(m, "new_high_ratio", "new_low_ratio", "median_turnover", "mean_return", "return_std", "up_down_ratio", "volatility_20")


@query(f"WITH a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) AS v FROM orders GROUP BY 1), y AS (SELECT month, v / lag(v, 12) OVER (ORDER BY month) - 1 AS y FROM a), b AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1) SELECT month, {rnd('y')} AS stock_yoy, n AS shipments FROM y JOIN b USING (month) WHERE y IS NOT NULL")
def macro_core_monthly(spark, d):
    month = lambda c: F.to_date(F.date_trunc("month", c)).alias("month")
    a = table(spark, d, "orders").groupBy(month("o_orderdate")).agg(F.sum("o_totalprice").alias("value"))
    b = table(spark, d, "lineitem").groupBy(month("l_shipdate")).agg(F.count("*").cast("double").alias("value"))
    return rounded(agg.macro_core_monthly({"stock_yoy": a, "shipments": b}, yoy=("stock_yoy",))[0], "stock_yoy")


@query(f"WITH {RET}, l AS (SELECT CAST(date_trunc('month', trade_date) AS DATE) AS month, symbol, arg_max_null(ret_1, trade_date) AS v FROM ret WHERE symbol IN (1, 2, 3) GROUP BY 1, 2), p AS (SELECT month, max(v) FILTER (symbol = 1) AS small, max(v) FILTER (symbol = 2) AS large, max(v) FILTER (symbol = 3) AS mid FROM l GROUP BY 1) SELECT month, {rnd('small')} AS small, {rnd('large')} AS large, {rnd('mid')} AS mid, {rnd('small - large')} AS small_large FROM p")
def equity_style_monthly(spark, d):
    x = returns(spark, d).withColumn("code", F.col("symbol").cast("string"))
    return rounded(agg.equity_style_monthly(x, {"1": "small", "2": "large", "3": "mid"}, {"small_large": ("small", "large")}, change="ret_1"), "small", "large", "mid", "small_large")


@query(f"WITH {BARS} SELECT symbol, CAST(date_trunc('month', trade_date) AS DATE) AS bar_ts, {rnd('arg_min(open, trade_date)', 8)} AS open, {rnd('max(high)', 8)} AS high, {rnd('min(low)', 8)} AS low, {rnd('arg_max(close, trade_date)', 8)} AS close, CASE WHEN count(CASE WHEN volume < 50 THEN 1 END) = count(*) THEN sum(volume) END AS volume, count(*) AS n FROM bars GROUP BY 1, 2")
def bars_resample(spark, d):
    b = bars(spark, d).withColumn("volume", F.when(F.col("volume") < 50, F.col("volume")))
    return rounded(agg.bars_resample(b, ["symbol"], "trade_date", F.to_date(F.date_trunc("month", "trade_date"))), "open", "high", "low", "close", n=8)


@query("WITH m AS (SELECT event_type AS key, date_trunc('minute', ts) AS ts, sum(value) AS v FROM events GROUP BY 1, 2) SELECT key, CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT ts) AS minutes, count(*) = 1440 AS complete FROM m GROUP BY 1, 2")
def minute_day_summary(spark, d):
    m = table(spark, d, "events").groupBy(F.col("event_type").alias("key"), F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("ts")).agg(*(F.sum("value").alias(c) for c in ("open", "high", "low", "close", "volume")))
    return agg.minute_day_summary(m, "key").select("key", "day", "n", "minutes", "complete")


@query(f"SELECT l_suppkey AS symbol, count(*) AS n, count(DISTINCT CAST(l_shipdate AS DATE)) AS distinct_times, CAST(min(l_shipdate) AS DATE) AS first_time, CAST(max(l_shipdate) AS DATE) AS last_time, {rnd('min(l_tax)')} AS lowest, {rnd('max(l_tax)')} AS highest FROM lineitem GROUP BY 1")
def coverage_counts(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("day"), "l_tax")
    return rounded(agg.series_stats(x, ["symbol"], "day", "l_tax"), "lowest", "highest")


@query("SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS \"column\", unnest([true, false, false, false, false, false]) AS is_key, (SELECT count(*) FROM events) AS n, 0 AS nulls, 0 AS non_finite")
def profile_dataset(spark, d):
    return agg.profile_dataset(table(spark, d, "events"), ["event_id"])


_STATED = {"income": (45, ts.INCOME), "balance": (50, ts.BALANCE), "cash": (40, ts.CASH)}


def _statements(spark, d):
    """Three statement tables made of quarterly order sums; year-end ones are restated half a year later."""
    last = F.last_day(F.add_months(F.date_trunc("quarter", "o_orderdate"), 2))
    o = table(spark, d, "orders").groupBy(F.pmod("o_custkey", F.lit(50)).alias("symbol"), last.alias("period")).agg(F.sum("o_totalprice").alias("v"), F.count("*").alias("k"))
    out = []
    for days, names in _STATED.values():
        first = o.select("symbol", "period", F.date_add("period", days).alias("announced"), *((F.col("v") / (j + 2) + F.col("k") * (1000.0 * j)).alias(c) for j, c in enumerate(names)))
        again = first.where(F.month("period") == 12).withColumn("announced", F.date_add("announced", 180))
        out.append(first.unionByName(again.select("symbol", "period", "announced", *((F.col(c) * 1.25).alias(c) for c in names))))
    return out


def _stated(name: str) -> str:
    days, names = _STATED[name]
    first = ", ".join(f"v / {j + 2} + k * {1000 * j}::DOUBLE AS {c}" for j, c in enumerate(names))
    return f"{name}1 AS (SELECT symbol, period, period + {days} AS announced, {first} FROM o), {name} AS (SELECT * FROM {name}1 UNION ALL SELECT symbol, period, announced + 180, {', '.join(f'{c} * 1.25::DOUBLE' for c in names)} FROM {name}1 WHERE month(period) = 12)"


def _known(name: str, to: str, period: str) -> str:
    return f"ASOF LEFT JOIN {name} {to} ON {to}.symbol = e.symbol AND {to}.period = e.{period} AND e.announced >= {to}.announced"


def _trailing(t: str, c: str) -> str:
    return f"CASE WHEN month(e.now) = 12 THEN {t}0.{c} ELSE {t}0.{c} + {t}1.{c} - {t}2.{c} END"


_NOA = "({t}.total_assets - {t}.money_cap - {t}.trad_asset - {t}.total_liab + {t}.st_borr + {t}.non_cur_liab_due_1y + {t}.lt_borr + {t}.bond_payable)"
_RATIOS = {"quality_gross_profit_assets": f"({_trailing('i', 'revenue')} - ({_trailing('i', 'oper_cost')})) / b0.total_assets", "quality_operating_profitability": f"({_trailing('i', 'operate_profit')}) / b0.total_assets", "quality_accruals": f"({_trailing('i', 'n_income_attr_p')} - ({_trailing('c', 'n_cashflow_act')})) / b0.total_assets", "quality_cashflow_quality": f"({_trailing('c', 'n_cashflow_act')}) / abs({_trailing('i', 'n_income_attr_p')})", "investment_asset_growth": "b0.total_assets / b1.total_assets - 1", "investment_capex_assets": f"({_trailing('c', 'c_pay_acq_const_fiolta')}) / b0.total_assets", "investment_noa_growth": f"({_NOA.format(t='b0')} - {_NOA.format(t='b1')}) / abs(b1.total_assets)"}
_JOINS = " ".join([_known("balance", "b0", "now"), _known("balance", "b1", "before"), *(_known(n, f"{t}{j}", q) for n, t in (("income", "i"), ("cash", "c")) for j, q in enumerate(("now", "year_end", "before")))])


@query(f"""WITH {BARS}, o AS (SELECT o_custkey % 50 AS symbol, last_day((date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)::DATE) AS period, sum(o_totalprice) AS v, count(*) AS k FROM orders GROUP BY 1, 2), {', '.join(map(_stated, _STATED))},
ev AS (SELECT DISTINCT symbol, announced FROM (SELECT symbol, announced FROM income UNION ALL SELECT symbol, announced FROM balance UNION ALL SELECT symbol, announced FROM cash)), e0 AS (SELECT ev.symbol, ev.announced, max(b.period) AS now FROM ev JOIN balance b ON b.symbol = ev.symbol AND b.announced <= ev.announced GROUP BY 1, 2), e AS (SELECT *, last_day((now - INTERVAL 12 MONTH)::DATE) AS before, make_date(year(now) - 1, 12, 31) AS year_end FROM e0),
f AS (SELECT e.symbol, e.announced, {_trailing('c', 'n_cashflow_act')} AS flow, {', '.join(f'{x} AS {c}' for c, x in _RATIOS.items())} FROM e {_JOINS})
SELECT b.symbol, b.trade_date, (f.symbol IS NOT NULL)::INTEGER AS eligible, {rnd('flow / (b.amount * 10000)')} AS value_cfp, {', '.join(f'{rnd(c)} AS {c}' for c in _RATIOS)} FROM bars b ASOF LEFT JOIN f ON f.symbol = b.symbol AND b.trade_date >= f.announced""")
def structural_financials(spark, d):
    dates = bars(spark, d).select("symbol", "trade_date", F.col("amount").alias("market_value"))
    return rounded(ts.structural_financials(dates, *_statements(spark, d)).drop("market_value"), "value_cfp", *_RATIOS)


@query()
def macd_strength(spark, d):
    return rounded(ts.macd_strength(bars(spark, d)), "macd_strength")
