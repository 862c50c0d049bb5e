"""Per-symbol window features. All plain windows of one frame share one shuffle by symbol."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.rolling import Sums, delta, forward_fill, last_rows, ordered, pct_change, rolling_cov, rolling_max, rolling_mean, rolling_min, rolling_std, rolling_sum, running_moments, shift
from tickloom.functions.scalars import TINY, clip, correlation, mean_of, ratio


def ema(df: DataFrame, key: list[str], at: str, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Exponential means with alpha 2/(span+1), unadjusted; a missing value keeps the state with a decayed weight.

    A recurrence has no window form, so each key's rows pass one Python call; keys are symbols, of bounded history.
    A source may be an earlier mean. Other columns of doubles pass as one array, since each column of a call costs.
    """
    own = {*key, at, *(source for source, _ in columns.values())}
    apart = [c for c, kind in df.dtypes if c in own or kind != "double"]
    rest = [c for c in df.columns if c not in apart]
    packed = df.select(*apart, F.array(*rest).alias("_rest")) if rest else df
    schema = T.StructType([*packed.schema.fields, *(T.StructField(name, T.DoubleType()) for name in columns)])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(at)
        for name, (source, span) in columns.items():
            mean = pd.Series(rows[source].cast(pa.float64()).to_numpy()).ewm(span=span, adjust=False, ignore_na=False).mean()
            rows = rows.append_column(name, pa.array(mean, pa.float64(), from_pandas=True))
        return rows

    out = packed.groupBy(*key).applyInArrow(run, schema)
    return out.select(*(F.col("_rest")[rest.index(c)].alias(c) if c in rest else c for c in df.columns), *columns)


def daily_windows(bars: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    """The daily factor inputs that are windows of bars with open, close, high, low, volume, amount, turnover, market_value,
    free_market_value, pe, pb, ps, up_limit, down_limit, is_st, is_suspended.

    Columns that the frame lacks count as missing, but effective_volume is volume then. Every rolling value has a window
    and a least count. Returns run over missing closes from the last one known. Where a feature has two rules, both are
    there: downside_vol_60 is the deviation of falls alone, downside_60 and downside_252 count other days as 0;
    volume_momentum is a change, volume_trend compares two means; bollinger_position lies around the mean,
    bollinger_band within the band, from 0 to 1; limit_touch and tradable are missing or ask for a volume where the two
    limit_touch_ columns are 0 and is_tradable asks for an amount and neither special treatment nor suspension.
    """
    for c in ("open", "turnover", "market_value", "free_market_value", "pe", "pb", "ps", "up_limit", "down_limit", "is_st", "is_suspended"):
        if c not in bars.columns:
            bars = bars.withColumn(c, F.lit(None).cast("double"))
    w = ordered(symbol, at)
    filled = lambda n: F.last("close", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -n))
    momentum = lambda far, near: ratio(shift("close", near, w), shift("close", far, w)) - 1
    plain = {
        **{f"ret_{n}": ratio(filled(0), filled(n)) - 1 for n in (1, 3, 5, 20, 60, 120)},
        "volume_momentum": pct_change("volume", 5, w),
        "momentum_12_1": momentum(252, 21),
        "momentum_6_1": momentum(126, 21),
        "momentum_12_2": momentum(252, 42),
        "drawdown_20": ratio(F.col("close"), rolling_max("close", 20, 10, w)) - 1,
        "_moved": delta("close", 1, w),
        "_row": F.row_number().over(w),
    }
    one = bars.select("*", *(c.alias(n) for n, c in plain.items()))
    r, close, amount, moved = F.col("ret_1"), F.col("close"), F.col("amount"), F.col("_moved")
    own = {"ret": r, "down": F.when(r < 0, r), "fall": F.when(r < 0, r).when(r.isNotNull(), 0.0), "close": close, "amount": amount, "turnover": F.col("turnover"), "volume": F.col("effective_volume" if "effective_volume" in bars.columns else "volume"), "illiquid": ratio(F.abs(r), amount), "rise": F.when(moved > 0, moved).when(moved <= 0, 0.0), "drop": F.when(moved < 0, -moved).when(moved >= 0, 0.0)}
    spans = {"ret": (20, 60, 120, 252), "down": (60,), "fall": (60, 252), "close": (5, 20), "amount": (3, 5, 20, 60), "turnover": (20, 21, 252), "volume": (5, 20), "illiquid": (20,), "rise": (14,), "drop": (14,)}
    sums = Sums(one, symbol, at, own, ("ret", "down", "fall", "close"), spans)
    mean20, turn20, amount20 = (sums.mean(c, 20, 10) for c in ("close", "turnover", "amount"))
    gain, loss = sums.mean("rise", 14, 1), sums.mean("drop", 14, 1)
    std20, turn21, turn252 = sums.std("close", 20, 10), sums.mean("turnover", 21, 15), sums.mean("turnover", 252, 120)
    strength = 1 - 2 / (1 + sums.mean("rise", 14, 7) / (sums.mean("drop", 14, 7) + TINY))
    trend = ratio(sums.mean("volume", 5, 3), sums.mean("volume", 20, 10)) - 1
    held = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    inverse = lambda c: ratio(F.lit(1.0), c)
    touched = (F.col("high") >= F.col("up_limit") - 1e-6) | (F.col("low") <= F.col("down_limit") + 1e-6)
    feats: dict[str, Column] = {
        **{f"vol_{n}": sums.std("ret", n, max(2, n // 2)) for n in (20, 60, 120, 252)},
        "downside_vol_60": sums.std("down", 60, 10),
        "amount_mean_5": sums.mean("amount", 5, 3),
        "amount_mean_20": amount20,
        "amount_mean_60": sums.mean("amount", 60, 30),
        "turnover_mean_20": turn20,
        "abnormal_turnover": ratio(F.col("turnover"), turn20),
        "liquidity_shock": ratio(amount, amount20),
        "log_size": F.when(F.col("market_value") > 0, F.log("market_value")),
        "book_to_price": inverse("pb"),
        "earnings_to_price": inverse("pe"),
        "sales_to_price": inverse("ps"),
        "amihud_20": sums.mean("illiquid", 20, 10),
        "rsi_14": F.when(F.col("_row") >= 7, ratio(gain, gain + loss)),  # the first row counts
        "ma_trend": ratio(sums.mean("close", 5, 3), mean20) - 1,
        "acceleration": F.col("ret_5") - F.col("ret_20") / 4,
        "bollinger_position": ratio(close - mean20, 2 * std20),
        "divergence": F.col("ret_5") - F.col("volume_momentum"),
        "rotation": mean_of([F.col("ret_5"), F.col("ret_20"), F.col("ret_60")], 2),
        "limit_up_distance": ratio(F.col("up_limit"), close) - 1,
        "limit_down_distance": 1 - ratio(F.col("down_limit"), close),
        "limit_touch": F.when(F.col("up_limit").isNotNull(), touched.cast("int")),
        "tradable": ((F.col("volume") > 0) & close.isNotNull()).cast("int"),
        "price": close,
        "open_price": F.col("open"),
        "ret": r,
        "downside_60": sums.std("fall", 60, 30),
        "downside_252": sums.std("fall", 252, 126),
        "amount_mean_3": sums.mean("amount", 3, 1),
        "turnover_21": turn21,
        "turnover_252": turn252,
        "abturnover": ratio(turn21, turn252),
        "log_free_size": F.when(F.col("free_market_value") > 0, F.log("free_market_value")),
        "momentum_12m": F.col("momentum_12_1"),
        "rsi_strength": strength,
        "price_acceleration": F.col("ret_5") - F.col("ret_20"),
        "bollinger_band": clip(ratio(close - mean20 + 2 * std20, 4 * std20), 0.0, 1.0),
        "volume_trend": trend,
        "price_volume_divergence": F.col("ret_20") - trend,
        "rotation_composite": 0.3 * strength + 0.4 * F.col("ret_20") + 0.3 * trend,
        "distance_to_down_limit": ratio(close, F.col("down_limit")) - 1,
        "limit_touch_up": held(F.col("high") >= F.col("up_limit") * (1 - 1e-6)),
        "limit_touch_down": held(F.col("low") <= F.col("down_limit") * (1 + 1e-6)),
        "is_tradable": held((F.col("is_st") == 0) & (F.col("is_suspended") == 0) & (amount > 0)),
    }
    return sums.df.select(*one.columns, *(c.alias(n) for n, c in feats.items())).drop("_moved", "_row")


def with_macd(df: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    """Rows with the strength of their MACD, (EMA12 - EMA26 - its EMA9) / EMA26 of close. The mean of a difference is that of its means."""
    means = ema(df, [symbol], at, {"_fast": ("close", 12), "_slow": ("close", 26), "_fast9": ("_fast", 9), "_slow9": ("_slow", 9)})
    return means.select(*df.columns, ratio(F.col("_fast") - F.col("_slow") - (F.col("_fast9") - F.col("_slow9")), F.col("_slow")).alias("macd_strength"))


def daily_features(bars: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    """All daily factor inputs of bars: those of `daily_windows` and the strength of the MACD."""
    return with_macd(daily_windows(bars, symbol, at), symbol, at)


def macd_strength(bars: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    """(EMA12 - EMA26 - its EMA9) / close; EMAs are recurrences."""
    both = ema(bars.select(symbol, at, "close"), [symbol], at, {"_fast": ("close", 12), "_slow": ("close", 26)})
    line = both.withColumn("_line", F.col("_fast") - F.col("_slow"))
    return ema(line, [symbol], at, {"_signal": ("_line", 9)}).select(symbol, at, ratio(F.col("_line") - F.col("_signal"), F.col("close")).alias("macd_strength"))


def effective_volume(bars: DataFrame) -> DataFrame:
    """Volume if the panel has any finite one, else amount: one global count decides."""
    any_volume = bars.agg((F.count(F.when(F.col("volume").isNotNull() & ~F.isnan("volume"), 1)) > 0).alias("_any"))  # one row
    return bars.crossJoin(F.broadcast(any_volume)).withColumn("effective_volume", F.when(F.col("_any"), F.col("volume")).otherwise(F.col("amount"))).drop("_any")


def nonlinear_size(panel: DataFrame, at: str = "trade_date", size: str = "log_size") -> DataFrame:
    """The cube of the date's z of log size, less its mean."""
    d = Window.partitionBy(at)
    z = ratio(F.col(size) - F.avg(size).over(d), F.stddev_pop(size).over(d))
    cubed = panel.withColumn("_cube", F.pow(z, 3))
    return cubed.withColumn("nonlinear_size", F.col("_cube") - F.avg("_cube").over(d)).drop("_cube")


def market_risk(panel: DataFrame, symbol: str = "symbol", at: str = "trade_date", ret: str = "ret_1", n: int = 252, least: int = 60) -> DataFrame:
    """Rolling beta against the equal-weight market and the residual's deviation, in population form."""
    market = panel.groupBy(at).agg(F.avg(ret).alias("market_ret"))
    both, w = panel.join(market, at), ordered(symbol, at)
    m = F.when(F.col(ret).isNotNull(), F.col("market_ret"))
    k, cov, var, own = running_moments(m, ret, n, w)
    beta = F.when(k >= least, ratio(cov, var, 1e-18))
    return both.withColumn("beta_252", beta).withColumn("residual_vol_252", F.when(beta.isNotNull(), F.sqrt(F.greatest(own - beta * cov, F.lit(0.0)))))


def listing_days(panel: DataFrame, listed: str, at: str = "trade_date") -> DataFrame:
    return panel.withColumn("listing_days", F.datediff(at, listed))


def etf_market_features(bars: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    w = ordered(symbol, at)
    one = bars.withColumn("ret", pct_change("close", 1, w))
    drawdown = ratio(F.col("close"), rolling_max("close", 20, 10, w)) - 1
    two = one.select("*", ratio(F.col("amount"), rolling_mean("amount", 20, 10, w)).alias("amount_ratio"), rolling_std("ret", 5, 3, w).alias("vol_5"), rolling_std("ret", 20, 10, w).alias("vol_20"), drawdown.alias("drawdown_20"), pct_change("close", 5, w).alias("ret_5"), pct_change("close", 20, w).alias("ret_20"))
    return two.withColumn("recent_drawdown", rolling_min("drawdown_20", 5, 3, w))


def etf_beta(panel: DataFrame, symbol: str = "symbol", at: str = "trade_date", ret: str = "ret", n: int = 60, least: int = 30) -> DataFrame:
    """Rolling beta against the date's median return, from running sums, so its cost doesn't grow with n."""
    market = panel.groupBy(at).agg(F.median(ret).alias("median_ret"))
    both, w = panel.join(F.broadcast(market), at), ordered(symbol, at)  # a row for each date
    m = F.when(F.col(ret).isNotNull(), F.col("median_ret"))
    k, cov, var, _ = running_moments(m, ret, n, w)
    return both.withColumn("beta_60", F.when(k >= least, ratio(cov, var, 1e-18)))


def etf_share_flow(rows: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    """Filled shares, their change over 5 rows, the flow of money, AUM, and the flow's intensity and persistence."""
    w = ordered(symbol, at)
    one = rows.withColumn("shares", forward_fill("shares", w))
    two = one.select("*", (F.col("shares") * F.col("close")).alias("aum"), pct_change("shares", 5, w).alias("share_change_5"), (delta("shares", 1, w) * F.col("close")).alias("flow"))
    three = two.select("*", ratio(rolling_sum("flow", 5, 3, w), F.col("aum")).alias("flow_intensity"), F.signum("flow").alias("_sign"))
    return three.withColumn("flow_persistence", rolling_mean("_sign", 5, 3, w)).drop("_sign")


def csi_temporal(bars: DataFrame, turnover: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    """252-row return and deviation, 20-row amount, and turnover that rolls over its own rows before it joins."""
    w = ordered(symbol, at)
    one = bars.withColumn("ret", pct_change("close", 1, w))
    own = last_rows(w, 252)
    year = F.when(F.count("ret").over(own) >= 120, F.exp(F.sum(F.log1p("ret")).over(own)) - 1)
    rolled = turnover.where("turnover is not null").withColumn("turnover_20", rolling_mean("turnover", 20, 10, w)).select(symbol, at, "turnover_20")
    return one.select("*", year.alias("ret_252"), rolling_std("ret", 252, 120, w).alias("vol_252"), rolling_mean("amount", 20, 10, w).alias("amount_20")).join(rolled, [symbol, at], "left")


#: The columns of each statement that structural financials read.
INCOME, CASH = ("revenue", "oper_cost", "operate_profit", "n_income_attr_p"), ("n_cashflow_act", "c_pay_acq_const_fiolta")
DEBTS = ("st_borr", "non_cur_liab_due_1y", "lt_borr", "bond_payable")
BALANCE = ("total_assets", "money_cap", "trad_asset", "total_liab", *DEBTS)


def structural_financials(dates: DataFrame, income: DataFrame, balance: DataFrame, cash: DataFrame, symbol: str = "symbol", at: str = "trade_date", market_value: str = "market_value") -> DataFrame:
    """Eight ratios of the newest statements known at each date, and whether a balance sheet is (`eligible`).

    Statements: symbol, period, announced and money columns; announcements of one period replace older ones. At each
    announcement of any of the three the newest balance period known by then is the current one. Trailing years are the
    current period plus the year before less its same period, each in the version known by then. Values per ten thousand.
    """
    from tickloom.operators.joins import asof_backward

    tables = {"i": (income, INCOME), "b": (balance, BALANCE), "c": (cash, CASH)}
    fields = [c for _, names in tables.values() for c in names]
    rows = [df.select(symbol, F.lit(k).alias("_src"), "period", F.col("announced").alias(at), *((F.col(c) if c in names else F.lit(None)).cast("double").alias(c) for c in fields)) for k, (df, names) in tables.items()]
    whole = rows[0].unionByName(rows[1]).unionByName(rows[2])
    events = whole.groupBy(symbol, at).agg(F.max(F.when(F.col("_src") == "b", F.col("period"))).alias("_new"))
    seen = Window.partitionBy(symbol).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    events = events.withColumn("_now", F.max("_new").over(seen)).where("_now is not null").drop("_new")
    before, year_end = F.add_months("_now", -12), F.make_date(F.year("_now") - 1, F.lit(12), F.lit(31))
    wanted = [("b", "b0", F.col("_now")), ("b", "b1", before), *((k, f"{k}{j}", q) for k in ("i", "c") for j, q in enumerate((F.col("_now"), year_end, before)))]
    asked = events.withColumn("_x", F.explode(F.array(*(F.struct(F.lit(k).alias("_src"), F.lit(slot).alias("_slot"), q.alias("period")) for k, slot, q in wanted)))).select(symbol, at, "_now", "_x.*")
    found = asof_backward(asked, whole, [symbol, "_src", "period"], at, fields)
    held = {(slot, c): F.max(F.when(F.col("_slot") == slot, F.col(c))).alias(f"{slot}_{c}") for k, slot, _ in wanted for c in tables[k][1]}
    one = found.drop("at").groupBy(symbol, at, "_now").agg(*held.values())
    v = lambda slot, c: F.col(f"{slot}_{c}")
    ttm = lambda k, c: F.when(F.month("_now") == 12, v(f"{k}0", c)).otherwise(v(f"{k}0", c) + v(f"{k}1", c) - v(f"{k}2", c))
    or_0 = lambda c: F.coalesce(c, F.lit(0.0))
    operating = lambda s: v(s, "total_assets") - v(s, "money_cap") - or_0(v(s, "trad_asset")) - v(s, "total_liab") + sum((or_0(v(s, c)) for c in DEBTS), F.lit(0.0))
    assets, profit, flow = v("b0", "total_assets"), ttm("i", "n_income_attr_p"), ttm("c", "n_cashflow_act")
    made = {"_flow": flow, "quality_gross_profit_assets": ratio(ttm("i", "revenue") - ttm("i", "oper_cost"), assets), "quality_operating_profitability": ratio(ttm("i", "operate_profit"), assets), "quality_accruals": ratio(profit - flow, assets), "quality_cashflow_quality": ratio(flow, F.abs(profit)), "investment_asset_growth": ratio(assets, v("b1", "total_assets")) - 1, "investment_capex_assets": ratio(ttm("c", "c_pay_acq_const_fiolta"), assets), "investment_noa_growth": ratio(operating("b0") - operating("b1"), F.abs(v("b1", "total_assets")))}
    feats = one.select(symbol, at, *(c.alias(n) for n, c in made.items()))
    out = asof_backward(dates, feats, [symbol], at, list(made), prefix="f_")
    return out.select(*dates.columns, F.col("f_at").isNotNull().cast("int").alias("eligible"), ratio(F.col("f__flow"), F.col(market_value) * 10_000).alias("value_cfp"), *(F.col(f"f_{c}").alias(c) for c in made if c != "_flow"))


def risk_context(panel: DataFrame, dates: int = 100, top: int = 100, symbol: str = "symbol", at: str = "trade_date", ret: str = "ret") -> DataFrame:
    """By date: mean pairwise correlation of the most traded symbols over 20 rows, its z against the 60 before, and a state.

    Pairs need ten common rows. Breadth, volatility and the ratio of 5-row to 20-row amounts are of all symbols. Only
    the last `dates` count, and only those on which a chosen symbol has a return have a row. Pairs by dates are at most
    top * top / 2 * dates rows.
    """
    days = panel.select(at).distinct().orderBy(F.desc(at)).limit(dates)
    recent = panel.join(F.broadcast(days), at, "left_semi").select(symbol, at, F.col(ret).alias("_r"), "amount")  # `dates` rows
    best = recent.groupBy(symbol).agg(F.avg("amount").alias("_a")).orderBy(F.desc_nulls_last("_a"), symbol).limit(top).select(symbol)
    chosen = recent.join(F.broadcast(best), symbol, "left_semi").where("_r is not null").select(symbol, at, "_r")  # `top` rows
    pivot = chosen.select(at).distinct().withColumn("_i", F.row_number().over(Window.orderBy(at)) - 1)
    own = lambda c: chosen.select(F.col(symbol).alias(c), at, F.col("_r").alias(f"_r{c}"))
    pairs = best.select(F.col(symbol).alias("a")).crossJoin(F.broadcast(best.select(F.col(symbol).alias("b")))).where("a < b")  # `top` rows each
    grid = pairs.crossJoin(F.broadcast(pivot)).join(own("a"), ["a", at], "left").join(own("b"), ["b", at], "left")
    both = F.col("_ra").isNotNull() & F.col("_rb").isNotNull()
    w = Window.partitionBy("a", "b").orderBy("_i").rowsBetween(-19, 0)
    x, y = F.when(both, F.col("_ra")), F.when(both, F.col("_rb"))
    grid = grid.select(at, "_i", F.count(x).over(w).alias("_n"), F.covar_pop(x, y).over(w).alias("_c"), F.var_pop(x).over(w).alias("_x"), F.var_pop(y).over(w).alias("_y"))
    known = (F.col("_n") >= 10) & (F.col("_x") > 0) & (F.col("_y") > 0) & (F.col("_i") >= 11)
    mean = grid.groupBy(at, "_i").agg(F.avg(F.when(known, clip(F.col("_c") / F.sqrt(F.col("_x") * F.col("_y")), -1, 1))).alias("average_correlation"))
    before = Window.orderBy("_i").rowsBetween(-60, -1)  # `dates` rows
    enough = F.count("average_correlation").over(before) >= 20
    mean = mean.withColumn("correlation_z", F.when(enough, ratio(F.col("average_correlation") - F.avg("average_correlation").over(before), F.stddev_samp("average_correlation").over(before))))
    daily = recent.groupBy(at).agg(F.avg(F.coalesce(F.col("_r") > 0, F.lit(False)).cast("double")).alias("breadth"), F.stddev_samp("_r").alias("volatility"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("_t"))
    last = lambda n: Window.orderBy(at).rowsBetween(1 - n, 0)  # noqa: E731  `dates` rows
    rolled = lambda n, least: F.when(F.count("_t").over(last(n)) >= least, F.avg("_t").over(last(n)))
    daily = daily.withColumn("liquidity", ratio(rolled(5, 3), rolled(20, 10))).drop("_t")
    z, up = F.col("correlation_z"), F.col("breadth")
    state = F.when((z > 1) & (up < 0.35), "stress").when((z > 0.5) | (up < 0.4), "watch").otherwise("normal")
    return mean.drop("_i").join(daily, at).withColumn("state", state)


def split_unadjust(quotes: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    """Raw prices out of split-adjusted quotes: the factor is the product of all later splits."""
    later = ordered(symbol, at).rowsBetween(1, Window.unboundedFollowing)
    factor = F.coalesce(F.exp(F.sum(F.log(F.when(F.col("split") > 0, F.col("split")).otherwise(F.lit(1.0)))).over(later)), F.lit(1.0))
    out = quotes.withColumn("factor", factor)
    adjusted = ratio(F.col("adjclose"), F.col("close"))
    px = ("open", "high", "low", "close")
    return out.select(*[c for c in quotes.columns if c not in (*px, "volume")], "factor", *((F.col(c) * F.col("factor")).alias(c) for c in px), (F.col("volume") / F.col("factor")).alias("volume"), *((F.col(c) * adjusted).alias(f"adj_{c}") for c in px))


def corporate_action_check(rows: DataFrame, symbol: str = "symbol", at: str = "trade_date", tolerance: float = 1e-3) -> DataFrame:
    """Expected against actual change of the adjustment ratio, from split and dividend; and adjusted volumes."""
    w = ordered(symbol, at)
    actual = ratio(ratio(F.col("adj_close"), F.col("close")), F.lag(ratio(F.col("adj_close"), F.col("close"))).over(w))
    before = F.lag("close").over(w)
    expected = F.col("split") * (1 + ratio(F.coalesce(F.col("dividend"), F.lit(0.0)), before - F.coalesce(F.col("dividend"), F.lit(0.0))))
    out = rows.withColumn("actual_ratio", actual).withColumn("expected_ratio", F.when(before.isNotNull(), expected))
    return out.withColumn("agrees", F.abs(F.col("actual_ratio") - F.col("expected_ratio")) <= tolerance)


def ytd_to_quarter(rows: DataFrame, key: list[str], end: str, available: str, value: str) -> DataFrame:
    """Cumulative values as quarterly ones, available when both ends are; a gap before a quarter refuses it."""
    w = ordered(key, end)
    step = F.round(F.months_between(end, F.lag(end).over(w)))
    first = F.lag(end).over(w).isNull()
    quarter = F.when(first, F.col(value)).when(step == 3, F.col(value) - F.lag(value).over(w))
    return rows.select("*", quarter.alias("quarter_value"), F.when(first, F.col(available)).otherwise(F.greatest(F.col(available), F.lag(available).over(w))).alias("quarter_available"))


def liquidity_proxy(long: DataFrame, at: str = "date", name: str = "series", value: str = "value", parts: tuple[str, str, str] = ("A", "B", "C"), scale: float = 1000.0) -> DataFrame:
    """A - B - scale * C on Wednesdays that have all three."""
    wide = long.where(F.dayofweek(at) == 4).groupBy(at).pivot(name, list(parts)).agg(F.first(value))
    a, b, c = parts
    return wide.where(F.col(a).isNotNull() & F.col(b).isNotNull() & F.col(c).isNotNull()).select(at, (F.col(a) - F.col(b) - scale * F.col(c)).alias("net_liquidity"))


def change_correlation(pairs: DataFrame, at: str, a: str, b: str, n: int = 4) -> DataFrame:
    """Pearson correlation of the n-row differences of two aligned weekly series."""
    w = Window.orderBy(at)  # one aligned macro series
    d = pairs.select((F.col(a) - F.lag(a, n).over(w)).alias("x"), (F.col(b) - F.lag(b, n).over(w)).alias("y"))
    return d.where("x is not null and y is not null").agg(F.count("*").alias("n"), correlation("x", "y").alias("corr"))


def normalized_activity(rows: DataFrame, key: str, at: str, value: str, n: int = 30) -> DataFrame:
    """n-day means over a full daily grid, by their first valid value."""
    span = rows.groupBy(key).agg(F.min(at).alias("_a"), F.max(at).alias("_b"))
    grid = span.select(key, F.explode(F.sequence("_a", "_b")).alias(at))
    w = ordered(key, at)
    mean = grid.join(rows, [key, at], "left").withColumn("activity", rolling_mean(value, n, n, w))
    first = F.first("activity", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return mean.withColumn("normalized", ratio(F.col("activity"), first)).select(key, at, "activity", "normalized")


def annual_growth(rows: DataFrame, key: str, year: str, columns: list[str]) -> DataFrame:
    """Change from the row of the year before, missing across a gap."""
    w = ordered(key, year)
    near = F.lag(year).over(w) == F.col(year) - 1
    return rows.select("*", *(F.when(near, ratio(F.col(c), F.lag(c).over(w)) - 1).alias(f"{c}_growth") for c in columns))


def period_funding(rows: DataFrame, at: str, rate: str, key: str, unit: str = "month") -> DataFrame:
    return rows.groupBy(key, F.to_date(F.date_trunc(unit, at)).alias("period")).agg(F.count("*").alias("events"), F.sum(rate).alias("total_rate"))


def nav_metrics(nav: DataFrame, key: str, at: str, value: str, per_year: float = 252.0) -> DataFrame:
    """Total and annual return, volatility, Sharpe ratio and maximum drawdown of each NAV series."""
    w = ordered(key, at)
    one = nav.select("*", pct_change(value, 1, w).alias("_r"), (ratio(F.col(value), F.max(value).over(w.rowsBetween(Window.unboundedPreceding, 0))) - 1).alias("_dd"))
    agg = one.groupBy(key).agg(F.count("*").alias("n"), (ratio(F.max_by(value, at), F.min_by(value, at)) - 1).alias("total_return"), (F.stddev_samp("_r") * per_year**0.5).alias("volatility"), (F.avg("_r") * per_year).alias("_mean"), F.min("_dd").alias("max_drawdown"))
    annual = F.when(F.col("n") > 1, F.pow(1 + F.col("total_return"), F.lit(per_year) / (F.col("n") - 1)) - 1)
    return agg.select(key, "n", "total_return", annual.alias("annual_return"), "volatility", ratio(F.col("_mean"), F.col("volatility")).alias("sharpe"), "max_drawdown")


def rolling_cagr(returns: DataFrame, key: str, at: str, ret: str, years: list[int]) -> DataFrame:
    """Compound annual growth of the windows of some years from each month start. Running sums of log returns at month
    starts replace the range join."""
    w = ordered(key, at)
    cum = returns.withColumn("_cum", F.sum(F.log1p(ret)).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.log1p(ret))
    months = cum.groupBy(key, F.to_date(F.date_trunc("month", at)).alias("month")).agg(F.min_by("_cum", at).alias("c"))
    out = months.withColumn("years", F.explode(F.array(*map(F.lit, years)))).withColumn("end", F.add_months("month", F.col("years") * 12))
    end = months.select(key, F.col("month").alias("end"), F.col("c").alias("ce"))
    return out.join(end, [key, "end"]).select(key, "month", "years", (F.exp((F.col("ce") - F.col("c")) / F.col("years")) - 1).alias("cagr"))


def segment_stats(returns: DataFrame, periods: DataFrame, key: str, at: str, ret: str) -> DataFrame:
    """Rows, total return and deviation of named periods [start, end); periods are a short, fixed list."""
    inside = (F.col(at) >= F.col("start")) & (F.col(at) < F.col("end"))
    rows = returns.join(F.broadcast(periods), inside)
    return rows.groupBy(key, "period").agg(F.count(ret).alias("n"), (F.exp(F.sum(F.log1p(ret))) - 1).alias("total_return"), F.stddev_samp(ret).alias("deviation"))


def return_attribution(rows: DataFrame, key: str, own: str, benchmark: str) -> DataFrame:
    """Differences of log wealth on days when the benchmark rose, fell or stood."""
    side = F.when(F.col(benchmark) > 0, "up").when(F.col(benchmark) < 0, "down").otherwise("flat")
    return rows.where(F.col(own).isNotNull() & F.col(benchmark).isNotNull()).groupBy(key, side.alias("side")).agg(F.count("*").alias("n"), F.sum(F.log1p(own) - F.log1p(benchmark)).alias("excess_log"))


def block_bootstrap(series: DataFrame, at: str, value: str, draws: int, block: int, seed: int = 7) -> DataFrame:
    """Means of seeded resamples by blocks: the quantiles of `draws` means. Hashes pick the blocks' starts, and running
    sums make each block two lookups, so a draw costs n / block rows."""
    spark = series.sparkSession
    w = Window.orderBy(at)  # one series
    rows = series.where(F.col(value).isNotNull()).select(F.row_number().over(w).alias("i"), F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    n = rows.agg(F.max("i")).first()[0] or 0
    if n < block:
        return spark.createDataFrame([], "draws long, mean double, p05 double, p50 double, p95 double")
    blocks = -(-n // block)
    asked = spark.range(draws).withColumnRenamed("id", "draw").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("a", F.pmod(F.xxhash64("draw", "k", F.lit(seed)), F.lit(n - block + 1)).cast("int"))
    low = rows.select(F.col("i").alias("a"), F.col("c").alias("ca"))
    high = rows.select((F.col("i") - block).alias("a"), F.col("c").alias("cb"))
    means = asked.join(high, "a").join(low, "a", "left").groupBy("draw").agg((F.sum(F.col("cb") - F.coalesce("ca", F.lit(0.0))) / (blocks * block)).alias("m"))
    q = F.percentile("m", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).alias("q")
    return means.agg(F.count("*").alias("draws"), F.avg("m").alias("mean"), q).select("draws", "mean", F.col("q")[0].alias("p05"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p95"))


def signal_target(bars: DataFrame, symbol: str = "symbol", at: str = "trade_date", trend: int = 200, look_back: int = 126, top: int = 2) -> DataFrame:
    """Weights from prior closes: equal, trend (above its mean), momentum (the top ones), and both together."""
    w = ordered(symbol, at)
    two = bars.select(symbol, at, "close", rolling_mean("close", trend, trend, w).alias("_mean"), pct_change("close", look_back, w).alias("_mom"))
    three = two.select(symbol, at, F.lag("close").over(w).alias("p"), F.lag("_mean").over(w).alias("mean"), F.lag("_mom").over(w).alias("mom"))
    d = Window.partitionBy(at)
    ranked = three.where("p is not null").withColumn("_k", F.row_number().over(d.orderBy(F.desc_nulls_last("mom"), symbol)))
    n = F.count("*").over(d)
    up = F.coalesce(F.col("p") > F.col("mean"), F.lit(False))
    best = (F.col("_k") <= top) & (F.col("mom") > 0)
    return ranked.select(symbol, at, (F.lit(1.0) / n).alias("equal"), F.when(up, F.lit(1.0) / n).otherwise(0.0).alias("trend"), F.when(best, F.lit(1.0 / top)).otherwise(0.0).alias("momentum"), F.when(best & up, F.lit(1.0 / top)).otherwise(0.0).alias("momentum_trend"))


def clipped_surprise(value: str, limit: float = 2.0) -> Column:
    return clip(value, -limit, limit)
