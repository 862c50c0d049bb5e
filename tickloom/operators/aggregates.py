"""Daily and monthly aggregates, bars and baskets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rolling import ordered, pct_change, rolling_max, rolling_min, rolling_std
from tickloom.functions.scalars import ratio


def market_breadth_daily(bars: DataFrame, at: str = "trade_date", change: str = "pct_change", amount: str = "amount", unit: float = 1e5) -> DataFrame:
    n = lambda c: F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).cast("long")
    return bars.groupBy(at).agg(F.count("*").alias("total"), n(F.col(change) > 0).alias("up"), n(F.col(change) < 0).alias("down"), n(F.col(change) == 0).alias("flat"), F.avg(change).alias("avg_change"), (F.sum(amount) / unit).alias("total_amount"))


def retail_sentiment_daily(rows: DataFrame, at: str, means: list[str], sums: list[str], unit: float = 1e8) -> DataFrame:
    return rows.groupBy(at).agg(F.count("*").alias("n"), *(F.avg(c).alias(f"avg_{c}") for c in means), *((F.sum(c) / unit).alias(f"sum_{c}") for c in sums))


def etf_market_overview(shares: DataFrame, prices: DataFrame, key: str, at: str) -> DataFrame:
    both = shares.select(key, at, "shares").join(prices.select(key, at, "close"), [key, at])
    return both.groupBy(at).agg(F.countDistinct(key).alias("etfs"), F.sum("shares").alias("total_shares"), (F.sum(F.col("shares") * F.col("close")) / 1e4).alias("total_value"))


def margin_totals(rows: DataFrame, at: str, code: str, values: list[str], suffixes: tuple[str, ...] = (".SH", ".SZ", ".BJ")) -> DataFrame:
    """Sums of each date, rows by exchange suffix, and rows whose suffix is unknown, which a caller must refuse."""
    known = F.lit(False)
    for s in suffixes:
        known = known | F.col(code).endswith(s)
    return rows.groupBy(at).agg(*(F.sum(v).alias(v) for v in values), *(F.sum(F.col(code).endswith(s).cast("long")).alias(f"rows_{s.strip('.').lower()}") for s in suffixes), F.sum((~known).cast("long")).alias("rows_unknown"))


def flow_totals(rows: DataFrame, at: str, net: str, buys: list[str], sells: list[str]) -> DataFrame:
    big = sum((F.col(c) for c in buys), F.lit(0.0)) - sum((F.col(c) for c in sells), F.lit(0.0))
    return rows.groupBy(at).agg(F.sum(net).alias("net"), F.sum(big).alias("large_net"))


def market_state(bars: DataFrame, symbol: str = "symbol", at: str = "trade_date") -> DataFrame:
    """Up/down ratio, shares at 20-row highs and lows, limit counts, amount, median turnover, mean and deviation of
    returns, and the 20-day volatility of the mean."""
    for c in ("turnover", "up_limit", "down_limit"):
        if c not in bars.columns:
            bars = bars.withColumn(c, F.lit(None).cast("double"))
    w = ordered(symbol, at)
    one = bars.select("*", pct_change("close", 1, w).alias("_r"), rolling_max("close", 20, 10, w).alias("_h"), rolling_min("close", 20, 10, w).alias("_l"))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    agg = one.groupBy(at).agg(n(F.col("_r") > 0).alias("up"), n(F.col("_r") < 0).alias("down"), ratio(n(F.col("close") >= F.col("_h")), F.count("_h")).alias("new_high_ratio"), ratio(n(F.col("close") <= F.col("_l")), F.count("_l")).alias("new_low_ratio"), n(F.col("close") >= F.col("up_limit") - 1e-6).alias("limit_up"), n(F.col("close") <= F.col("down_limit") + 1e-6).alias("limit_down"), F.sum("amount").alias("amount"), F.median("turnover").alias("median_turnover"), F.avg("_r").alias("mean_return"), F.stddev_samp("_r").alias("return_std"))
    return agg.withColumn("up_down_ratio", ratio(F.col("up"), F.col("down"))).withColumn("volatility_20", rolling_std("mean_return", 20, 10, Window.orderBy(at)))  # one row a date


def macro_core_monthly(sources: dict[str, DataFrame], month: str = "month", yoy: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(months that have every source, months withheld). YoY sources compare with the 12th observation before."""
    out = None
    for name, df in sources.items():
        one = df.groupBy(month).agg(F.first("value", ignorenulls=True).alias(name)) if name not in yoy else df.groupBy(month).agg(F.first("value", ignorenulls=True).alias("_v")).where("_v is not null").select(month, (ratio(F.col("_v"), F.lag("_v", 12).over(Window.orderBy(month))) - 1).alias(name))
        out = one if out is None else out.join(one, month, "full")
    full = F.lit(True)
    for name in sources:
        full = full & F.col(name).isNotNull()
    return out.where(full), out.where(~full)


def equity_style_monthly(rows: DataFrame, codes: dict[str, str], spreads: dict[str, tuple[str, str]], at: str = "trade_date", code: str = "code", change: str = "pct_chg") -> DataFrame:
    """The last change of each index and month, one column each, and named spreads between them."""
    known = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))
    last = rows.where(F.col(code).isin(*codes)).groupBy(F.to_date(F.date_trunc("month", at)).alias("month"), code).agg(F.max_by(change, at).alias("v"))
    wide = last.withColumn("name", known[F.col(code)]).groupBy("month").pivot("name", list(codes.values())).agg(F.first("v"))
    return wide.select("*", *((F.col(a) - F.col(b)).alias(name) for name, (a, b) in spreads.items()))


def bars_resample(bars: DataFrame, key: list[str], at: str, bucket: Column, out: str = "bar_ts", volume: str = "volume", source: str | None = None) -> DataFrame:
    """First open, highest high, lowest low, last close and summed volume of each bucket; nothing is filled.

    One null volume makes the bucket's volume null. Buckets that mix sources have `mixed` set.
    """
    sums = F.when(F.count(volume) == F.count("*"), F.sum(volume))
    mixed = [(F.min(source) != F.max(source)).alias("mixed")] if source else []
    return bars.groupBy(*key, bucket.alias(out)).agg(F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close"), sums.alias(volume), F.count("*").alias("n"), *mixed)


def trades_to_bars(trades: DataFrame, key: list[str], at: str, bucket: Column, price: str, volume: str, order: list[str], out: str = "bar_ts") -> DataFrame:
    """Bars of single trades; `order` breaks ties of time."""
    o = F.struct(at, *order)
    return trades.groupBy(*key, bucket.alias(out)).agg(F.min_by(price, o).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, o).alias("close"), F.sum(volume).alias("volume"), F.count("*").alias("n"))


def minute_day_summary(minutes: DataFrame, key: str, at: str = "ts", expected: int = 1440) -> DataFrame:
    """OHLC and sums of each day, and whether its grid of minutes is complete."""
    day = F.to_date(at)
    agg = bars_resample(minutes, [key], at, day, "day")
    grid = minutes.groupBy(key, day.alias("day")).agg(F.countDistinct(F.date_trunc("minute", at)).alias("minutes"))
    return agg.join(grid, [key, "day"]).withColumn("complete", (F.col("minutes") == expected) & (F.col("n") == expected))


def basket_features(rows: DataFrame, basket: str, at: str, covered: list[str], ret: str = "ret", ret5: str = "ret_5", weight: str = "weight", top: int = 10) -> DataFrame:
    """Up weight, valid weight, breadth, median and deviation of 5-row returns, count, top weights, covered means.

    Each mean has the weights of the rows that hold its value as denominator.
    """
    d = Window.partitionBy(basket, at).orderBy(F.desc(weight), "symbol")
    ranked = rows.withColumn("_k", F.row_number().over(d))
    w = F.col(weight)
    held = lambda c: F.sum(F.when(F.col(c).isNotNull(), w))
    return ranked.groupBy(basket, at).agg(F.count("*").alias("members"), held(ret).alias("valid_weight"), F.sum(F.when(F.col(ret) > 0, w).otherwise(0.0)).alias("up_weight"), F.avg(F.when(F.col(ret).isNotNull(), (F.col(ret) > 0).cast("double"))).alias("breadth"), F.median(ret5).alias("median_ret_5"), F.stddev_samp(ret5).alias("std_ret_5"), F.sum(F.when(F.col("_k") <= top, w)).alias("top_weight"), *(ratio(F.sum(F.when(F.col(c).isNotNull(), w * F.col(c))), held(c)).alias(f"mean_{c}") for c in covered))


def basket_style_value(rows: DataFrame, basket: str, at: str, columns: list[str], weight: str = "weight", least: float = 0.6) -> DataFrame:
    """Covered-weight means, missing where less than `least` of the weight has the value."""
    w = F.col(weight)
    means = []
    for c in columns:
        held = F.sum(F.when(F.col(c).isNotNull(), w))
        means += [F.when(held >= least * F.sum(w), F.sum(w * F.col(c)) / held).alias(c), ratio(F.coalesce(held, F.lit(0.0)), F.sum(w)).alias(f"{c}_coverage")]
    return rows.groupBy(basket, at).agg(*means)


def series_stats(rows: DataFrame, key: list[str], at: str, value: str) -> DataFrame:
    """Rows, distinct times, first and last time, lowest and highest value of each series."""
    return rows.groupBy(*key).agg(F.count("*").alias("n"), F.countDistinct(at).alias("distinct_times"), F.min(at).alias("first_time"), F.max(at).alias("last_time"), F.min(value).alias("lowest"), F.max(value).alias("highest"))


def profile_dataset(df: DataFrame, key: list[str]) -> DataFrame:
    """Column, rows, nulls and non-finite values, in one pass over the data."""
    kinds = dict(df.dtypes)
    bad = lambda c: F.sum((F.isnan(c) | (F.abs(c) == float("inf"))).cast("long")) if kinds[c] in ("double", "float") else F.lit(0).cast("long")
    agg = df.agg(F.count("*").alias("n"), *(F.sum(F.col(c).isNull().cast("long")).alias(f"null_{k}") for k, c in enumerate(df.columns)), *(bad(c).alias(f"bad_{k}") for k, c in enumerate(df.columns)))
    table = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(c in key).alias("is_key"), F.col(f"null_{k}").alias("nulls"), F.coalesce(F.col(f"bad_{k}"), F.lit(0)).alias("non_finite")) for k, c in enumerate(df.columns)))).alias("x")
    return agg.select("n", table).select("x.column", "x.is_key", "n", "x.nulls", "x.non_finite")
