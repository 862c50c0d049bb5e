"""Cross-sections by date, pool and factor: ranks, normalization, neutralization, pools, weights, styles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import clean, clip, mean_of, ratio
from tickloom.operators.joins import asof_backward


def rank_pct(value: str, by: list[str]) -> Column:
    """Average rank over the count of values, in (0, 1]; nulls have none.

    The mean of the first and the last rank of equal values; all counts share one sort.
    """
    d = Window.partitionBy(*by).orderBy(F.asc_nulls_last(value))
    low, high = F.rank().over(d), F.count(value).over(d.rangeBetween(Window.unboundedPreceding, 0))
    n = F.count(value).over(d.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.when(F.col(value).isNotNull(), (low + high) / 2 / n)


def score_rank(value: str, by: list[str], fallback: float = 0.5) -> Column:
    return F.coalesce(rank_pct(value, by), F.lit(fallback))


def score_mean_rank(values: list[str], by: list[str], fallback: float = 0.5) -> Column:
    """Mean of the ranks that a row has; the fallback where it has none."""
    return F.coalesce(mean_of([rank_pct(v, by) for v in values]), F.lit(fallback))


def robust_zscore(df: DataFrame, by: list[str], value: str, out: str = "z", low: float = 0.01, high: float = 0.99) -> DataFrame:
    """z after clipping at linear quantiles; missing with fewer than 3 values or if all are equal.

    Exact quantiles are one aggregate for each section, joined back.
    """
    q = df.groupBy(*by).agg(F.percentile(value, F.array(F.lit(low), F.lit(high))).alias("_q"), F.count(value).alias("_n"))
    clipped = df.join(q, by).withColumn("_c", F.when(F.col(value).isNotNull(), F.least(F.greatest(F.col(value), F.col("_q")[0]), F.col("_q")[1])))
    d = Window.partitionBy(*by)
    spread = F.stddev_pop("_c").over(d)
    return clipped.withColumn(out, F.when((F.col("_n") >= 3) & (spread > 1e-12), (F.col("_c") - F.avg("_c").over(d)) / spread)).drop("_q", "_n", "_c")


def mad_zscores(df: DataFrame, by: list[str], columns: dict[str, str], width: float = 5.0) -> DataFrame:
    """z of each column (out: source) after clipping at the median plus or minus `width` scaled median deviations.

    All columns share two small aggregates by section and one window.
    """
    sources = list(dict.fromkeys(columns.values()))
    one = df.join(df.groupBy(*by).agg(*(F.median(c).alias(f"_m_{c}") for c in sources)), by)
    two = one.join(one.groupBy(*by).agg(*((F.median(F.abs(F.col(c) - F.col(f"_m_{c}"))) * 1.4826).alias(f"_d_{c}") for c in sources)), by)

    def bounded(c: str) -> Column:
        middle, reach = F.col(f"_m_{c}"), width * F.col(f"_d_{c}")
        return F.when(F.col(c).isNotNull(), F.when(F.col(f"_d_{c}") > 1e-12, F.least(F.greatest(F.col(c), middle - reach), middle + reach)).otherwise(F.col(c)))

    three = two.withColumns({f"_c_{c}": bounded(c) for c in sources})
    d = Window.partitionBy(*by)
    z = {out: ratio(F.col(f"_c_{c}") - F.avg(f"_c_{c}").over(d), F.stddev_pop(f"_c_{c}").over(d)) for out, c in columns.items()}
    return three.withColumns(z).drop(*(f"_{k}_{c}" for c in sources for k in "mdc"))


def mad_zscore(df: DataFrame, by: list[str], value: str, out: str = "z", width: float = 5.0) -> DataFrame:
    return mad_zscores(df, by, {out: value}, width)


def composite_min(columns: list[str], least: int) -> Column:
    return mean_of([F.col(c) for c in columns], least)


#: The published styles, their raw columns, and how many of them must be there.
STYLES = {
    "csi_value_reference": (2, ("book", "earnings", "dividend", "cashflow")),
    "csi_growth_reference": (1, ("growth_revenue", "growth_profit")),
    "csi_dividend_reference": (1, ("dividend",)),
    "csi_quality_reference": (2, ("roe", "gross_margin", "operating_cash", "leverage")),
    "csi_low_vol_reference": (1, ("low_vol",)),
    "csi_momentum_reference": (1, ("momentum",)),
    "csi_cashflow_reference": (1, ("cashflow",)),
    "csi_liquidity_reference": (1, ("amount", "turnover")),
}


def csi_raw() -> dict[str, Column]:
    """The fourteen raw values of the styles: market values in ten thousands, ratios in per cent, as sources have them."""
    c = F.col
    inverse = lambda name: F.when(c(name) > 0, 1 / c(name))
    logged = lambda name: F.log1p(F.when(c(name).isNotNull(), F.greatest(c(name), F.lit(0.0))))
    return {
        "book": inverse("pb"),
        "earnings": inverse("pe_ttm"),
        "dividend": c("dv_ttm") / 100,
        "cashflow": F.when(c("total_mv") > 0, c("n_cashflow_act") / (c("total_mv") * 10_000)),
        "growth_revenue": c("q_gr_yoy"),
        "growth_profit": c("q_profit_yoy"),
        "roe": c("roe"),
        "gross_margin": c("grossprofit_margin"),
        "operating_cash": c("ocf_to_or"),
        "leverage": -c("debt_to_assets"),
        "low_vol": -c("volatility_252"),
        "momentum": ratio("return_252", c("volatility_252") * 5**0.5),
        "amount": logged("amount_20"),
        "turnover": logged("turnover_20"),
    }


def csi_styles(panel: DataFrame, by: list[str]) -> DataFrame:
    """The eight styles: means of clipped z-scores of the fourteen raw values in each section. Inputs that the panel lacks are missing."""
    inputs = ("pb", "pe_ttm", "dv_ttm", "n_cashflow_act", "total_mv", "q_gr_yoy", "q_profit_yoy", "roe", "grossprofit_margin", "ocf_to_or", "debt_to_assets", "volatility_252", "return_252", "amount_20", "turnover_20")
    lacking = {c: F.lit(None).cast("double") for c in inputs if c not in panel.columns}
    raw = {f"_raw_{name}": clean(c) for name, c in csi_raw().items()}
    z = mad_zscores(panel.withColumns(lacking).withColumns(raw), by, {f"_z{name}": name for name in raw})
    styles = [mean_of([F.col(f"_z_raw_{c}") for c in names], least).alias(style) for style, (least, names) in STYLES.items()]
    return z.select(*panel.columns, *styles)


def neutralize(df: DataFrame, by: list[str], value: str, size: str, industry: str, out: str = "neutral", least: int = 20) -> DataFrame:
    """Residual on an intercept, size and industry dummies, over its population deviation, and a status.

    Demeaning value and size within industries leaves one slope, so no solver is needed; without spread of size in
    industries the slope is 0. Sections need `least` complete rows and two industries.
    """
    there = F.col(value).isNotNull() & F.col(size).isNotNull() & F.col(industry).isNotNull()
    one = df.withColumn("_ok", there)
    d, g = Window.partitionBy(*by), Window.partitionBy(*by, industry, "_ok")
    two = one.select("*", F.when(there, F.col(value) - F.avg(value).over(g)).alias("_y"), F.when(there, F.col(size) - F.avg(size).over(g)).alias("_s"), F.sum(there.cast("int")).over(d).alias("_n"), F.size(F.collect_set(F.when(there, F.col(industry))).over(d)).alias("_k"))
    ss = F.sum(F.col("_s") ** 2).over(d)
    three = two.withColumn("_r", F.col("_y") - F.when(ss > 1e-12, F.sum(F.col("_s") * F.col("_y")).over(d) / ss).otherwise(0.0) * F.col("_s"))
    enough = (F.col("_n") >= least) & (F.col("_k") >= 2)
    status = F.when(~there, "missing_input").when(~enough, "too_few").otherwise("ok")
    return three.withColumn(out, F.when(enough, ratio(F.col("_r"), F.stddev_pop("_r").over(d)))).withColumn(f"{out}_status", status).drop("_ok", "_y", "_s", "_n", "_k", "_r")


def preprocess_factor(df: DataFrame, by: list[str], value: str, normalize: str = "robust", neutral: tuple[str, str] | None = None, direction: int = 1, out: str = "processed") -> DataFrame:
    """Normalized, if asked neutralized, signed by direction; with status and recipe."""
    made = {"robust": robust_zscore, "mad": mad_zscore}[normalize](df, by, value, "_z") if normalize != "rank" else df.withColumn("_z", rank_pct(value, by))
    if neutral:
        made = neutralize(made, by, "_z", *neutral, out="_p")
    else:
        made = made.withColumn("_p", F.col("_z")).withColumn("_p_status", F.when(F.col(value).isNull(), "missing_input").when(F.col("_z").isNull(), "too_few").otherwise("ok"))
    recipe = f"{normalize}|{'industry_size' if neutral else 'none'}|{direction:+d}"
    return made.withColumn(out, F.col("_p") * direction).withColumn(f"{out}_status", F.col("_p_status")).withColumn("recipe", F.lit(recipe)).drop("_z", "_p", "_p_status")


#: Fixed value: the style of rows without one.
OTHER_STYLE = "其他"


def ridge_residual(df: DataFrame, by: list[str], y: str, numbers: list[str], group: str, alpha: float = 10.0, least: int = 12, out: str = "residual") -> DataFrame:
    """Ridge residual of y on standardized numbers and group dummies with a free intercept, by section.

    The group first in order has no dummy; rows without group are one of their own. A section is one date's few
    thousand rows, solved by small normal equations in one pandas call.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows[out] = np.nan
        ok = rows[[y, *numbers]].notna().all(axis=1)
        if ok.sum() >= least:
            part = rows[ok]
            x = part[numbers].to_numpy(float)
            spread = x.std(0)
            x = (x - x.mean(0)) / np.where(spread > 0, spread, 1.0)
            styles = part[group].astype(object).where(part[group].notna(), OTHER_STYLE).astype(str)
            x = np.column_stack([x, pd.get_dummies(styles).to_numpy(float)[:, 1:]])
            x, target = x - x.mean(0), part[y].to_numpy(float)
            centred = target - target.mean()
            beta = np.linalg.solve(x.T @ x + alpha * np.eye(x.shape[1]), x.T @ centred)
            rows.loc[ok, out] = centred - x @ beta
        rows[out] = rows[out].astype(object).where(rows[out].notna(), None)
        return rows

    return df.groupBy(*by).applyInPandas(run, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))


def recovery_quality(df: DataFrame, by: list[str], columns: list[str], drawdown: str, ret: str) -> DataFrame:
    """Mean of percentile ranks over all rows, shown only where the drawdown is at most -5 % and the return positive."""
    ranks = [f"_k{i}" for i in range(len(columns))]
    for name, c in zip(ranks, columns, strict=True):
        df = df.withColumn(name, rank_pct(c, by))
    mask = (F.col(drawdown) <= -0.05) & (F.col(ret) > 0)
    return df.withColumn("recovery_quality", F.when(mask, mean_of([F.col(k) for k in ranks], len(ranks)))).drop(*ranks)


#: Pools with their index codes and code prefixes, and the prefixes of boards that ask for a longer history.
POOLS = {
    "all_market": ("", ()), "csi300": ("000300", ()), "csi_a500": ("000510", ()), "csi500": ("000905", ()), "csi800": ("000906", ()), "csi1000": ("000852", ()),
    "csi_all": ("000985", ()), "csi2000": ("932000", ()), "chinext": ("", ("300", "301")), "chinext50": ("399673", ()), "star_market": ("", ("688", "689")), "star50": ("000688", ()),
}
GROWTH = ("300", "301", "688", "689")
LARGEST, HISTORY, GROWTH_HISTORY = 0.9, 60, 252


def stock_pools(panel: DataFrame, members: DataFrame, pools: dict = POOLS, at: str = "trade_date", symbol: str = "symbol", index: str = "index_code", dates: DataFrame | None = None) -> DataFrame:
    """(date, pool, symbol, membership_as_of, parent_percentile, reasons, unavailable) for every pool.

    A symbol without reasons is a member. `members` holds snapshots (index, date, symbol), of which the latest at or
    before the date counts. A pool that can't be told at a date has one row, without symbol, that says why: too few
    sizes for the cut to the largest of all ordinary shares, or no snapshot yet. `dates` may give the panel's dates, where
    they cost less than the panel. Rows become one for each pool only after the last shuffle.
    """
    code = F.upper(F.col(symbol))
    ordinary = (F.length(code) == 9) & (code.rlike(r"^6.....\.SH$") | code.rlike(r"^[03].....\.SZ$"))
    day = Window.partitionBy(at)
    sized = F.coalesce(F.col("_ordinary") & (F.col("total_mv") > 0), F.lit(False))
    codes = [c for c, _ in pools.values() if c]
    spark = panel.sparkSession
    asked = (panel if dates is None else dates).select(at).distinct()
    wanted = asked.withColumn(index, F.explode(F.array(*map(F.lit, dict.fromkeys(codes))))) if codes else asked.withColumn(index, F.lit("")).where("false")
    held = asof_backward(wanted, members.select(index, at).distinct(), [index], at, [], prefix="snap_").select(at, index, "snap_at").where("snap_at is not null")
    snaps = held.groupBy(at).agg(F.map_from_entries(F.collect_list(F.struct(index, "snap_at"))).alias("_snaps"))  # a row for each date
    inside = held.join(members.select(index, F.col(at).alias("snap_at"), symbol), [index, "snap_at"]).groupBy(at, symbol).agg(F.collect_set(index).alias("_in"))
    rows = panel.withColumn("_ordinary", ordinary).withColumn("_sized", sized).join(inside, [at, symbol], "left")
    rows = rows.withColumn("_n", F.sum(F.col("_ordinary").cast("int")).over(day)).withColumn("_m", F.sum(F.col("_sized").cast("int")).over(day)).withColumn("_row", F.row_number().over(day.orderBy(F.desc("_sized"), F.desc("total_mv"), symbol)))
    rows = rows.withColumn("_k", F.when(F.col("_sized"), F.col("_row"))).withColumn("_keep", F.ceil(F.col("_n") * LARGEST)).join(snaps, at, "left")
    table = F.broadcast(spark.createDataFrame([(name, code, list(prefixes)) for name, (code, prefixes) in pools.items()], f"pool string, {index} string, _prefixes array<string>"))  # a dozen pools
    both = rows.crossJoin(table).withColumn("snap_at", F.try_element_at("_snaps", F.col(index)))
    error = F.when(F.col("_m") < F.col("_keep"), "insufficient complete all-A parent ranking for global cutoff").when((F.col(index) != "") & F.col("snap_at").isNull(), "PIT index membership unavailable").otherwise("")
    starts = lambda c, prefixes: F.exists(prefixes, lambda x: F.col(c).startswith(x))
    member = F.coalesce(F.array_contains("_in", F.col(index)), F.lit(False))
    child = F.when(F.size("_prefixes") > 0, starts(symbol, F.col("_prefixes"))).otherwise((F.col(index) == "") | member)
    least = F.when(starts(symbol, F.array(*map(F.lit, GROWTH))), GROWTH_HISTORY).otherwise(HISTORY)
    when = lambda c, name: F.when(F.coalesce(c, F.lit(True)), F.lit(name))
    checks = F.array_compact(F.array(when(~F.col("_sized"), "market_cap_unavailable"), when(F.col("_sized") & (F.col("_k") > F.col("_keep")), "market_cap_below_global_top_90pct"), when(~child, "not_pit_member"), when(F.col("is_st") != 0, "st_or_status_unavailable"), when(F.col("is_suspended") != 0, "suspended"), when(~F.col("tradable"), "not_tradable"), when(F.col("listing_days") < least, "listing_history_below_parent_rule")))
    known = both.withColumn("unavailable", error).where("unavailable = '' or _row = 1")  # one row of a date tells what is unavailable
    good = lambda c: F.when(F.col("unavailable") == "", c)
    return known.select(at, "pool", good(F.col(symbol)).alias(symbol), good(F.when(F.col(index) == "", F.col(at)).otherwise(F.col("snap_at"))).alias("membership_as_of"), good(F.col("_k") / F.col("_n")).alias("parent_percentile"), good(F.when(~F.col("_ordinary"), F.array(F.lit("not_ordinary_a_share"))).otherwise(checks)).alias("reasons"), "unavailable")


def factor_formula(panel: DataFrame, ids: list[str], catalog: dict[str, tuple[str, Callable[[Column], Column], int]]) -> DataFrame:
    """Long form (ids, factor, value): each enabled factor's source column under its transform and direction."""
    made = panel.select(*ids, *((f(F.col(c)) * sign).alias(name) for name, (c, f, sign) in catalog.items()))
    return made.unpivot(ids, list(catalog), "factor", "value")


def register_factor(catalog: dict, name: str, column: str, transform: Callable[[Column], Column] | None = None, direction: int = 1) -> dict:
    return {**catalog, name: (column, transform or (lambda c: c), direction)}


def multi_pool(long: DataFrame, pools: DataFrame, plan: DataFrame, at: str = "trade_date", symbol: str = "symbol") -> DataFrame:
    """Values of each pool's members for the planned (date, pool, factor) sections only."""
    members = pools.where("member").select(at, "pool", symbol)
    return members.join(long, [at, symbol]).join(plan.select(at, "pool", "factor").distinct(), [at, "pool", "factor"], "left_semi")


def pool_factor_coverage(values: DataFrame, pools: DataFrame, at: str = "trade_date") -> DataFrame:
    sizes = pools.where("member").groupBy(at, "pool").agg(F.count("*").alias("members"))
    return values.groupBy(at, "pool", "factor").agg(F.count("value").alias("valid")).join(sizes, [at, "pool"]).withColumn("coverage", ratio(F.col("valid"), F.col("members")))


def l2_factor_panel(rows: DataFrame, columns: dict[str, str], start, symbol: str = "symbol", at: str = "trade_date", amount: str = "clean_amount") -> DataFrame:
    """Three-row changes and ratios to clean amount of daily features; warm-up rows go last."""
    from tickloom.functions.rolling import delta, ordered

    w = ordered(symbol, at)
    made = {c: delta(c, 3, w) if kind == "delta3" else ratio(F.col(c), F.col(amount)) if kind == "to_clean_amount" else F.col(c) for c, kind in columns.items()}
    return rows.select(symbol, at, *(v.alias(c) for c, v in made.items())).where(F.col(at) >= F.lit(start))


def top_k(df: DataFrame, by: list[str], metric: str, name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc_nulls_last(metric), name)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def constituent_snapshot(holdings: DataFrame, dates: DataFrame, key: str, announced: str, period: str, at: str) -> DataFrame:
    """Rows of the latest period among those announced by each date."""
    found = _known_by(holdings, dates, key, announced, at)
    w = Window.partitionBy(at, key)
    return found.withColumn("_p", F.max(period).over(w)).where(F.col(period) == F.col("_p")).drop("_p")


def _known_by(holdings: DataFrame, dates: DataFrame, key: str, announced: str, at: str) -> DataFrame:
    """Holdings of each key's newest announcement by each date: an as-of on announcements, then an equi-join."""
    from tickloom.operators.joins import asof_backward

    events = holdings.select(key, F.col(announced).alias(at)).distinct()
    asked = dates.select(at).distinct().crossJoin(F.broadcast(holdings.select(key).distinct()))
    found = asof_backward(asked, events, [key], at, [], prefix="known_").where("known_at is not null")
    return found.join(holdings.withColumn("known_at", F.col(announced)), [key, "known_at"]).drop("known_at")


def holdings_versions(holdings: DataFrame, key: str, announced: str, period: str, today, stale: int = 120) -> DataFrame:
    """The latest announcement of each key, then its latest period; stale if older than `stale` days."""
    w = Window.partitionBy(key)
    last = holdings.withColumn("_a", F.max(announced).over(w)).where(F.col(announced) == F.col("_a"))
    newest = last.withColumn("_p", F.max(period).over(w)).where(F.col(period) == F.col("_p")).drop("_a", "_p")
    return newest.withColumn("refresh_status", F.when(F.datediff(F.lit(today).cast("date"), announced) > stale, "stale").otherwise("fresh"))


def normalize_weights(holdings: DataFrame, basket: str, stock: str, ratio_column: str, value: str, seq: str) -> DataFrame:
    """Positive ratios, else market values, over their total; equal weights if neither. The last row of a stock stays,
    without normalizing again."""
    w = Window.partitionBy(basket)
    by_ratio = F.when(F.col(ratio_column) > 0, F.col(ratio_column))
    by_value = F.when(F.col(value) > 0, F.col(value))
    raw = F.when(F.sum(by_ratio).over(w) > 0, by_ratio).when(F.sum(by_value).over(w) > 0, by_value).otherwise(F.lit(1.0))
    one = holdings.withColumn("_raw", F.coalesce(raw, F.lit(0.0))).withColumn("weight", ratio(F.col("_raw"), F.sum("_raw").over(w)))
    last = Window.partitionBy(basket, stock).orderBy(F.desc(seq))
    return one.withColumn("_k", F.row_number().over(last)).where("_k = 1 and weight > 0").drop("_raw", "_k")


def shared_etf_panel(market: DataFrame, shares: DataFrame | None, breadth: DataFrame | None, key: list[str], at: str) -> DataFrame:
    """Market, share-flow and component columns with the recovery score over all funds of the date. None: the market has these columns."""
    both = reduce(lambda a, b: a.join(b, key, "left"), (df for df in (shares, breadth) if df is not None), market)
    return recovery_quality(both, [at], ["ret_5", "amount_ratio", "flow_intensity", "breadth"], "recent_drawdown", "ret_5")


def earnings_events(express: DataFrame, forecast: DataFrame, stock: str, announced: str, seq: str) -> DataFrame:
    """(stock, announced, seq, value): the change of profit that both kinds of announcements name, within plus or minus 2.

    Express reports (explicit per cent, or income against the profit before) come after forecasts (low and high per
    cent) of the same day; values that can't be told are left out.
    """
    told = F.coalesce(clean("explicit") / 100, ratio("income", "prior") - 1)
    one = lambda df, value, rank: df.select(stock, announced, (F.lit(rank) * (1 << 52) + F.col(seq)).alias("seq"), clip(value, -2.0, 2.0).alias("value"))
    return one(forecast, (F.col("low") + F.col("high")) / 200, 0).unionByName(one(express, told, 1)).where(f"value is not null and {announced} is not null")


def earnings_outlook(events: DataFrame, members: DataFrame, basket: str, stock: str, at: str, announced: str, weight: str = "weight") -> DataFrame:
    """(basket, date, weighted_outlook, coverage, outlook): the mean of the latest events known at the date, by the covered weight.

    members: the stocks and weights of each basket at each date. Only events announced by the date count. A basket without
    any covered stock has no outlook; dates before the first event have no row.
    """
    known = asof_backward(members, events.withColumnRenamed(announced, at), [stock], at, ["value"], "seq", "event_")
    first = events.agg(F.min(announced).alias("_first"))
    w, v = F.col(weight), F.col("event_value")
    held = F.coalesce(F.sum(F.when(v.isNotNull(), w)), F.lit(0.0))
    total = F.coalesce(F.sum(w * v), F.lit(0.0))
    out = known.crossJoin(F.broadcast(first)).where(F.col(at) >= F.col("_first"))  # one row
    return out.groupBy(basket, at).agg(total.alias("weighted_outlook"), held.alias("coverage"), F.when(held > 0, total / held).alias("outlook"))
