"""Factor evaluation: labels, daily metrics, performance windows and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import correlation, ratio
from tickloom.operators.crosssection import preprocess_factor, rank_pct


def forward_labels(prices: DataFrame, pairs: DataFrame, suspended: DataFrame, symbol: str = "symbol", at: str = "trade_date", price: str = "close") -> DataFrame:
    """Next-session returns of (signal, maturity) pairs; a suspended symbol keeps its last price.

    Status: ok, suspended, missing_price or duplicate.
    """
    one = prices.groupBy(symbol, at).agg(F.max(price).alias("px"), F.count("*").alias("n"))
    start = one.select(symbol, F.col(at).alias("signal_date"), F.col("px").alias("p0"), F.col("n").alias("n0"))
    end = one.select(symbol, F.col(at).alias("maturity_date"), F.col("px").alias("p1"), F.col("n").alias("n1"))
    stop = suspended.select(symbol, F.col(at).alias("maturity_date"), F.lit(True).alias("stopped")).distinct()
    rows = start.join(pairs, "signal_date").join(end, [symbol, "maturity_date"], "left").join(stop, [symbol, "maturity_date"], "left")
    status = F.when((F.col("n0") > 1) | (F.col("n1") > 1), "duplicate").when(F.col("p1").isNotNull() & F.col("p0").isNotNull(), "ok").when(F.col("stopped") & F.col("p0").isNotNull(), "suspended").otherwise("missing_price")
    value = F.when(F.col("status") == "ok", ratio(F.col("p1"), F.col("p0")) - 1).when(F.col("status") == "suspended", 0.0)
    return rows.withColumn("status", status).withColumn("forward_return", value).select(symbol, "signal_date", "maturity_date", "forward_return", "status")


def buckets(sample: DataFrame, by: list[str], value: str, symbol: str, n: int = 10) -> DataFrame:
    """Tenths by value, ties by symbol; the first ones hold one more where rows don't divide evenly."""
    d = Window.partitionBy(*by)
    k, m = F.row_number().over(d.orderBy(value, symbol)) - 1, F.count("*").over(d)
    small, more = F.floor(m / n), m % n
    edge = more * (small + 1)
    at = F.when(k < edge, F.floor(k / (small + 1))).otherwise(more + F.floor((k - edge) / F.greatest(small, F.lit(1))))
    return sample.withColumn("bucket", (at + 1).cast("int"))


def decile_returns(sample: DataFrame, by: list[str], value: str, label: str, symbol: str, n: int = 10) -> DataFrame:
    both = sample.where(F.col(value).isNotNull() & F.col(label).isNotNull())
    return buckets(both, by, value, symbol, n).groupBy(*by, "bucket").agg(F.count("*").alias("n"), F.avg(label).alias("mean_return"))


def factor_metrics(sample: DataFrame, by: list[str], value: str, label: str, symbol: str, n: int = 10) -> DataFrame:
    """Coverage, quality, rank IC, win, top less bottom tenth, monotonicity and the tenths' mean labels by section.

    Quality is insufficient_sample below three rows that hold both, then constant_factor, constant_label or ready; the
    others have no numbers. Below n rows there are as many parts. All windows and both aggregates share one shuffle.
    """
    d = Window.partitionBy(*by)
    both = F.col(value).isNotNull() & F.col(label).isNotNull()
    rows = sample.withColumn("_v", F.when(both, F.col(value) + F.lit(0.0))).withColumn("_l", F.when(both, F.col(label)))
    rows = rows.withColumn("_x", rank_pct("_v", by) - 0.5).withColumn("_y", rank_pct("_l", by) - 0.5)
    k, m = F.row_number().over(d.orderBy(F.asc_nulls_last("_v"), symbol)) - 1, F.count("_v").over(d)
    small, more = F.floor(m / n), m % n
    edge = more * (small + 1)
    at = F.when(k < edge, F.floor(k / (small + 1))).otherwise(more + F.floor((k - edge) / F.greatest(small, F.lit(1)))) + 1
    rows = rows.withColumn("bucket", F.when(F.col("_v").isNotNull(), at.cast("int")))
    x, y = F.col("_x"), F.col("_y")
    sums = {"_sx": x, "_sy": y, "_sxx": x * x, "_syy": y * y, "_sxy": x * y}
    part = rows.groupBy(*by, "bucket").agg(F.count("*").alias("_n"), F.count("_v").alias("_k"), F.avg("_l").alias("_m"), *(f("_v").alias(f"_v{i}") for i, f in enumerate((F.min, F.max))), *(f("_l").alias(f"_l{i}") for i, f in enumerate((F.min, F.max))), *(F.sum(c).alias(name) for name, c in sums.items()))
    whole = part.groupBy(*by).agg(F.sum("_n").alias("total"), F.sum("_k").alias("valid"), F.min("_v0").alias("_v0"), F.max("_v1").alias("_v1"), F.min("_l0").alias("_l0"), F.max("_l1").alias("_l1"), *(F.sum(c).alias(c) for c in sums), F.max_by("_m", "bucket").alias("_top"), F.min_by("_m", F.when(F.col("bucket").isNotNull(), F.col("bucket"))).alias("_bottom"), correlation("bucket", F.when(F.col("bucket").isNotNull(), F.col("_m"))).alias("_mono"), *(F.max(F.when(F.col("bucket") == j, F.col("_m"))).alias(f"_d{j}") for j in range(1, n + 1)))
    q = F.when(F.col("valid") < 3, "insufficient_sample").when(F.col("_v0") == F.col("_v1"), "constant_factor").when(F.col("_l0") == F.col("_l1"), "constant_label").otherwise("ready")
    ready = lambda c: F.when(F.col("quality") == "ready", c)
    c = F.col
    covered = c("_sxy") - c("_sx") * c("_sy") / c("valid")
    spread = F.sqrt(c("_sxx") - c("_sx") * c("_sx") / c("valid")) * F.sqrt(c("_syy") - c("_sy") * c("_sy") / c("valid"))
    out = whole.withColumn("quality", q).withColumn("rank_ic", ready(ratio(covered, spread)))
    return out.select(*by, "total", "valid", (c("valid") / c("total")).alias("coverage"), "quality", "rank_ic", ready(c("_top") - c("_bottom")).alias("top_bottom"), ready(c("_mono")).alias("monotonicity"), (c("rank_ic") > 0).cast("int").alias("win"), *(ready(c(f"_d{j}")).alias(f"decile_{j}") for j in range(1, n + 1)))


def effective_metrics(sample: DataFrame, by: list[str], value: str, label: str, symbol: str, **recipe) -> DataFrame:
    """The same metrics on preprocessed values."""
    return factor_metrics(preprocess_factor(sample, by, value, out="_pure", **recipe), by, "_pure", label, symbol)


def hac_tstat(values: Column, least: int = 3) -> Column:
    """Newey-West t of the mean of an ordered array of at most a few hundred values; lag max(1, floor(4 (n/100)^(2/9))), below n."""
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / n
    centred = F.transform(values, lambda x: x - mean)
    lag = F.greatest(F.lit(1), F.least(n - 1, F.greatest(F.lit(1), F.floor(4 * F.pow(n / 100, F.lit(2 / 9)))))).cast("int")

    def gamma(k: Column) -> Column:
        pairs = F.zip_with(F.slice(centred, F.lit(1), n - k), F.slice(centred, k + 1, n - k), lambda a, b: a * b)
        return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / n

    weighted = F.aggregate(F.transform(F.sequence(F.lit(1), lag), lambda k: 2 * (1 - k / (lag + 1)) * gamma(k)), F.lit(0.0), lambda a, x: a + x)
    variance = gamma(F.lit(0)) + weighted
    return F.when((n >= least) & (variance > 1e-18), mean / F.sqrt(variance / n))


def icir_summary(metrics: DataFrame, by: list[str], value: str = "rank_ic") -> DataFrame:
    return metrics.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.avg((F.col(value) > 0).cast("double")).alias("positive_rate"), F.sum(value).alias("total")).withColumn("icir", ratio(F.col("mean"), F.col("std")))


def performance_windows(metrics: DataFrame, by: list[str], at: str, sizes: tuple[int, ...] = (5, 20, 60, 252), direction: int = 1, as_of=None, maturity: str | None = None, pure: str = "pure_") -> DataFrame:
    """Statistics of the last metric rows of each identity for several window sizes.

    Rows count whether or not they hold an IC; only those that were made and had matured by `as_of` do. A window is
    complete if as many ICs as its size are there. Columns of the same names led by `pure` give the same statistics of
    the controlled factor; a factor_autocorrelation column gives its mean and the turnover proxy. `direction` turns the
    sign of ICs, not of spreads.
    """
    known = metrics
    if as_of is not None:
        known = known.where((F.col(at) <= as_of) & (F.col(maturity) <= as_of if maturity else F.lit(True)))
    known = known.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(at)))).where(F.col("_k") <= max(sizes))
    rows = known.withColumn("window", F.explode(F.filter(F.array(*map(F.lit, sizes)), lambda s: F.col("_k") <= s)))
    has = set(metrics.columns)

    def of(p: str) -> tuple[dict[str, Column], dict[str, Column]]:
        """What is aggregated, and what follows from it; p: the prefix."""
        ic = F.col(f"{p}rank_ic") * direction
        series = F.transform(F.array_sort(F.collect_list(F.when(ic.isNotNull(), F.struct(at, ic.alias("v"))))), lambda x: x["v"])  # `window` values
        rate = lambda c: F.avg((c > 0).cast("double"))
        held = {f"_{p}raw": F.avg(f"{p}rank_ic"), f"{p}direction_adjusted_ic": F.avg(ic), f"{p}observation_days": F.count(ic), f"_{p}sd": F.stddev_samp(ic), f"_{p}v": series, f"{p}ic_win_rate": rate(ic), f"{p}cumulative_ic": F.coalesce(F.sum(ic), F.lit(0.0))}
        if f"{p}top_bottom" in has:
            held |= {f"{p}cumulative_long_short": F.coalesce(F.sum(f"{p}top_bottom"), F.lit(0.0)), f"{p}long_short_same_direction": rate(F.col(f"{p}top_bottom"))}
        if f"{p}monotonicity" in has:
            held[f"{p}monotonic_same_direction"] = rate(F.col(f"{p}monotonicity"))
        return held, {f"{p}historical_ic": F.col(f"_{p}raw"), f"{p}icir": F.when(F.col(f"_{p}sd") > 0, F.col(f"{p}direction_adjusted_ic") / F.col(f"_{p}sd")), f"{p}hac_t": hac_tstat(F.col(f"_{p}v")), f"{p}complete": F.col(f"{p}observation_days") >= F.col("window")}

    kinds = [of(p) for p in ("", pure) if f"{p}rank_ic" in has]
    plain = {f"average_{name}": F.avg(c) for c, name in (("coverage", "coverage"), ("valid", "sample_count")) if c in has}
    plain |= {"factor_autocorrelation": F.avg("factor_autocorrelation")} if "factor_autocorrelation" in has else {}
    plain |= {c: F.avg(c) for c in metrics.columns if c.startswith("decile_")}
    held = {k: v for own, _ in kinds for k, v in own.items()} | plain
    out = rows.groupBy(*by, "window").agg(F.min(at).alias("first_date"), F.max(at).alias("last_date"), *(v.alias(k) for k, v in held.items()))
    shown = [k for k in held if not k.startswith("_")]
    late = [v.alias(k) for _, made in kinds for k, v in made.items()]
    turn = [(1 - F.col("factor_autocorrelation")).alias("rank_turnover_proxy")] if "factor_autocorrelation" in has else []
    return out.select(*by, "window", "first_date", "last_date", *shown, *late, *turn)


def factor_autocorrelation(values: DataFrame, pairs: DataFrame, by: list[str], value: str, symbol: str, at: str = "trade_date") -> DataFrame:
    """Rank correlation of each section with the one of the session before."""
    before = pairs.select(F.col("maturity_date").alias(at), F.col("signal_date").alias("_before"))
    old = values.select(*by, symbol, F.col(at).alias("_before"), F.col(value).alias("_old"))
    both = values.where(F.col(value).isNotNull()).join(before, at).join(old.where("_old is not null"), [*by, symbol, "_before"])
    section = [*by, at]
    ranked = both.withColumn("_x", rank_pct(value, section)).withColumn("_y", rank_pct("_old", section))
    return ranked.groupBy(*section).agg(F.count("*").alias("n"), correlation("_x", "_y").alias("autocorrelation"))


def observation_rows(values: DataFrame, at: str, value: str, computed: str, available: str | None = None, flag: str | None = None) -> DataFrame:
    """Observations: missing if null, invalid by flag, unavailable if available only after they were computed.

    Values are available at 19:00 of their date unless a column says otherwise.
    """
    default = F.col(at).cast("timestamp") + F.expr("interval 19 hours")
    seen = F.coalesce(F.col(available), default) if available else default
    quality = F.when(F.col(value).isNull(), "missing").when(F.coalesce(F.col(flag), F.lit(False)) if flag else F.lit(False), "invalid").when(F.col("available_at") > F.col(computed), "unavailable").otherwise("complete")
    return values.withColumn("available_at", seen).withColumn("quality", quality)


#: Names under which fund columns are published.
ETF_NAMES = {"ret_20": "trend_return_20d", "ret_5": "trend_return_5d", "vol_20": "volatility_20d", "amount_ratio": "amount_ratio_20d", "drawdown_20": "drawdown_20d"}


def etf_observations(panel: DataFrame, ids: list[str], columns: dict[str, str] | None = None) -> DataFrame:
    names = {c: n for c, n in (columns or ETF_NAMES).items() if c in panel.columns}
    return panel.select(*ids, *(F.col(c).cast("double").alias(n) for c, n in names.items())).unpivot(ids, list(names.values()), "factor", "value")


def frozen_sample(observations: DataFrame, by: list[str], identity: list[str], reason: str) -> DataFrame:
    """Counts by availability reason and a SHA-256 of the sample's identity, for each section.

    The identity is that of the rows' SHA-256 in order, so it depends on the set of rows alone. Rows are hashed and
    folded in 4096 hash ranges of a section, each to one SHA-256 of its sorted hashes, and the ranges' in turn; so no
    section is ever gathered in one place.
    """
    row = F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity)), 256)
    n = lambda name: F.sum((F.col(reason) == name).cast("long")).alias(name)
    folded = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), ""), 256)
    parts = observations.withColumn("_h", row).groupBy(*by, F.substring("_h", 1, 3).alias("_p")).agg(F.count("*").alias("n"), n("complete"), n("missing"), n("unavailable"), folded("_h").alias("_d"))
    return parts.groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("n", "complete", "missing", "unavailable")), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_d"))), lambda x: F.concat(x["_p"], x["_d"])), ""), 256).alias("sample_sha256"))
