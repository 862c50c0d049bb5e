"""Row projections, quality rules, codes, calendars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import same_within


def normalize_suspensions(rows: DataFrame, code: str = "ts_code", at: str = "trade_date", kind: str = "suspend_type") -> tuple[DataFrame, DataFrame]:
    """(one flag row for each code and date of type S, rows of unknown types). Type R, resumption, goes."""
    known = F.coalesce(F.col(kind).isin("S", "R"), F.lit(False))
    flags = rows.where(F.col(kind) == "S").select(code, at).dropDuplicates().withColumn("is_suspended", F.lit(1))
    return flags, rows.where(~known)


def unpivot_wide(rows: DataFrame, ids: list[str], columns: dict[str, str], name: str, value: str) -> DataFrame:
    """Columns as rows under new names; blanks and values that aren't numbers go."""
    long = rows.select(*ids, *(F.col(c).cast("string").alias(c) for c in columns)).unpivot(ids, list(columns), name, value)
    names = F.create_map(*(F.lit(x) for pair in columns.items() for x in pair))
    return long.withColumn(name, names[F.col(name)]).withColumn(value, F.trim(value).try_cast("double")).where(F.col(value).isNotNull())


def interval_to_daily(intervals: DataFrame, calendar: DataFrame, key: str, start: str, end: str, at: str, mark: Column, flag: str) -> DataFrame:
    """A flag for each open date inside a marked interval, both ends included; an open end lasts as the calendar does."""
    days = calendar.select(F.col(at))
    span = intervals.where(mark).select(key, start, end)
    inside = (F.col(at) >= F.col(start)) & (F.col(at) <= F.coalesce(F.col(end), F.col(at)))
    # intervals become (key, month) rows, so the range join is an equi-join on months
    last = days.agg(F.max(at).alias("_last"))
    months = span.crossJoin(F.broadcast(last)).where(F.col(start) <= F.coalesce(F.col(end), F.col("_last"))).withColumn("_m", F.explode(F.sequence(F.trunc(start, "month"), F.trunc(F.coalesce(F.col(end), F.col("_last")), "month"), F.expr("interval 1 month"))))
    return months.join(days.withColumn("_m", F.trunc(at, "month")), "_m").where(inside).select(key, at).distinct().withColumn(flag, F.lit(1))


def register_quality_rule(registry: dict[str, dict[str, Column]], dataset: str, name: str, predicate: Column | str) -> dict[str, dict[str, Column]]:
    """The registry with one rule more; the predicate, a column or SQL text, is true for a bad row. A name counts once."""
    if name in registry.get(dataset, {}):
        raise ValueError(f"{dataset} has a rule {name} already")
    return registry | {dataset: registry.get(dataset, {}) | {name: F.expr(predicate) if isinstance(predicate, str) else predicate}}


def quality_failures(df: DataFrame, dataset: str, required: list[str], rules: dict[str, Column], null_share: float = 0.01) -> DataFrame:
    """(dataset, rule, rows, bad, failed) in one pass; a rule's column is true for a bad row."""
    checks = {**{f"null:{c}": F.col(c).isNull() for c in required}, **rules}
    found = df.agg(F.count("*").alias("rows"), *(F.coalesce(F.sum(F.when(x, 1).otherwise(0)), F.lit(0)).alias(f"c{k}") for k, x in enumerate(checks.values())))
    table = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"c{k}").cast("long").alias("bad"), F.lit(null_share if n.startswith("null:") else 0.0).alias("share")) for k, n in enumerate(checks)))).alias("x")
    return found.select(F.lit(dataset).alias("dataset"), "rows", table).select("dataset", "x.rule", "rows", "x.bad", (F.col("x.bad") > F.col("x.share") * F.col("rows")).alias("failed"))


def inside_bar(o: str = "open", h: str = "high", l: str = "low", c: str = "close") -> Column:  # noqa: E741
    return (F.col(l) <= F.least(o, c)) & (F.col(h) >= F.greatest(o, c))


def candle_issues(bars: DataFrame, key: list[str]) -> DataFrame:
    """One row for each fault of a bar: a price that is no positive number, a boundary broken, an invalid volume."""
    number = lambda c: F.coalesce(F.col(c) > 0, F.lit(False)) & ~F.isnan(c) & (F.col(c) < float("inf"))
    priced = reduce(lambda a, b: a & b, [number(c) for c in ("open", "high", "low", "close")])
    volume = F.coalesce((F.col("volume") >= 0) & (F.col("volume") < float("inf")), F.lit(False))
    issues = F.array_compact(F.array(F.when(~priced, "invalid_price"), F.when(priced & ~inside_bar(), "ohlc_boundary"), F.when(~volume, "invalid_volume")))
    return bars.select(*key, F.explode(issues).alias("issue"))


#: Ordered keyword rules of fund styles and the default.
STYLE_RULES = [
    (r"货币|现金", "货币"), (r"国债|信用债|公司债|可转债|债", "债券"), (r"黄金|豆粕|有色期货|能源化工", "商品"), (r"恒生|港股|h股|中概", "港股"),
    (r"纳斯达克|标普|日经|德国|法国|美国", "海外"), (r"银行|证券|保险|金融|券商", "金融"), (r"医药|医疗|生物|疫苗|创新药", "医药"), (r"半导体|芯片|集成电路", "半导体"),
    (r"人工智能|软件|计算机|云计算|大数据|信创", "科技"), (r"通信|5g|电子|消费电子", "电子通信"), (r"新能源|光伏|锂电|电池|储能", "新能源"), (r"军工|国防|航空|航天", "军工"),
    (r"消费|食品|饮料|白酒|家电|旅游", "消费"), (r"煤炭|钢铁|有色|化工|石油|资源|稀土", "周期"), (r"地产|基建|建材|电力|公用", "基建公用"), (r"红利|股息|低波", "红利"), (r"传媒|游戏|影视|教育", "传媒"),
]
BROAD_RULE = (r"沪深300|中证500|中证1000|上证50|创业板|科创50|中证a500|a50|深证100|上证综指", "宽基")
OTHER_STYLE = "其他"


def classify_style(df: DataFrame, name: str, rules: list[tuple[str, str]] | None = None, default: str = OTHER_STYLE, out: str = "style") -> DataFrame:
    from tickloom.functions.scalars import first_rule

    return df.withColumn(out, first_rule(F.coalesce(F.col(name), F.lit("")), rules or [*STYLE_RULES, BROAD_RULE], default))


def canonical_codes(rows: DataFrame, aliases: DataFrame, code: str, at: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows under canonical codes, conflicts). Aliases: legacy, canonical, switch_date.

    Where both codes have a row for a date, the legacy one wins before the switch and the canonical one from it on;
    values that differ beyond tolerance are conflicts.
    """
    known = aliases.select(F.col("legacy").alias(code), "canonical", "switch_date")  # a fixed list of code changes
    switch = aliases.select(F.col("canonical").alias("_code"), F.col("switch_date").alias("_switch"))
    tagged = rows.join(known, code, "left").withColumn("_legacy", F.col("canonical").isNotNull()).withColumn("_code", F.coalesce("canonical", code)).drop("switch_date")
    tagged = tagged.join(switch, "_code", "left").withColumn("_preferred", F.col("_legacy") == (F.col(at) < F.col("_switch")))
    w = Window.partitionBy("_code", at)
    first = tagged.withColumn("_k", F.row_number().over(w.orderBy(F.desc("_preferred"), code)))
    clash = reduce(lambda a, b: a | b, [~same_within(F.min(v).over(w), F.max(v).over(w)) for v in values])
    first = first.withColumn("_clash", F.coalesce(clash, F.lit(False)))
    kept = [F.col("_code").alias(code), *(c for c in rows.columns if c != code)]
    return first.where("_k = 1").select(*kept), first.where("_clash and _k = 1").select(F.col("_code").alias(code), at)


def drop_proven_alias_rows(legacy: DataFrame, aliases: DataFrame, canonical: DataFrame, universe: DataFrame, code: str, at: str, values: list[str]) -> DataFrame:
    """Legacy rows, without those whose canonical key is in the universe and holds exactly the same values."""
    tagged = legacy.join(aliases.select(F.col("legacy").alias(code), "canonical"), code, "left")
    twin = canonical.join(universe.select(code, at).distinct(), [code, at], "left_semi").select(F.col(code).alias("_c"), F.col(at).alias("_t"), *(F.col(v).alias(f"_{v}") for v in values))
    same = reduce(lambda a, b: a & b, [F.col(v).eqNullSafe(F.col(f"_{v}")) for v in values])
    return tagged.join(twin, (F.col("canonical") == F.col("_c")) & (F.col(at) == F.col("_t")) & same, "left_anti").select(*legacy.columns)


def latest_revision(rows: DataFrame, key: list[str], flag: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the row of the highest flag for each key, keys whose highest flag has rows that differ)."""
    w = Window.partitionBy(*key)
    top = rows.withColumn("_top", F.max(flag).over(w)).where(F.col(flag).eqNullSafe(F.col("_top")))
    one = F.struct(*values)
    marked = top.withColumn("_x", F.min(one).over(w)).withColumn("_y", F.max(one).over(w)).withColumn("_k", F.row_number().over(w.orderBy(*values)))
    return marked.where("_k = 1").select(*rows.columns), marked.where("_k = 1 and not (_x <=> _y)").select(*key)


def session_filter(bars: DataFrame, calendar: DataFrame, zone: str, at: str = "ts") -> DataFrame:
    """Bars within [open_minute, close_minute) of their local date's session; closed days have no row."""
    local = F.from_utc_timestamp(at, zone)
    rows = bars.withColumn("trade_date", F.to_date(local)).withColumn("_minute", F.hour(local) * 60 + F.minute(local))
    found = rows.join(calendar.select("trade_date", "open_minute", "close_minute"), "trade_date")
    return found.where((F.col("_minute") >= F.col("open_minute")) & (F.col("_minute") < F.col("close_minute"))).drop("_minute", "open_minute", "close_minute")


def calendar_days(low: str | Column, high: str | Column, spark) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(low).cast("date"), F.lit(high).cast("date"))).alias("cal_date"))


def trading_sessions(calendar: DataFrame, low: str, high: str) -> tuple[DataFrame, DataFrame]:
    """(open dates, dates of [low, high] that the calendar lacks)."""
    days = calendar_days(low, high, calendar.sparkSession)
    found = days.join(calendar.select("cal_date", "is_open"), "cal_date", "left")
    return found.where("is_open = 1").select(F.col("cal_date").alias("trade_date")), found.where("is_open is null").select("cal_date")


def session_pairs(sessions: DataFrame, at: str = "trade_date") -> DataFrame:
    """Each open session and the one after it; the last has none and goes. A calendar is a few thousand rows."""
    return sessions.select(F.col(at).alias("signal_date"), F.lead(at).over(Window.orderBy(at)).alias("maturity_date")).where("maturity_date is not null")


def dividend_overrides(rows: DataFrame, corrections: DataFrame, key: list[str], value: str = "dividend") -> tuple[DataFrame, DataFrame]:
    """(rows with corrected dividends, corrections whose expected source value isn't there). A fixed, short list."""
    fix = corrections.select(*key, F.col("source_value"), F.col("corrected_value"))
    found = rows.join(fix, key, "left")
    right = same_within(value, "source_value")
    fixed = found.withColumn(value, F.when(F.col("corrected_value").isNotNull() & right, F.col("corrected_value")).otherwise(F.col(value)))
    return fixed.select(*rows.columns), found.where(F.col("corrected_value").isNotNull() & ~right).select(*key)


def holder_change_sign(kind: str = "in_de", volume: str = "change_vol") -> Column:
    return F.when(F.col(kind) == "IN", F.col(volume)).when(F.col(kind) == "DE", -F.col(volume))


def forecast_mid(low: str, high: str) -> Column:
    """The mean of both ends, or the one that is there."""
    return (F.coalesce(F.col(low), F.col(high)) + F.coalesce(F.col(high), F.col(low))) / 2


def identity_review(rows: DataFrame, symbol: str, kind: str, start: str, end: str) -> DataFrame:
    """Symbols that need review: several rows, types that differ, or windows that overlap.

    Overlap needs no pairs: in order of starts, a row overlaps an earlier one if it starts before the latest end so far.
    """
    w = Window.partitionBy(symbol).orderBy(start, end)
    before = F.max(F.coalesce(F.col(end), F.lit("9999-12-31").cast("date"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_overlap", F.coalesce(F.col(start) <= before, F.lit(False)))
    agg = marked.groupBy(symbol).agg(F.count("*").alias("n"), F.countDistinct(kind).alias("kinds"), F.max(F.col("_overlap").cast("int")).alias("overlaps"))
    return agg.where("n > 1").withColumn("type_conflict", F.col("kinds") > 1).withColumn("window_overlap", F.col("overlaps") == 1).drop("kinds", "overlaps")


def alias_ownership(rows: DataFrame, alias: str, order: list[str]) -> DataFrame:
    """The first claimant of each alias keeps it; the others are marked."""
    w = Window.partitionBy(alias).orderBy(*order)
    return rows.withColumn("owns_alias", F.row_number().over(w) == 1)


def latest_view(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    from tickloom.sources.tables import newest

    return newest(rows, key, order)


def rename_index_fields(rows: DataFrame) -> DataFrame:
    """A provider's index rows in our spelling: pct_change is pct_chg, and an absent pre_close is null."""
    if "pct_change" not in rows.columns or "pct_chg" in rows.columns:
        raise ValueError("index rows hold pct_change and no pct_chg")
    out = rows.withColumnRenamed("pct_change", "pct_chg")
    return out if "pre_close" in rows.columns else out.withColumn("pre_close", F.lit(None).cast("double"))


def ohlc_inside(open_: str = "open", high: str = "high", low: str = "low", close: str = "close") -> Column:
    """Low, then open and close, then high; false where a price is missing."""
    return F.coalesce((F.col(low) <= F.least(open_, close)) & (F.greatest(open_, close) <= F.col(high)) & F.col(open_).isNotNull() & F.col(close).isNotNull(), F.lit(False))
