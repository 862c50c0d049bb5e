"""Grids, gaps, islands and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.joins import asof_backward

from tickloom.functions.scalars import same_within


def time_grid(series: DataFrame, key: list[str], low: str, high: str, step: str, out: str = "ts") -> DataFrame:
    """Every step from low to high of each series; low and high are columns."""
    return series.select(*key, F.explode(F.sequence(F.col(low), F.col(high), F.expr(f"interval {step}"))).alias(out))


def gap_grid(rows: DataFrame, expected: DataFrame, key: list[str], at: str) -> DataFrame:
    """(key, time, issue): missing from the expected grid, extra to it, or duplicate."""
    n = rows.groupBy(*key, at).agg(F.count("*").alias("n"))
    both = expected.select(*key, at).distinct().withColumn("_e", F.lit(1)).join(n, [*key, at], "full")
    issue = F.when(F.col("n").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(F.col("n") > 1, "duplicate")
    return both.withColumn("issue", issue).where("issue is not null").select(*key, at, "issue")


def islands(rows: DataFrame, key: list[str], at: str, split_days: int | None = None) -> DataFrame:
    """Runs of consecutive dates of each key, if asked cut every split_days: start, end, days."""
    w = Window.partitionBy(*key).orderBy(at)
    runs = rows.select(*key, at).distinct().withColumn("_g", F.date_sub(F.col(at), F.row_number().over(w)))
    group = [*key, "_g"]
    if split_days:
        runs = runs.withColumn("_p", F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(at)) - 1) / split_days))
        group.append("_p")
    return runs.groupBy(*group).agg(F.min(at).alias("start_date"), F.max(at).alias("end_date"), F.count("*").alias("days")).select(*key, "start_date", "end_date", "days")


def missing_ranges(calendar: DataFrame, reserved: DataFrame, key: list[str], at: str, split_days: int = 7) -> DataFrame:
    """Dates of each key's calendar that no reserved [start, end] holds, as ranges of at most split_days."""
    held = reserved.select(*key, F.explode(F.sequence("start_date", "end_date")).alias(at)).distinct()
    return islands(calendar.join(held, [*key, at], "left_anti"), key, at, split_days)


def continuous_coverage(intervals: DataFrame, key: list[str], start: str, end: str, days: int = 1) -> DataFrame:
    """Intervals that overlap or touch as one: a new island begins past the latest end so far."""
    w = Window.partitionBy(*key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col(start) > F.date_add(before, days)), 1).otherwise(0)
    marked = intervals.withColumn("_new", fresh).withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*key, "_i").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("merged")).drop("_i")


def date_set_audit(rows: DataFrame, reference: DataFrame, key: str, at: str) -> DataFrame:
    """For each series: dates that the reference lacks, reference dates missing between its own first and last, duplicates."""
    n = rows.groupBy(key, at).agg(F.count("*").alias("n"))
    own = n.join(reference.select(at).distinct().withColumn("_in", F.lit(1)), at, "left").groupBy(key).agg(F.count("*").alias("dates"), F.min(at).alias("first_date"), F.max(at).alias("last_date"), F.sum(F.col("_in").isNull().cast("long")).alias("extra"), F.sum((F.col("n") > 1).cast("long")).alias("duplicates"), F.sum(F.coalesce("_in", F.lit(0)).cast("long")).alias("_matched"))
    # ranks of the calendar's dates make the expected number of any span a difference: each end looks up the rank at or before it
    dates = reference.select(at).distinct()
    ranks = dates.withColumn("_r", F.row_number().over(Window.orderBy(at))).select(F.lit(1).alias("_one"), at, "_r")  # a calendar of a few thousand dates
    ends = own.select(F.col("first_date").alias(at)).unionByName(own.select(F.date_add("last_date", 1).alias(at))).distinct().select(F.lit(1).alias("_one"), F.date_sub(at, 1).alias(at))
    found = asof_backward(ends, ranks, ["_one"], at, ["_r"], prefix="to")  # distinct dates only
    rank = lambda day, name: found.select(F.date_add(at, 1).alias(day), F.coalesce("to_r", F.lit(0)).alias(name))
    spans = own.withColumn("_end", F.date_add("last_date", 1)).join(rank("first_date", "_low"), "first_date", "left").join(rank("_end", "_high"), "_end", "left")
    return spans.select(key, "dates", "first_date", "last_date", "extra", (F.col("_high") - F.col("_low") - F.col("_matched")).alias("missing"), "duplicates")


def intraday_session_audit(bars: DataFrame, sessions: DataFrame, symbol: str, minutes: int, at: str = "ts") -> DataFrame:
    """For each symbol and session: expected and present bars, and bars off the grid. Sessions: trade_date, open_ts, close_ts."""
    expected = ((F.col("close_ts").cast("long") - F.col("open_ts").cast("long")) / (60 * minutes)).cast("long")
    grid = sessions.select("trade_date", "open_ts", "close_ts", expected.alias("expected"))
    span = bars.groupBy(symbol).agg(F.min(F.to_date(at)).alias("_a"), F.max(F.to_date(at)).alias("_b"))
    wanted = span.join(F.broadcast(grid), F.col("trade_date").between(F.col("_a"), F.col("_b")))  # a calendar
    on = (F.col("_t") >= F.col("open_ts").cast("long")) & (F.col("_t") < F.col("close_ts").cast("long"))
    rows = bars.select(symbol, F.to_date(at).alias("trade_date"), F.col(at).cast("long").alias("_t"))
    step = (F.col("_t") - F.col("open_ts").cast("long")) % (60 * minutes)
    found = wanted.join(rows, [symbol, "trade_date"], "left")
    out = found.groupBy(symbol, "trade_date", "expected").agg(F.countDistinct(F.when(on & (step == 0), F.col("_t"))).alias("present"), F.sum(F.when(on & (step == 0), 0).when(F.col("_t").isNotNull(), 1).otherwise(0)).alias("off_grid"))
    return out.withColumn("status", F.when(F.col("present") == 0, "missing").when(F.col("present") < F.col("expected"), "sparse").otherwise("complete"))


def bar_reconcile(coarse: DataFrame, fine: DataFrame, key: list[str], bucket: Column, at: str = "ts", relative: float = 1e-8) -> DataFrame:
    """Coarse bars against the resampled fine ones: exact prices, volumes within tolerance."""
    from tickloom.operators.aggregates import bars_resample

    made = bars_resample(fine, key, at, bucket, at).select(*key, at, *(F.col(c).alias(f"f_{c}") for c in ("open", "high", "low", "close", "volume")))
    both = coarse.join(made, [*key, at], "full")
    prices = (F.col("open") == F.col("f_open")) & (F.col("high") == F.col("f_high")) & (F.col("low") == F.col("f_low")) & (F.col("close") == F.col("f_close"))
    status = F.when(F.col("f_close").isNull(), "fine_missing").when(F.col("close").isNull(), "coarse_missing").when(~F.coalesce(prices, F.lit(False)), "price").when(~same_within("volume", "f_volume", 1e-12, relative), "volume").otherwise("equal")
    return both.select(*key, at, status.alias("status"))


def common_ranges(series: list[DataFrame], at: str = "ts") -> DataFrame:
    """Ranges of hours that every series has in full."""
    out = series[0].select(at).distinct()
    for s in series[1:]:
        out = out.intersect(s.select(at).distinct())
    w = Window.orderBy(at)
    run = out.withColumn("_g", (F.col(at).cast("long") / 3600).cast("long") - F.row_number().over(w))
    return run.groupBy("_g").agg(F.min(at).alias("start_ts"), F.max(at).alias("end_ts"), F.count("*").alias("hours")).drop("_g")


def quality_report(bars: DataFrame, key: list[str], at: str, minutes: int) -> DataFrame:
    """Counts of issues by series: invalid, off_grid, ohlc, negative, duplicate."""
    price = F.coalesce((F.col("open") > 0) & (F.col("high") > 0) & (F.col("low") > 0) & (F.col("close") > 0), F.lit(False))
    inside = (F.col("low") <= F.least("open", "close")) & (F.col("high") >= F.greatest("open", "close"))
    off = F.pmod(F.col(at).cast("timestamp").cast("long"), F.lit(60 * minutes)) != 0
    twice = F.count("*").over(Window.partitionBy(*key, at)) > 1
    issues = F.array_compact(F.array(F.when(~price, "invalid"), F.when(off, "off_grid"), F.when(price & ~inside, "ohlc"), F.when(F.col("volume") < 0, "negative"), F.when(F.col("_twice"), "duplicate")))
    return bars.withColumn("_twice", twice).select(*key, F.explode(issues).alias("issue")).groupBy(*key, "issue").agg(F.count("*").alias("n"))


def explained_gaps(gaps: DataFrame, closures: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Gaps with the closure that holds them whole, if any; closures are a short, fixed list."""
    known = closures.select(F.col("start_date").alias("_s"), F.col("end_date").alias("_e"), "reason")
    out = gaps.join(F.broadcast(known), (F.col(start) >= F.col("_s")) & (F.col(end) <= F.col("_e")), "left")
    return out.drop("_s", "_e").withColumn("explained", F.col("reason").isNotNull())


def revision_ranges(calendar: DataFrame, at: str, today: str, recent: int = 2, rotation: int = 12) -> DataFrame:
    """Months to read again: the recent ones, and one older month that rotates with the date."""
    now = F.lit(today).cast("date")
    month = F.to_date(F.date_trunc("month", at))
    age = F.months_between(F.trunc(now, "month"), "month").cast("int")
    turn = recent + F.pmod(F.dayofyear(now), F.lit(rotation))
    return calendar.select(month.alias("month")).distinct().withColumn("age", age).where((F.col("age") >= 0) & ((F.col("age") < recent) | (F.col("age") == turn))).withColumn("reason", F.when(F.col("age") < recent, "recent").otherwise("rotating"))


def code_coverage(observed: DataFrame, expected: DataFrame, dataset: str, code: str, form: str) -> DataFrame:
    """For each dataset: codes observed, expected, missing, unexpected and malformed."""
    o = observed.select(dataset, code).distinct().withColumn("_o", F.lit(1))
    e = expected.select(dataset, code).distinct().withColumn("_e", F.lit(1))
    both = o.join(e, [dataset, code], "full")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).alias
    return both.groupBy(dataset).agg(n(F.col("_o").isNotNull())("observed"), n(F.col("_e").isNotNull())("expected"), n(F.col("_o").isNull())("missing"), n(F.col("_e").isNull())("unexpected"), n(F.col("_o").isNotNull() & ~F.col(code).cast("string").rlike(form))("malformed"))


def data_readiness(counts: DataFrame, required: list[str], date: str) -> DataFrame:
    """Required datasets and whether each is complete for a date; counts: dataset, date, n, expected."""
    names = counts.sparkSession.createDataFrame([(r,) for r in required], "dataset string")
    day = counts.where(F.col("date") == F.lit(date).cast("date"))
    return names.join(day, "dataset", "left").select("dataset", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(F.col("n") >= F.col("expected"), F.lit(False)).alias("ready"))


def metric_freshness(metrics: DataFrame, expected: DataFrame, sessions: DataFrame, key: list[str], at: str, fresh: int = 2) -> DataFrame:
    """State of each expected key at the newest date: ready, missing, duplicate or not_ready, and its lag in sessions."""
    last = metrics.groupBy(*key).agg(F.max(at).alias("last_date"), F.max_by("quality", at).alias("quality"), F.max_by("_n", at).alias("n")) if "_n" in metrics.columns else metrics.withColumn("_n", F.count("*").over(Window.partitionBy(*key, at))).groupBy(*key).agg(F.max(at).alias("last_date"), F.max_by("quality", at).alias("quality"), F.max_by("_n", at).alias("n"))
    order = sessions.select(F.col(at).alias("last_date")).distinct().withColumn("_i", F.row_number().over(Window.orderBy("last_date")))
    newest = order.agg(F.max("_i").alias("_last"))  # one row
    both = expected.select(*key).distinct().join(last, key, "left").join(F.broadcast(order), "last_date", "left").crossJoin(F.broadcast(newest))
    lag = F.col("_last") - F.col("_i")
    status = F.when(F.col("last_date").isNull(), "missing").when(F.col("n") > 1, "duplicate").when(F.col("quality") != "ok", "not_ready").otherwise("ready")
    return both.select(*key, "last_date", status.alias("status"), lag.alias("lag"), F.coalesce(lag <= fresh, F.lit(False)).alias("fresh"))
