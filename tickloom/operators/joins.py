"""As-of, interval and coverage joins. No theta join: as-of joins are one union, one shuffle and one window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import ratio


#: Left rows before the first or after the last segment of the right side are dealt over so many segments.
TAIL = 8


def months(t: Column) -> Column:
    """A whole number for each month, to cut the history of a key by."""
    return F.year(t) * 12 + F.month(t)


def spans(n: int) -> Callable[[Column], Column]:
    """Segments of n units of a numeric time."""
    return lambda t: F.floor(t / n)


def seeds(right: DataFrame, key: list[str], held: str, forward: bool) -> tuple[DataFrame, DataFrame]:
    """What one segment hands to those after it (before it, where time runs backwards).

    right: key, _seg, _t, _seq and `held`. The last row of each segment is repeated once for each following segment up
    to the next one that has rows of its key, so every segment can be worked on alone. Returns these rows, and one row
    with the first and last segment of all.
    """
    order = F.struct("_t", "_seq")
    pick = F.min_by if forward else F.max_by
    marks = right.groupBy(*key, "_seg").agg(*(pick(c, order).alias(c) for c in ("_t", "_seq", held)))
    reach = marks.agg(F.min("_seg").alias("_lo"), F.max("_seg").alias("_hi"))
    w = Window.partitionBy(*key).orderBy("_seg")
    near = F.lag("_seg").over(w) if forward else F.lead("_seg").over(w)
    own = marks.withColumn("_near", near).crossJoin(F.broadcast(reach))  # one row
    to = F.sequence(F.coalesce("_near", F.col("_lo") - TAIL), F.col("_seg") - 1) if forward else F.sequence(F.col("_seg") + 1, F.coalesce("_near", F.col("_hi") + TAIL))
    return own.select(*key, F.explode(to).alias("_seg"), "_t", "_seq", held), reach


def _clamped(seg: Column) -> Column:
    """A left row's segment; beyond the right side's reach, where all rows of a key have one answer, some few segments share them."""
    spread = F.pmod(seg, F.lit(TAIL))
    return F.when(F.col("_hi").isNull(), spread).when(seg > F.col("_hi"), F.col("_hi") + 1 + spread).when(seg < F.col("_lo"), F.col("_lo") - 1 - spread).otherwise(seg)


def _asof(left: DataFrame, right: DataFrame, key: list[str], at: str, values: list[str], seq: str | None, shift, forward: bool, segment) -> DataFrame:
    """Left columns (as _l0, _l1, ...), `_t`, and `_held`, a struct of the right row's time and values.

    Both sides are one frame. With `segment`, a key's history is cut into segments that are windows of their own.
    """
    held = F.struct(F.col(at).alias("_at"), *values).alias("_held")  # never null, so a null value isn't looked through
    order = F.col(seq).cast("long") if seq else F.lit(0).cast("long")
    names = {c: f"_l{k}" for k, c in enumerate(left.columns)}
    keys = [f"_k{k}" for k in range(len(key))]
    by = [F.col(c).alias(k) for c, k in zip(key, keys, strict=True)]
    r = right.select(*by, shift(F.col(at)).alias("_t"), F.lit(0).alias("_side"), order.alias("_seq"), held)
    le = left.select(*by, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.lit(0).cast("long").alias("_seq"), *(F.col(c).alias(n) for c, n in names.items()))
    if segment is not None:
        r = r.withColumn("_seg", segment(F.col("_t")).cast("long"))
        handed, reach = seeds(r, keys, "_held", forward)
        r = r.unionByName(handed.withColumn("_side", F.lit(0)))
        le = le.crossJoin(F.broadcast(reach)).withColumn("_seg", _clamped(segment(F.col("_t")).cast("long"))).drop("_lo", "_hi")  # one row
        keys = [*keys, "_seg"]
    both = le.unionByName(r, allowMissingColumns=True)
    run = [F.desc("_t"), "_side", F.desc("_seq")] if forward else ["_t", "_side", "_seq"]
    w = Window.partitionBy(*keys).orderBy(*run).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_held", F.last("_held", ignorenulls=True).over(w)).where("_side = 1")


def _shown(found: DataFrame, left: DataFrame, values: list[str], prefix: str) -> DataFrame:
    return found.select(*(F.col(f"_l{k}").alias(c) for k, c in enumerate(left.columns)), F.col("_held._at").alias(f"{prefix}at"), *(F.col(f"_held.{v}").alias(f"{prefix}{v}") for v in values))


def asof_backward(left: DataFrame, right: DataFrame, key: list[str], at: str, values: list[str], seq: str | None = None, prefix: str = "", max_age: Column | None = None, segment=None) -> DataFrame:
    """Every left row with the values of the key's latest right row at or before it.

    Among equal times the greatest `seq` wins. A null in the latest row stays null: values of older rows don't show
    through. `{prefix}at` is the right row's time. `max_age`, an interval column, drops older matches. `segment`, such as
    `months` or `spans(n)`, cuts each key's history into parts that are worked on in tasks of their own, for keys with
    long histories or most of the rows.
    """
    found = _asof(left, right, key, at, values, seq, lambda t: t, False, segment)
    if max_age is not None:
        found = found.withColumn("_held", F.when(F.col("_held._at") + max_age >= F.col("_t"), F.col("_held")))
    return _shown(found, left, values, prefix)


def asof_forward(left: DataFrame, right: DataFrame, key: list[str], at: str, values: list[str], seq: str | None = None, prefix: str = "", horizon=None, segment=None) -> DataFrame:
    """Every left row with the key's first right row at or after its time plus `horizon`; the least `seq` wins.

    Time runs backwards, since a frame that reaches forward to the end is computed anew for each row.
    """
    found = _asof(left, right, key, at, values, seq, lambda t: t - horizon if horizon is not None else t, True, segment)
    return _shown(found, left, values, prefix)


def exact_previous_hour(events: DataFrame, prices: dict[str, DataFrame], at: str = "ts") -> DataFrame:
    """Each event with the last full hour before it in several price tables, and a status for each table."""
    out = events.withColumn("_hour", F.date_trunc("hour", at) - F.expr("interval 1 hour"))
    for name, table in prices.items():
        bars = table.select(F.col("ts").alias("_hour"), F.struct("open", "high", "low", "close", "n").alias(f"_{name}"))
        reach = table.agg(F.min("ts").alias(f"_{name}_low"), F.max("ts").alias(f"_{name}_high"))  # one row
        out = out.join(bars, "_hour", "left").crossJoin(F.broadcast(reach))
        b = F.col(f"_{name}")
        inside = (b["high"] >= F.greatest(b["open"], b["close"])) & (b["low"] <= F.least(b["open"], b["close"])) & (b["low"] > 0)
        status = F.when((F.col("_hour") < F.col(f"_{name}_low")) | (F.col("_hour") > F.col(f"_{name}_high")) | F.col(f"_{name}_low").isNull(), "OUTSIDE_BATCH").when(b.isNull(), "MISSING_HOUR").when(b["n"] < 60, "INCOMPLETE_HOUR").when(~F.coalesce(inside, F.lit(False)), "INVALID_OHLC").otherwise("COMPLETE")
        out = out.withColumn(f"{name}_status", status).withColumn(f"{name}_close", F.when(status == "COMPLETE", b["close"])).drop(f"_{name}", f"_{name}_low", f"_{name}_high")
    return out.drop("_hour")


def latest_snapshot_members(dates: DataFrame, members: DataFrame, index: str, at: str, symbol: str) -> DataFrame:
    """(date, index, symbol): members of each index's latest snapshot at or before the date.

    Snapshots are few, so the as-of runs on their dates; members follow by an equi-join.
    """
    snaps = members.select(index, at).distinct()
    wanted = dates.select(at).distinct().crossJoin(F.broadcast(members.select(index).distinct()))  # dates x indices
    found = asof_backward(wanted, snaps, [index], at, [], prefix="snap_")
    rows = members.select(index, F.col(at).alias("snap_at"), symbol)
    return found.where("snap_at is not null").join(rows, [index, "snap_at"]).select(at, index, symbol)


def interval_membership(rows: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, value: str, level: str | None = None, seq: str | None = None) -> DataFrame:
    """Each row with the value whose interval [start, end) holds its date; an open end holds all later dates.

    With levels, level 1 wins where any is there; then the latest start, then the greatest seq. An open interval ends
    for this purpose where the next open one of its key and level starts, as that one wins from there on. Bounded
    intervals meet rows by key and month, so a row isn't held against all of its key's history.
    """
    top = F.when(F.col(level) == 1, 1).otherwise(0) if level else F.lit(0)
    order = [start, *([seq] if seq else []), value]
    marks = intervals.select(key, start, end, value, *(c for c in (seq,) if c), top.alias("_top")).withColumn("_open", F.col(end).isNull())
    following = Window.partitionBy(key, "_top", "_open").orderBy(*order)
    marks = marks.withColumn("_end", F.when(F.col("_open"), F.lead(start).over(following)).otherwise(F.col(end))).where(F.col(start).isNotNull())
    wanted = rows.select(key, at).distinct()
    months = F.sequence(F.trunc(start, "month"), F.trunc("_end", "month"), F.expr("interval 1 month"))
    bounded = marks.where(F.col("_end") > F.col(start)).withColumn("_month", F.explode(months))
    found = wanted.withColumn("_month", F.trunc(at, "month")).join(bounded, [key, "_month"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col("_end"))).drop("_month")
    last = wanted.join(marks.where("_end is null"), key).where(F.col(at) >= F.col(start))  # two intervals of a key at most
    rank = F.struct("_top", *order)
    best = found.unionByName(last).groupBy(key, at).agg(F.max_by(value, rank).alias(value))
    return rows.join(best, [key, at], "left")


def dense_panel(calendar: DataFrame, universe: DataFrame, prices: DataFrame, suspended: DataFrame, others: list[DataFrame], key: str = "symbol", at: str = "trade_date") -> DataFrame:
    """Calendar x universe with as-of prices: exact matches and suspended carry-overs, one row for each key and date.

    Carried rows hold the last close as open, high, low and close, and no volume. Only dates with any price stay.
    No grid is made: a row can only stay where its key has a price or a suspension, so those are the rows asked for.
    Months are worked on apart: prices and suspensions of a month meet in one shuffle, with the last price before it.
    """
    fields = ["open", "high", "low", "close", "volume"]
    seg = months(F.col(at)).cast("long")
    priced = prices.select(key, F.col(at).alias("_t"), F.lit(0).alias("_seq"), F.struct(*fields).alias("_p")).withColumn("_seg", months(F.col("_t")).cast("long"))
    handed, reach = seeds(priced, [key], "_p", False)
    stops = suspended.select(key, at, F.lit(None).alias("_p"), F.lit(True).alias("_stop")).crossJoin(F.broadcast(reach)).withColumn("_seg", _clamped(seg)).drop("_lo", "_hi")  # one row
    rows = stops.unionByName(priced.select(key, F.col("_t").alias(at), "_p", F.lit(False).alias("_stop"), "_seg")).unionByName(handed.select(key, F.col("_t").alias(at), "_p", F.lit(None).alias("_stop"), "_seg"))
    merged = rows.repartition(key, "_seg").groupBy(key, "_seg", at).agg(F.max("_p").alias("_p"), F.max("_stop").alias("_stop"))
    w = Window.partitionBy(key, "_seg").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    found = merged.withColumn("_last", F.last("_p", ignorenulls=True).over(w)).where("_stop is not null and _last is not null")
    open_days = calendar.select(at).distinct().join(prices.select(at).distinct(), at, "left_semi")
    found = found.join(open_days, at, "left_semi").join(universe.select(key).distinct(), key, "left_semi")
    for other in others:
        found = found.join(other, [key, at], "left")
    exact = F.col("_p").isNotNull()
    px = lambda c: F.when(exact, F.col(f"_p.{c}")).otherwise(F.col("_last.close")).alias(c)
    more = [c for o in others for c in o.columns if c not in (key, at)]
    return found.select(key, at, *map(px, fields[:4]), F.when(exact, F.col("_p.volume")).otherwise(0.0).alias("volume"), (~exact).alias("carried"), *more)


def status_panel(prices: DataFrame, tables: list[DataFrame], key: list[str]) -> DataFrame:
    """Prices with the columns of every status table; rows without status keep nulls."""
    for t in tables:
        prices = prices.join(t, key, "left")
    return prices


def basket_join(values: DataFrame, weights: DataFrame, stock: str, basket: str) -> DataFrame:
    """Stock values for each basket that holds the stock."""
    return values.join(weights.select(basket, stock, "weight"), stock)


def self_identity(rows: DataFrame, symbols: DataFrame, identity: DataFrame, at: str, symbol: str) -> DataFrame:
    """Rows of listed symbols, with the identity columns of (date, symbol) where there are any."""
    return rows.join(symbols.select(symbol).distinct(), symbol, "left_semi").join(identity, [at, symbol], "left")


def replace_like(cancels: DataFrame, orders: DataFrame, key: list[str], within: int = 1000, tick: float = 0.02, at: str = "time", seq: str = "seq") -> DataFrame:
    """Cancels with the first order of the same side at their time or later; `replace_like` where it is near in time and price."""
    found = asof_forward(cancels, orders, key, at, ["price"], seq, prefix="next_")
    near = (F.col("next_at") - F.col(at) <= within) & (F.abs(F.col("next_price") - F.col("price")) <= tick)
    return found.withColumn("replace_like", F.coalesce(near, F.lit(False)))


def minute_side_outer(trades: DataFrame, cancels: DataFrame, key: list[str]) -> DataFrame:
    """Traded and cancelled volume of each key, minute and side that has either."""
    both = trades.select(*key, "minute", "side", F.col("volume").alias("traded"), F.lit(0.0).alias("cancelled")).unionByName(cancels.select(*key, "minute", "side", F.lit(0.0).alias("traded"), F.col("volume").alias("cancelled")))
    return both.groupBy(*key, "minute", "side").agg(F.sum("traded").alias("traded"), F.sum("cancelled").alias("cancelled"))


def pair_alignment(left: DataFrame, right: DataFrame, at: str = "ts", price: str = "close") -> DataFrame:
    """Premium of the left price over the right at the times both have."""
    both = left.select(at, F.col(price).alias("left_price")).join(right.select(at, F.col(price).alias("right_price")), at)
    return both.withColumn("premium", ratio("left_price", "right_price") - 1)


def coverage_gaps(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """Keys expected but absent, and keys present but not expected."""
    e, a = expected.select(*key).distinct(), actual.select(*key).distinct()
    return e.join(a, key, "left_anti").withColumn("issue", F.lit("missing")).unionByName(a.join(e, key, "left_anti").withColumn("issue", F.lit("unexpected")))


def next_session(rows: DataFrame, calendar: DataFrame, at: str, session: str = "trade_date") -> DataFrame:
    """Each row with the first open session strictly after its date."""
    days = calendar.select(F.lit(1).alias("_k"), F.col(session).alias(at), F.col(session).alias("_session"))
    asked = rows.select(at).distinct().withColumn("_k", F.lit(1)).where(F.col(at).isNotNull())  # distinct dates only
    found = asof_forward(asked, days, ["_k"], at, ["_session"], prefix="next", horizon=F.expr("interval 1 day"))
    return rows.join(found.select(at, F.col("next_session").alias("next_session")), at, "left")


def point_in_time(dates: DataFrame, facts: DataFrame, key: list[str], at: str, available: str, values: list[str], seq: str | None = None) -> DataFrame:
    """Values of the newest fact that was available at each date."""
    return asof_backward(dates, facts.withColumnRenamed(available, at) if available != at else facts, key, at, values, seq, "pit_")


def point_in_time_events(dates: DataFrame, events: DataFrame, key: str, at: str, announced: str, values: list[str], seq: str, look_back: int = 460) -> DataFrame:
    """As point_in_time, of the last record of each announcement, none older than look_back days."""
    last = events.groupBy(key, F.col(announced).alias(at)).agg(F.max_by(F.struct(*values), seq).alias("x")).select(key, at, "x.*")
    return asof_backward(dates, last, [key], at, values, prefix="pit_", max_age=F.expr(f"interval {look_back} days"))
