"""Comparison, deltas and keyed merges of datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import same_within


def _sides(old: DataFrame, new: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Full outer join by key, null keys included, with each side's values in a struct that is null where it lacks the key."""
    a = old.select(*(F.col(k).alias(f"_a{i}") for i, k in enumerate(key)), F.struct(*values).alias("old"))
    b = new.select(*(F.col(k).alias(f"_b{i}") for i, k in enumerate(key)), F.struct(*values).alias("new"))
    on = reduce(lambda x, y: x & y, [F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(len(key))])
    return a.join(b, on, "full").select(*(F.coalesce(f"_a{i}", f"_b{i}").alias(k) for i, k in enumerate(key)), "old", "new")


def changed_columns(values: list[str], tolerant: bool = False) -> Column:
    differ = lambda v: ~same_within(f"old.{v}", f"new.{v}") if tolerant else ~F.col(f"old.{v}").eqNullSafe(F.col(f"new.{v}"))
    return F.array_compact(F.array(*(F.when(differ(v), F.lit(v)) for v in values)))


def compare_datasets(expected: DataFrame, actual: DataFrame, key: list[str], values: list[str], tolerant: bool = False) -> DataFrame:
    """One row for each key: matched, value_mismatch (with its columns), missing, unexpected or duplicate."""
    twice = actual.groupBy(*key).agg(F.count("*").alias("_n"))
    sides = _sides(expected, actual.dropDuplicates(key), key, values)
    on = reduce(lambda x, y: x & y, [sides[k].eqNullSafe(twice[k]) for k in key])
    diff = F.when(F.col("old").isNotNull() & F.col("new").isNotNull(), changed_columns(values, tolerant))
    rows = sides.withColumn("columns", diff).join(twice, on, "left").select(*(sides[k] for k in key), "old", "new", "columns", "_n")
    status = F.when(F.col("_n") > 1, "duplicate").when(F.col("new").isNull(), "missing").when(F.col("old").isNull(), "unexpected").when(F.size("columns") > 0, "value_mismatch").otherwise("matched")
    return rows.select(*key, status.alias("status"), F.coalesce(F.array_join("columns", ","), F.lit("")).alias("columns"))


def comparison_summary(compared: DataFrame) -> DataFrame:
    return compared.groupBy("status").agg(F.count("*").alias("n"))


def metric_delta(computed: DataFrame, target: DataFrame, key: list[str], values: list[str], version: str) -> DataFrame:
    """Each exact key as same, inserted, changed, newer_in_target or unrelated (in the target only)."""
    sides = _sides(target, computed, key, [*values, version])
    status = F.when(F.col("new").isNull(), "unrelated").when(F.col("old").isNull(), "inserted").when(F.size(changed_columns(values)) == 0, "same").when(F.col(f"old.{version}") > F.col(f"new.{version}"), "newer_in_target").otherwise("changed")
    return sides.select(*key, status.alias("status"))


def merge_retain_absent(old: DataFrame, new: DataFrame, key: list[str], values: list[str], kept: tuple[str, ...] = ()) -> DataFrame:
    """Keyed merge that never deletes: insert, revise, unchanged or retained; `kept` columns stay as they were."""
    sides = _sides(old, new, key, values)
    change = F.when(F.col("new").isNull(), "retained").when(F.col("old").isNull(), "inserted").when(F.size(changed_columns([v for v in values if v not in kept])) > 0, "revised").otherwise("unchanged")
    pick = lambda v: F.when(F.col("new").isNull() | (F.col("old").isNotNull() & F.lit(v in kept)), F.col(f"old.{v}")).otherwise(F.col(f"new.{v}")).alias(v)
    return sides.select(*key, *map(pick, values), change.alias("change"))


def observation_delta(expected: DataFrame, stored: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Keys to write (absent or other), matching keys, and unexpected ones, which are never deleted."""
    sides = _sides(stored, expected, key, values)
    status = F.when(F.col("new").isNull(), "unexpected").when(F.col("old").isNull() | (F.size(changed_columns(values)) > 0), "write").otherwise("matching")
    return sides.select(*key, status.alias("status"))


def missing_series_rows(source: DataFrame, target: DataFrame, key: list[str], value: str) -> DataFrame:
    """Rows that the target lacks, and rows whose old value changed, which must stop a publication."""
    sides = _sides(target, source, key, [value])
    status = F.when(F.col("new").isNull(), "target_only").when(F.col("old").isNull(), "append").when(same_within(f"old.{value}", f"new.{value}"), "same").otherwise("changed")
    return sides.select(*key, F.col(f"new.{value}").alias(value), status.alias("status"))


def source_agreement(copies: DataFrame, key: list[str], values: list[str], relative: float = 1e-8) -> DataFrame:
    """Whether several sources' copies of a key agree within tolerance; and how many there are."""
    agree = reduce(lambda a, b: a & b, [same_within(F.min(v), F.max(v), 0.0, relative) for v in values])
    return copies.groupBy(*key).agg(F.count("*").alias("copies"), agree.alias("agree"))


def pending_sections(plan: DataFrame, coverage: DataFrame, key: list[str], at: str, oldest: int) -> DataFrame:
    """Planned sections that need work and why: missing, physical_gap, partial_source or input_revised; the oldest dates."""
    both = plan.join(coverage, [*key, at], "left")
    reason = F.when(F.col("stored").isNull(), "missing").when(F.col("stored") < F.col("expected"), "physical_gap").when(F.col("source_rows") < F.col("source_expected"), "partial_source").when(~F.col("fingerprint").eqNullSafe(F.col("planned_fingerprint")), "input_revised")
    open_ = both.withColumn("reason", reason).where("reason is not null")
    dates = open_.select(at).distinct().orderBy(at).limit(oldest)
    return open_.join(F.broadcast(dates), at, "left_semi").select(*key, at, "reason")  # `oldest` dates


def warm_up_days(look_back: int) -> int:
    return max(460, -(-16 * look_back // 10) + 7)


def panel_key_audit(rows: DataFrame, security: str, ticker: str, at: str) -> DataFrame:
    """For each security: rows, first and last date, duplicates by id and by ticker, prices that break their bar."""
    by_id = F.count("*").over(Window.partitionBy(security, at))
    by_ticker = F.count("*").over(Window.partitionBy(ticker, at))
    bad = ~((F.col("low") <= F.least("open", "close")) & (F.col("high") >= F.greatest("open", "close")))
    marked = rows.select(security, at, (by_id > 1).cast("long").alias("i"), (by_ticker > 1).cast("long").alias("t"), F.coalesce(bad, F.lit(True)).cast("long").alias("b"))
    return marked.groupBy(security).agg(F.count("*").alias("n"), F.min(at).alias("first_date"), F.max(at).alias("last_date"), F.sum("i").alias("duplicate_ids"), F.sum("t").alias("duplicate_tickers"), F.sum("b").alias("broken_bars"))


def bundle_verify(expected: DataFrame, stored: DataFrame, key: list[str], values: list[str], at: str) -> DataFrame:
    """A view computed again against what is stored: rows by month and status, and whether the month is the same."""
    months = compare_datasets(expected, stored, key, values).groupBy(F.trunc(at, "month").alias("month"))
    out = months.agg(F.count("*").alias("n"), F.count_if(F.col("status") == "matched").alias("matched"))
    return out.withColumn("verified", F.col("n") == F.col("matched"))
