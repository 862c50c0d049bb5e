"""Hand-written rows: nulls, ties, single rows, empty frames, duplicates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.model import Dataset, Field
from tickloom.operators import coverage, crosssection, joins, merge, rows, timeseries
from tickloom.plans import market
from tickloom.sources import readers, tables
from tickloom.streaming import minutes

D = dt.date


def test_clean_and_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (float("inf"), 1.0), (1.0, 0.0)], "a double, b double")
    got = [tuple(r) for r in df.select(scalars.clean("a"), scalars.ratio(scalars.clean("a"), "b")).collect()]
    assert got == [(1.0, 0.5), (None, None), (None, None), (1.0, None)]


def test_asof_latest_null_stays_null_and_last_seq_wins(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 5)], "k string, t int")
    right = spark.createDataFrame([("a", 2, 1, 10.0), ("a", 2, 2, 20.0), ("a", 4, 1, None)], "k string, t int, seq int, v double")
    got = {(r.k, r.t): (r["at"], r.v) for r in joins.asof_backward(left, right, ["k"], "t", ["v"], "seq").collect()}
    assert got == {("a", 5): (4, None), ("a", 1): (None, None), ("b", 5): (None, None)}
    three = spark.createDataFrame([("a", 3)], "k string, t int")
    assert joins.asof_backward(three, right, ["k"], "t", ["v"], "seq").first().v == 20.0
    assert joins.asof_backward(left.where("false"), right, ["k"], "t", ["v"], "seq").count() == 0


def test_rank_pct_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (1, "c", 3.0), (1, "d", None)], "d int, s string, v double")
    got = {r.s: r.p for r in df.select("s", crosssection.rank_pct("v", ["d"]).alias("p")).collect()}
    assert got == {"a": 0.5, "b": 0.5, "c": 1.0, "d": None}


def test_constant_window_has_zero_deviation_and_correlation_is_missing(spark):
    from tickloom.functions import rolling

    df = spark.createDataFrame([("a", k, 0.1) for k in range(5)], "s string, t int, v double")
    w = rolling.ordered("s", "t")
    got = [r.x for r in df.select(rolling.rolling_std("v", 3, 2, w).alias("x")).collect()]
    assert got == [None, 0.0, 0.0, 0.0, 0.0]
    assert df.agg(scalars.correlation("v", "t").alias("c")).first().c is None


def test_ema_keeps_state_across_a_gap(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("a", 3, 4.0)], "s string, t int, v double")
    got = [r.e for r in timeseries.ema(df, ["s"], "t", {"e": ("v", 3)}).orderBy("t").collect()]
    assert got[:2] == [1.0, 1.0] and got[2] == pytest.approx((0.25 * 1 + 0.5 * 4) / 0.75)


def test_neutral_residuals_have_no_industry_mean(spark):
    df = spark.createDataFrame([(1, f"s{k}", float(k * k % 17), float(k), k % 3) for k in range(40)], "d int, s string, v double, size double, i int")
    out = crosssection.neutralize(df, ["d"], "v", "size", "i")
    assert all(abs(r.m) < 1e-9 for r in out.groupBy("i").agg(F.avg("neutral").alias("m")).collect())


def test_weights_sum_to_one(spark):
    df = spark.createDataFrame([("e", "a", 1.0, 5.0, 1), ("e", "b", 3.0, 5.0, 2), ("f", "a", None, None, 1), ("f", "b", None, None, 2)], "e string, s string, r double, m double, q int")
    got = {(r.e, r.s): r.weight for r in crosssection.normalize_weights(df, "e", "s", "r", "m", "q").collect()}
    assert got == {("e", "a"): 0.25, ("e", "b"): 0.75, ("f", "a"): 0.5, ("f", "b"): 0.5}


def test_compare_reports_every_kind(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (None, 9.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0), (2, 5.0), (4, 4.0), (4, 4.0), (None, 9.0)], "k int, v double")
    got = {r.k: (r.status, r.columns) for r in merge.compare_datasets(a, b, ["k"], ["v"]).collect()}
    assert got == {1: ("matched", ""), 2: ("value_mismatch", "v"), 3: ("missing", ""), 4: ("duplicate", ""), None: ("matched", "")}


def test_islands_and_touching_intervals(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1)), ("a", D(2024, 1, 2)), ("a", D(2024, 1, 2)), ("a", D(2024, 1, 5))], "s string, d date")
    got = sorted((r.start_date.day, r.end_date.day) for r in coverage.islands(df, ["s"], "d").collect())
    assert got == [(1, 2), (5, 5)]
    spans = spark.createDataFrame([("a", D(2024, 1, 1), D(2024, 1, 9)), ("a", D(2024, 1, 2), D(2024, 1, 3)), ("a", D(2024, 1, 10), D(2024, 1, 11)), ("a", D(2024, 1, 13), D(2024, 1, 14))], "s string, x date, y date")
    got = sorted((r.x.day, r.y.day, r.merged) for r in coverage.continuous_coverage(spans, ["s"], "x", "y").collect())
    assert got == [(1, 11, 3), (13, 14, 1)]


def test_contract_rows_and_rejects(spark):
    ds = Dataset("x", (Field("id", "bigint", "ID", True), Field("day", "date", "DAY", formats=("yyyyMMdd", "yyyy-MM-dd")), Field("v", "double", "V", sentinels=("-",)), Field("gone", "int")), ("id",))
    raw = spark.createDataFrame([("1", "20240102", "-"), ("2", "2024-01-03", "x"), ("", "20240101", "1"), ("3", None, "2.5")], "ID string, DAY string, V string")
    good, bad = readers.contract_rows(raw, ds)
    assert sorted(tuple(r) for r in good.collect()) == [(1, D(2024, 1, 2), None, None), (3, None, 2.5, None)]
    assert sorted(r.reasons[0] for r in bad.collect()) == ["missing id", "unread v"]


def test_exchange_bars_read_both_units(spark):
    row = lambda t: (t, 1.0, 2.0, 0.5, 1.5, 3.0, t + 59_999, 4.0, 5, 1.0, 1.0, "0")
    raw = spark.createDataFrame([row(1_700_000_000_000), row(1_740_000_000_000_000), (1_700_000_060_000, 1.0, 1.0, 1.0, 1.0, 0.0, 1_600_000_000_000, 0.0, 0, 0.0, 0.0, "0")], readers.BAR_CSV)
    good, odd = readers.exchange_bars(raw)
    assert sorted(r.ts.year for r in good.collect()) == [2023, 2025] and odd.count() == 1


def test_tables_round_trip(spark, tmp_path):
    ds = Dataset("t", (Field("k", "bigint", required=True), Field("day", "date"), Field("v", "double"), Field("version", "int")), ("k",), "day", ("day",))
    path = str(tmp_path / "t")
    rows_ = spark.createDataFrame([(1, D(2024, 1, 1), 1.0, 1), (2, D(2024, 1, 2), 2.0, 1)], "k long, day date, v double, version int")
    tables.write_dataset(rows_, ds, path)
    with pytest.raises(ValueError):
        tables.write_dataset(rows_.unionByName(rows_), ds, path)
    tables.upsert_dataset(spark, spark.createDataFrame([(1, D(2024, 1, 1), 9.0, 2)], rows_.schema), ds, path, "version")
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, 9.0), (2, 2.0)]
    with pytest.raises(ValueError):
        tables.replace_window(rows_, ds, path, "day", "2024-01-02", "2024-01-03")
    tables.compact_day(spark, path, str(tmp_path / "c"), 1, ["k"])
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    page = tables.read_dataset(rows_, ds, ["v"], after=(1,), limit=5).collect()
    assert [r.v for r in page] == [2.0]


def test_identity_review_finds_overlap(spark):
    df = spark.createDataFrame([("a", "S", D(2020, 1, 1), D(2020, 5, 1)), ("a", "E", D(2020, 4, 1), None), ("b", "S", D(2020, 1, 1), D(2020, 2, 1)), ("b", "S", D(2020, 3, 1), None)], "s string, t string, x date, y date")
    got = {r.s: (r.type_conflict, r.window_overlap) for r in rows.identity_review(df, "s", "t", "x", "y").collect()}
    assert got == {"a": (True, True), "b": (False, False)}


def test_revisions_reject_late_rows(spark, tmp_path):
    t = lambda m, s=0: dt.datetime(2024, 1, 2, 10, m, s)
    folder = str(tmp_path / "in")
    schema = "symbol string, capture_id long, ts timestamp, price double, volume double"
    first = [("x", 1, t(30), 10.0, 1.0), ("x", 2, t(30, 30), 11.0, 1.0), ("x", 3, t(31), 12.0, 1.0)]
    late = [("x", 4, t(30, 40), 13.0, 1.0), ("x", 5, t(5), 9.0, 1.0), ("x", 6, dt.datetime(2024, 1, 1, 10), 9.0, 1.0)]
    for part in (first, late):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    log = minutes.run_to_table(minutes.revised_minutes(stream), str(tmp_path / "out"))
    counts = {r.counter: r["count"] for r in log.groupBy("counter").count().collect()}
    assert counts == {"accepted": 3, "older_minute_not_emitted": 1, "beyond_lateness": 1, "previous_day": 1}
    last = {r.minute.minute: (r.revision, r.close) for r in minutes.newest_revision(log).collect()}
    assert last == {30: (2, 11.0), 31: (1, 12.0)}


def test_revisions_go_on_after_a_restart_and_a_new_day(spark, tmp_path):
    t = lambda d, m, s=0: dt.datetime(2024, 1, d, 10, m, s)
    source, target, schema = str(tmp_path / "in"), str(tmp_path / "out"), "symbol string, capture_id long, ts timestamp, price double, volume double"
    parts = ([("x", 1, t(2, 30), 10.0, 1.0), ("x", 2, t(2, 31), 11.0, 2.0)], [("x", 3, t(2, 31, 5), 12.0, 3.0)], [("x", 4, t(3, 1), 5.0, 1.0), ("x", 5, t(2, 59), 5.0, 1.0), ("x", 6, t(3, 1, 1), 6.0, 1.0)])
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        log = minutes.run_to_table(minutes.revised_minutes(stream), target)  # each run starts from the checkpoint
    got = {(r.minute.day, r.minute.minute): (r.revision, r.volume, r.close) for r in minutes.newest_revision(log).collect()}
    assert got == {(2, 30): (1, 1.0, 10.0), (2, 31): (2, 5.0, 12.0), (2, 59): (1, 1.0, 5.0), (3, 1): (2, 2.0, 6.0)}
    assert {r.counter for r in log.collect()} == {"accepted"}


def test_entry_survives_without_corpus_operators():
    assert set(market.oracle_sql()) <= set(market.queries())


def test_a_failed_compaction_leaves_the_day_as_it_was(spark, tmp_path):
    day = tables.VersionedDay(spark, str(tmp_path / "day"))
    day.publish(spark.range(1000).withColumn("v", F.col("id") % 7).repartition(12))
    with pytest.raises(RuntimeError):
        day.compact(["id"], prepare=lambda rows: rows.where("id <> 5"))
    assert (day.entry().version, day.entry().files, day.rows().count()) == (1, 12, 1000)
    assert len([p for p in (tmp_path / "day").iterdir() if p.name.startswith("data-")]) == 1  # nothing staged is left
    assert day.compact(["id"]) == 1 and (day.entry().version, day.entry().files) == (2, 1)
    assert day.compact(["id"], file_bytes=1000) > 2 and day.rows().count() == 1000
    assert day.vacuum() == 2 and day.rows().count() == 1000


def test_segments_change_no_asof_match(spark):
    import random

    rng = random.Random(3)
    left = spark.createDataFrame([(rng.choice(["hot", "hot", "hot", "b", None]), rng.randint(-50, 450), k) for k in range(3000)], "k string, t int, n int")
    right = spark.createDataFrame([(rng.choice(["hot", "hot", "c", "b", None]), rng.randint(0, 300), k, rng.choice([None, float(k)])) for k in range(400)], "k string, t int, seq int, v double")
    for f, more in ((joins.asof_backward, {}), (joins.asof_forward, {"horizon": F.lit(7)})):
        whole, cut = (sorted(map(str, f(left, right, ["k"], "t", ["v"], "seq", segment=s, **more).collect())) for s in (None, joins.spans(10)))
        assert whole == cut
        assert f(left, right.where("false"), ["k"], "t", ["v"], "seq", segment=joins.spans(10), **more).where("v is not null").count() == 0
    cut = joins.asof_backward(left, right, ["k"], "t", ["v"], "seq", segment=joins.spans(10))
    assert "_seg" in cut._jdf.queryExecution().optimizedPlan().toString()


def test_running_sums_equal_sliding_frames(spark):
    import random

    from tickloom.functions import rolling

    rng = random.Random(4)
    rows = [("a", k, rng.choice([None, 1e9 + rng.random()])) for k in range(300)] + [("b", k, 0.1) for k in range(40)] + [("c", k, None if k % 2 else 5.0 + (k > 20)) for k in range(60)] + [("d", 1, None)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    sums = rolling.Sums(df, "s", "t", {"v": F.col("v")}, ("v",))
    w = rolling.ordered("s", "t")
    out = sums.df.select("s", "t", *(x.alias(f"{a}{n}") for n in (5, 30) for a, x in (("m", sums.mean("v", n, 3)), ("d", sums.std("v", n, 3)), ("wm", rolling.rolling_mean("v", n, 3, w)), ("wd", rolling.rolling_std("v", n, 3, w)))))
    for r in out.collect():
        for n in (5, 30):
            assert (r[f"m{n}"] is None) == (r[f"wm{n}"] is None) and (r[f"d{n}"] is None) == (r[f"wd{n}"] is None)
            if r[f"m{n}"] is not None:
                assert r[f"m{n}"] == pytest.approx(r[f"wm{n}"], rel=1e-13) and r[f"d{n}"] == pytest.approx(r[f"wd{n}"], abs=1e-6)
                assert (r[f"d{n}"] == 0) == (r[f"wd{n}"] == 0)


def test_macd_equals_its_recurrence(spark):
    import random

    rng = random.Random(8)
    prices = {"a": [10 + rng.random() for _ in range(60)], "b": [5.0, None, 6.0, None, None, 7.0, 6.5]}
    df = spark.createDataFrame([(s, k, v) for s, vs in prices.items() for k, v in enumerate(vs)], "symbol string, trade_date int, close double")
    got = {(r.symbol, r.trade_date): r.macd_strength for r in timeseries.macd_strength(df).collect()}

    def means(values, span):
        """Weights of older values decay with time, missing ones included."""
        alpha, out, mean, weight = 2 / (span + 1), [], None, 1.0
        for v in values:
            if mean is None:
                mean = v
            else:
                weight *= 1 - alpha
                if v is not None:
                    mean = (weight * mean + alpha * v) / (weight + alpha)
                    weight = 1.0
            out.append(mean)
        return out

    for s, vs in prices.items():
        line = [f - w for f, w in zip(means(vs, 12), means(vs, 26), strict=True)]
        for k, (x, signal, close) in enumerate(zip(line, means(line, 9), vs, strict=True)):
            assert got[s, k] is None if close is None else got[s, k] == pytest.approx((x - signal) / close, abs=1e-12)


def test_block_bootstrap_equals_drawn_blocks(spark):
    import statistics

    values = [float(k * k % 13) for k in range(50)]
    df = spark.createDataFrame(list(enumerate(values)), "t int, v double")
    draws, block, seed = 40, 7, 7
    blocks = -(-len(values) // block)
    starts = spark.range(draws).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("id", F.pmod(F.xxhash64("id", "k", F.lit(seed)), F.lit(len(values) - block + 1)).alias("a")).collect()
    drawn = {}
    for r in starts:
        drawn.setdefault(r.id, []).extend(values[r.a : r.a + block])
    means = sorted(statistics.fmean(x) for x in drawn.values())
    (got,) = timeseries.block_bootstrap(df, "t", "v", draws, block, seed).collect()
    assert got.draws == draws and got["mean"] == pytest.approx(statistics.fmean(means))
    at = lambda q: means[int(q * 39)] + (q * 39 % 1) * (means[min(int(q * 39) + 1, 39)] - means[int(q * 39)])
    assert (got.p05, got.p50, got.p95) == pytest.approx((at(0.05), at(0.5), at(0.95)), abs=0.05)


def test_outlook_knows_no_future_event(spark):
    day = lambda k: D(2024, 1, k)
    forecast = spark.createDataFrame([("s", day(2), 1, 10.0, 30.0), ("t", day(9), 2, 900.0, 900.0)], "stock string, ann date, seq long, low double, high double")
    express = spark.createDataFrame([("s", day(2), 3, None, 1.5, 1.0), ("s", day(20), 4, 40.0, None, None), ("u", day(1), 5, None, 1.0, 0.0)], "stock string, ann date, seq long, explicit double, income double, prior double")
    events = crosssection.earnings_events(express, forecast, "stock", "ann", "seq")
    assert sorted((r.stock, r.value) for r in events.collect()) == [("s", 0.2), ("s", 0.4), ("s", 0.5), ("t", 2.0)]
    members = spark.createDataFrame([("e", day(k), s, w) for k in (1, 5, 10, 25) for s, w in (("s", 1.0), ("t", 3.0), ("x", 9.0))] + [("f", day(5), "x", 1.0)], "etf string, day date, stock string, weight double")
    got = {(r.etf, r.day.day): (r.coverage, r.outlook) for r in crosssection.earnings_outlook(events, members, "etf", "stock", "day", "ann").collect()}
    assert got == {("e", 5): (1.0, 0.5), ("e", 10): (4.0, 1.625), ("e", 25): (4.0, 1.6), ("f", 5): (0.0, None)}


def test_parts_of_a_staged_stream_are_one_batch_each(spark, tmp_path):
    """F7, F8: a part of any size has the same number of files, so that more than one task reads and writes it."""
    from tickloom.plans.base import staged

    stream = staged(spark, [spark.range(k) for k in (100, 1, 0, 7)], str(tmp_path / "in"))
    rows = minutes.run_to_table(stream.select("id", F.input_file_name().alias("file")), str(tmp_path / "out"))
    found = spark.read.parquet(f"{tmp_path}/out/rows").groupBy("batch_id").agg(F.count("*"), F.countDistinct("file")).orderBy("batch_id").collect()
    assert rows.count() == 108 and [r[1] for r in found] == [100, 1, 7] and [r[0] for r in found] == [0, 1, 3] and found[0][2] > 1


def test_many_symbols_share_few_state_groups(spark, tmp_path):
    """F8: one bucket or many give the same log."""
    rows = spark.range(400).select(F.pmod("id", F.lit(37)).cast("string").alias("symbol"), F.col("id").alias("capture_id"), F.timestamp_seconds(1_704_067_200 + F.pmod(F.col("id") * 7919, F.lit(90_000))).alias("ts"), (F.col("id") % 5 + 1.0).alias("price"), F.lit(100.0).alias("volume"))
    rows.where("capture_id < 250").coalesce(1).write.parquet(str(tmp_path / "in"))
    rows.where("capture_id >= 250").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    logs = []
    for k in (1, 50):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        logs.append(sorted(map(str, minutes.run_to_table(minutes.revised_minutes(stream, buckets=k), str(tmp_path / str(k))).collect())))
    assert len(logs[0]) == 400 and logs[0] == logs[1]


def exchanges(df) -> list[str]:
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in line]


def test_bars_and_windows_of_a_symbol_share_one_shuffle(spark):
    """F18."""
    from tickloom.plans import market

    assert len(exchanges(market.queries()["daily_features"](spark, "/root/testdata/sf0.001"))) == 1


def test_daily_features_leave_no_input_out(spark):
    """means, deviations and oscillators by their definitions, over missing closes, a halt without volume, and losses."""
    import math
    import random
    import statistics

    rng = random.Random(5)
    names = "symbol trade_date open high low close volume amount turnover free_market_value pe up_limit down_limit is_st is_suspended".split()
    rows = []
    for s in ("a", "b"):
        for k in range(300):
            halt = s == "b" and 100 <= k < 140
            close = None if s == "a" and (k < 2 or k % 11 in (4, 5)) else 8.0 if halt else 8 + rng.random()
            high, low = (close or 8) + rng.random() / 9, (close or 8) - rng.random() / 9
            volume = 0.0 if halt else None if k % 13 == 6 else 1e6 * rng.random()
            rows.append((s, k, low, high, low, close, volume, volume and volume * 8, None if k % 17 == 3 else rng.random(), rng.choice([None, 0.0, 5.0]), rng.choice([-4.0, 0.0, 20.0]), rng.choice([high, 9.9, None]), rng.choice([low, 7.2]), rng.choice([0, 0, 1, None]), int(halt)))
    schema = ", ".join(f"{c} {'string' if c == 'symbol' else 'int' if c in ('trade_date', 'is_st', 'is_suspended') else 'double'}" for c in names)
    found = {(r.symbol, r.trade_date): r for r in timeseries.daily_features(spark.createDataFrame(rows, schema).repartition(3)).collect()}
    assert len(found) == 600

    def rolled(values, n, least, f=statistics.fmean):
        own = [[v for v in values[max(0, k - n + 1) : k + 1] if v is not None] for k in range(len(values))]
        return [f(v) if len(v) >= least else None for v in own]

    def both(f, *columns):
        return [None if None in v else f(*v) for v in zip(*columns, strict=True)]

    def ratio(a, b):
        return both(lambda x, y: x / y if abs(y) > 1e-12 else None, a, b)

    def back(values, n):
        return [None] * min(n, len(values)) + values[:-n]

    def ema(values, span):
        alpha, out, mean, weight = 2 / (span + 1), [], None, 1.0
        for v in values:
            if mean is None:
                mean = v
            else:
                weight *= 1 - alpha
                if v is not None:
                    mean, weight = (weight * mean + alpha * v) / (weight + alpha), 1.0
            out.append(mean)
        return out

    for s in ("a", "b"):
        c = {name: [r[j] for r in rows if r[0] == s] for j, name in enumerate(names)}
        close, filled = c["close"], []
        for v in close:
            filled.append(v if v is not None or not filled else filled[-1])
        change = lambda n: both(lambda x: x - 1, ratio(filled, back(filled, n)))  # noqa: E731, B023
        ret, move = change(1), both(lambda a, b: a - b, close, back(close, 1))
        fall = both(lambda r: min(r, 0.0), ret)
        t21, t252 = rolled(c["turnover"], 21, 15), rolled(c["turnover"], 252, 120)
        strength = both(lambda g, x: ((100 - 100 / (1 + g / (x + 1e-12))) - 50) / 50, rolled(both(lambda m: max(m, 0.0), move), 14, 7), rolled(both(lambda m: -min(m, 0.0), move), 14, 7))
        trend = both(lambda x: x - 1, ratio(rolled(c["volume"], 5, 3), rolled(c["volume"], 20, 10)))
        mean, std = rolled(close, 20, 10), rolled(close, 20, 10, lambda v: 0.0 if min(v) == max(v) else statistics.stdev(v))
        fast, slow = ema(close, 12), ema(close, 26)
        line = both(lambda a, b: a - b, fast, slow)
        wanted = {
            **{f"ret_{n}": change(n) for n in (1, 3, 5, 20, 60, 120)},
            "price": close,
            "open_price": c["open"],
            "ret": ret,
            **{f"downside_{n}": rolled(fall, n, n // 2, statistics.stdev) for n in (60, 252)},
            "amount_mean_3": rolled(c["amount"], 3, 1),
            "turnover_21": t21,
            "turnover_252": t252,
            "abturnover": ratio(t21, t252),
            "log_free_size": [math.log(v) if v else None for v in c["free_market_value"]],
            "earnings_to_price": [1 / v if v else None for v in c["pe"]],
            "momentum_12m": both(lambda x: x - 1, ratio(back(close, 21), back(close, 252))),
            "rsi_strength": strength,
            "price_acceleration": both(lambda a, b: a - b, change(5), change(20)),
            "macd_strength": ratio(both(lambda a, b: a - b, line, ema(line, 9)), slow),
            "bollinger_band": both(lambda x: min(1.0, max(0.0, x)), ratio(both(lambda p, m, d: p - m + 2 * d, close, mean, std), both(lambda d: 4 * d, std))),
            "volume_trend": trend,
            "price_volume_divergence": both(lambda a, b: a - b, change(20), trend),
            "rotation_composite": both(lambda a, b, d: 0.3 * a + 0.4 * b + 0.3 * d, strength, change(20), trend),
            "distance_to_down_limit": both(lambda x: x - 1, ratio(close, c["down_limit"])),
            "limit_touch_up": [int(u is not None and h >= u * (1 - 1e-6)) for h, u in zip(c["high"], c["up_limit"], strict=True)],
            "limit_touch_down": [int(x <= d * (1 + 1e-6)) for x, d in zip(c["low"], c["down_limit"], strict=True)],
            "is_tradable": [int(a == 0 and b == 0 and (v or 0) > 0) for a, b, v in zip(c["is_st"], c["is_suspended"], c["amount"], strict=True)],
        }
        for name, values in wanted.items():
            assert any(values), name
            for k, want in enumerate(values):
                got = found[s, k][name]
                assert (got is None) == (want is None) and (want is None or got == pytest.approx(want, rel=1e-9, abs=1e-9)), (s, k, name, got, want)


def test_beta_holds_no_frame_of_its_window(spark):
    """running sums give the beta of each window, and prices don't meet the market in a shuffle."""
    import numpy as np

    from tickloom.operators import timeseries as ts

    rng = np.random.default_rng(3)
    rows = [(s, d, None if d == 0 else float(rng.normal())) for s in range(3) for d in range(90)]
    out = ts.etf_beta(spark.createDataFrame(rows, "symbol int, trade_date int, ret double"))
    assert "specifiedwindowframe(RowFrame, -59" not in out._jdf.queryExecution().analyzed().toString()
    got = {(r.symbol, r.trade_date): r.beta_60 for r in out.collect()}
    x = np.array([[np.nan if r is None else r for _, _, r in rows[90 * s : 90 * s + 90]] for s in range(3)])
    m = np.median(x[:, 1:], axis=0)
    for d in (29, 30, 60, 89):
        low = max(1, d - 59)
        own, market = x[1, low : d + 1], m[low - 1 : d]
        want = None if len(own) < 30 else ((own * market).mean() - own.mean() * market.mean()) / (market.var())
        assert got[1, d] == (None if want is None else pytest.approx(want))


def test_level2_folders_hold_one_file_and_no_checksum_each(spark, tmp_path):
    from pathlib import Path

    from tickloom.plans import stored
    from tickloom.sources import readers

    to = Path(stored._l2_folders(spark, "/root/testdata/sf0.001", "order"))
    for place in to.glob("*/*"):
        assert [p.suffix for p in place.iterdir()] == [".csv"]  # hidden ones count
    assert len(list(to.glob("*/*"))) == stored.table(spark, "/root/testdata/sf0.001", "events").selectExpr("floor(user_id / 75)", "to_date(ts)").distinct().count()
    long = "9" * 10_000  # longer than the parser's buffer
    place = tmp_path / "20240102" / "7"
    place.mkdir(parents=True)
    (place / "order.csv").write_bytes(f"序号,时间,价格,数量,方向,类型,委托号\n1,93000000,100000,200,B,0,{long}\n2,93000001,100000,300,S,1,b\n".encode("gb18030"))
    got = readers.read_l2_csv_day(spark, str(tmp_path), "order").orderBy("seq").collect()
    assert [(r.seq, r.volume, r.type, r.id, r.symbol) for r in got] == [(1, 200.0, 0, long, "7"), (2, 300.0, 11, "b", "7")]
