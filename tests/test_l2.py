"""Order-book features: hand-written days, the full row of a day, and the mixture against its definition."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import l2
from tickloom.plans.base import level2

DAY = datetime.date(2026, 9, 24)
DEALS = "symbol string, trade_date date, seq long, time long, price double, volume double, side int, buy_id string, sell_id string"
ORDERS = "symbol string, trade_date date, seq long, time long, price double, volume double, type int, id string"
QUOTES = "symbol string, trade_date date, seq long, time long, price double, total_bid_volume double, total_ask_volume double, bid_price array<double>, ask_price array<double>, bid_volume array<double>, ask_volume array<double>"
#: The names of a day's features.
NAMES = """has_deal has_order has_snapshot deal_records order_records snapshot_records continuous_auction_ratio crossed_quote_ratio locked_quote_ratio
missing_top5_quote_ratio order_link_coverage deal_order_match_ratio nonnegative_depth_ratio valid_spread_ratio orphan_execution_ratio
cancel_without_fill_ratio partial_fill_ratio median_cancel_time_ms median_first_fill_time_ms passive_fill_ratio large_order_fill_rate partial_cancel_ratio
replace_like_ratio open_30m_spread_mean close_30m_obi_mean midday_liquidity_drop afternoon_ofi_reversal open_close_vol_ratio close_30m_impact_mean
aggressor_label_match_ratio mid_cross_match_ratio tick_rule_fallback_ratio unclassified_trade_ratio depth_recovery_5s best_quote_depletion_rate
add_cancel_execute_ratio_top1 depth_turnover_top5 book_pressure_decay queue_depletion_speed mean_rel_aggro median_inter_arrival_ms algo_windows total_windows
mean_algo_entropy mean_retail_entropy algo_total_amount retail_total_amount wash_trade_ratio wash_amount clean_amount spoof_count fake_pressure_count
fake_support_count mean_sell_otr mean_buy_otr mean_cancel_distance_ticks total_net_flow q2_accumulation mean_vwap_skew q1_count q2_count q3_count q4_count
main_net_inflow retail_funds_net_inflow main_funds_buy_amount main_funds_sell_amount mid_tier_net_inflow trade_size_gini open_auction_net_inflow
close_auction_net_inflow mean_spread mean_obi_top5 amihud_illiquidity obi_top1_mean obi_top5_std obi_top1_std depth_top1_mean depth_top5_mean depth_slope
depth_convexity microprice_minus_mid_mean microprice_minus_mid_std effective_spread_mean realized_spread_1m impact_30s impact_5m orderbook_replenish_speed
ofi_mean ofi_std ofi_persistence ofi_positive_ratio ofi_negative_ratio near_touch_cancel_add_ratio gmm_main_force_ratio gmm_hft_ratio gmm_retail_ratio
gmm_main_force_net_inflow mfi_pulse mfi_escort mfi_precip mfi_score ofi_slope total_records clean_records large_order_records""".split()


def deals(spark, rows):
    """(time, price, volume, side, buy id, sell id)"""
    return spark.createDataFrame([("A", DAY, k, *r) for k, r in enumerate(rows)], DEALS)


def orders(spark, rows):
    """(time, price, volume, type, id)"""
    return spark.createDataFrame([("A", DAY, k, *r) for k, r in enumerate(rows)], ORDERS)


def quotes(spark, rows):
    """(time, bid, ask, bid volume, ask volume), the same volume at all levels"""
    return spark.createDataFrame([("A", DAY, k, t, float(b), 0.0, 0.0, [b - j * 0.01 for j in range(10)], [a + j * 0.01 for j in range(10)], [float(v)] * 10, [float(w)] * 10) for k, (t, b, a, v, w) in enumerate(rows)], QUOTES)


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


T = l2.OPEN


def test_depletion_is_a_fall_to_a_fifth(spark):
    q = quotes(spark, [(T, 10, 10.01, 100, 100), (T + 1000, 10, 10.01, 21, 100), (T + 2000, 10, 10.01, 4, 100), (T + 7000, 10, 10.01, 52, 100)])
    o = orders(spark, []).withColumn("near_touch", F.lit(True))
    r = only(l2.l2_lob_transition(deals(spark, []), o, q))
    assert r.best_quote_depletion_rate == pytest.approx(1 / 3)
    # falls of 79 and 17 of 200 and 121 in a second each; the first's future is at 6 s, the second's at 7 s
    assert r.queue_depletion_speed == pytest.approx((79 / 200 + 17 / 121) / 2)
    assert r.depth_recovery_5s == pytest.approx(((52 - 21) / 79 + 1) / 2)


def test_signs_by_quotes_and_ticks(spark):
    q = quotes(spark, [(T, 10.0, 10.02, 1, 1), (T + 100, 0.0, 10.02, 1, 1)])
    rows = [(T - 1, 10.0, 1.0, 0, "a", "b"), (T, 10.02, 1.0, 0, "a", "b"), (T + 1, 10.0, 1.0, 0, "a", "b"), (T + 2, 10.01, 1.0, 0, "a", "b"), (T + 3, 10.01, 1.0, 1, "a", "b"), (T + 100, 10.01, 1.0, 1, "a", "b"), (T + 5, 10.0, 1.0, -1, "a", "b")]
    r = only(l2.l2_trade_sign(deals(spark, rows), q))
    assert (r.aggressor_label_match_ratio, r.mid_cross_match_ratio, r.tick_rule_fallback_ratio, r.unclassified_trade_ratio) == pytest.approx((2 / 4, 1 / 2, 2 / 6, 2 / 6))


def test_orders_live_by_id_and_replacements_match_at_once(spark):
    o = orders(spark, [(T, 10.0, 100.0, 0, "1"), (T + 5, 10.0, 60.0, -1, "1.0"), (T + 5, 10.02, 60.0, 0, " 2 "), (T + 9, 10.0, 50.0, 10, "3"), (T + 10, 10.0, 50.0, -11, "3"), (T + 2000, 10.0, 5.0, 10, None)])
    d = deals(spark, [(T + 3, 10.0, 40.0, 1, "1", "9"), (T + 8, 10.02, 60.0, 0, "2", "3"), (T + 9, 10.0, 7.0, -1, "1", None)])
    r = only(l2.l2_lifecycle(d, o))
    assert r.cancel_without_fill_ratio == 0 and r.partial_fill_ratio == pytest.approx(1 / 3) and r.partial_cancel_ratio == pytest.approx(1 / 3)
    assert (r.median_cancel_time_ms, r.median_first_fill_time_ms, r.replace_like_ratio) == (3.0, 3.0, 0.5)
    assert r.passive_fill_ratio == pytest.approx((40 + 0 + 60) / 160)


def test_cancelled_volume_over_traded_volume(spark):
    o = orders(spark, [(T, 10.0, 600.0, -1, "1"), (T + 1, 10.0, 10.0, -11, "2"), (T + 60_000, 10.0, 99.0, -11, "2")])
    d = deals(spark, [(T, 10.0, 100.0, 0, "1", "2"), (T + 60_000, 10.0, 10.0, 1, "1", "2")])
    r = only(l2.l2_spoofing(d, o, quotes(spark, [(T, 10.02, 10.04, 1, 1)])))
    assert (r.fake_support_count, r.fake_pressure_count, r.mean_buy_otr, r.mean_sell_otr) == (1, 1, 6.0, 9.9)
    assert r.mean_cancel_distance_ticks == pytest.approx((2 - 4 - 4) / 3)


def test_minutes_split_as_their_groups_lie(spark):
    rng = np.random.RandomState(3)
    x = np.concatenate([rng.normal(c, 0.1, (60, 5)) for c in (0, 5, -5)])
    label, mean = l2.mixture(x)
    assert sorted(len(set(label[k : k + 60])) for k in (0, 60, 120)) == [1, 1, 1] and len(set(label)) == 3
    for c in range(3):
        assert mean[c] == pytest.approx(x[label == c].mean(0), abs=1e-6)
    assert l2.mixture(np.zeros((6, 5))) is not None  # equal minutes don't break it
    r = only(l2.l2_gmm_split(deals(spark, [(T, 10.0, 1.0, 0, "a", "b")]), orders(spark, []), quotes(spark, [])))
    assert r.gmm_main_force_ratio == 0  # fewer than five minutes


def test_the_row_of_a_day_has_all_names(spark):
    d, o, q = level2(spark, "/root/testdata/sf0.001")
    got = l2.l2_daily_features(d, l2.near_touch(o, q), q)
    assert sorted(got.columns) == sorted([*l2.KEY, *NAMES]) and len(NAMES) == 106
    r = only(got)
    assert r.gmm_main_force_ratio + r.gmm_hft_ratio + r.gmm_retail_ratio == pytest.approx(1) and all(r[c] is not None for c in NAMES)
    empty = l2.l2_daily_features(d.where("false"), l2.near_touch(o, q).where("false"), q.where("false"))
    assert empty.count() == 0


def test_the_joined_row_fits_no_mixture(spark, monkeypatch):
    from tickloom.plans import microstructure

    def fitted(*_):
        raise AssertionError("the row has no column of the mixture")

    monkeypatch.setattr(l2, "l2_gmm_split", fitted)
    got = microstructure.l2_daily_row(spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == sorted([*l2.KEY, *(c for c in NAMES if c not in l2.MIXED)]) and got.count() == 1


def test_levels_of_a_quote_may_be_short_missing_or_null(spark):
    q = quotes(spark, []).select("bid_price", "ask_price", "bid_volume", "ask_volume")
    good = [1.0, 1.0]
    cases = [(good, good, good, good), (None, good, good, None), (good, [1.0, None], [-1.0], good), ([0.0], None, good, good), ([1.0] * 5 + [0.0], good, [1.0] * 5 + [-1.0], good)]
    made = spark.createDataFrame([(1, k, *c) for k, c in enumerate(cases)], f"symbol int, day int, {', '.join(f'{c} array<double>' for c in q.columns)}")
    made = made.select(F.col("symbol").cast("string").alias("symbol"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")).alias("trade_date"), *q.columns)
    got = l2.l2_quality(deals(spark, []), orders(spark, []), made).orderBy("trade_date").collect()
    assert [(r.missing_top5_quote_ratio, r.nonnegative_depth_ratio) for r in got] == [(0, 1), (0, 0), (1, 0), (1, 1), (0, 1)]
