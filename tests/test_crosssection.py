"""Cross-section operators against their definitions."""

import numpy as np
import pytest

from tickloom.operators import crosssection as cs
from tickloom.operators import rows


def test_ridge_residual_equals_the_penalized_least_squares(spark):
    rng = np.random.default_rng(1)
    data = [(d, k, float(rng.normal()), float(rng.normal()), [None, "a", "b", "c"][k % 4]) for d in range(2) for k in range(20 if d else 11)]
    data += [(1, 99, None, 1.0, "a"), (1, 98, 1.0, None, "a")]
    got = {(r.d, r.k): r.residual for r in cs.ridge_residual(spark.createDataFrame(data, "d int, k int, y double, x double, g string"), ["d"], "y", ["x"], "g").collect()}
    assert all(got[0, k] is None for k in range(11)) and got[1, 99] is None and got[1, 98] is None
    use = [r for r in data if r[0] == 1 and r[1] < 90]
    y, x = (np.array([r[j] for r in use]) for j in (2, 3))
    style = [r[4] or cs.OTHER_STYLE for r in use]
    names = sorted(set(style))[1:]
    design = np.column_stack([np.ones(20), (x - x.mean()) / x.std(), *[[float(s == n) for s in style] for n in names]])
    penalty = np.diag([0.0] + [10.0] * (design.shape[1] - 1))
    want = y - design @ np.linalg.solve(design.T @ design + penalty, design.T @ y)
    assert [got[1, r[1]] for r in use] == pytest.approx(list(want))


def test_a_rule_is_registered_once():
    found = rows.register_quality_rule({}, "t", "a", "x > 1")
    assert set(rows.register_quality_rule(found, "t", "b", "x > 2")["t"]) == {"a", "b"} and set(found["t"]) == {"a"}
    with pytest.raises(ValueError):
        rows.register_quality_rule(found, "t", "a", "x > 3")


def test_equal_values_share_the_mean_rank_from_one_sort(spark):
    """F6."""
    df = spark.createDataFrame([(d, v) for d in (1, 2) for v in (2.0, 1.0, 2.0, None, 5.0, 2.0)], "d int, v double").withColumn("k", cs.rank_pct("v", ["d"]))
    assert df._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    got = df.collect()
    assert sorted(r.k for r in got if r.d == 1 and r.v is not None) == [1 / 5, 3 / 5, 3 / 5, 3 / 5, 1.0] and [r.k for r in got if r.v is None] == [None, None]


def test_pools_shuffle_rows_before_they_become_one_for_each_pool(spark):
    """no exchange lies above the step that makes a row for each pool."""
    panel = spark.createDataFrame([(f"60000{k}.SH", "2024-01-0%d" % d, 5.0 + k, 0, 0, True, 300) for d in (1, 2) for k in range(3)], "symbol string, trade_date string, total_mv double, is_st int, is_suspended int, tradable boolean, listing_days int")
    members = spark.createDataFrame([("000300", "2024-01-02", "600001.SH")], "index_code string, trade_date string, symbol string")
    pools = {"all": ("", ()), "csi300": ("000300", ())}
    out = cs.stock_pools(panel, members, pools)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    at = min(k for k, line in enumerate(plan) if "NestedLoopJoin" in line or "CartesianProduct" in line)
    assert not any("Exchange hash" in line for line in plan[:at])
    got = {(r.trade_date, r.pool, r.symbol): (r.reasons, r.unavailable) for r in out.collect()}
    assert got["2024-01-01", "csi300", None] == (None, "PIT index membership unavailable") and len(got) == 3 + 1 + 3 + 3
    assert got["2024-01-02", "csi300", "600001.SH"][0] == [] and "not_pit_member" in got["2024-01-02", "csi300", "600002.SH"][0]


def test_the_etf_panel_reads_its_bars_once(spark):
    """F12."""
    from tickloom.plans import market

    out = market.queries()["etf_shared_panel"](spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
