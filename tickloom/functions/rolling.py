"""Window expressions that count rows, not days, each with a least number of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.scalars import col, ratio


def ordered(by: str | list[str], *order: str) -> WindowSpec:
    return Window.partitionBy(*([by] if isinstance(by, str) else by)).orderBy(*order)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def enough(c: Column, w: WindowSpec, least: int, value: Column) -> Column:
    return F.when(F.count(c).over(w) >= least, value)


def shift(c: Column | str, n: int, w: WindowSpec) -> Column:
    """The value n rows before; a look ahead is refused."""
    if n < 0:
        raise ValueError("shift looks back only")
    return F.lag(col(c), n).over(w)


def delta(c: Column | str, n: int, w: WindowSpec) -> Column:
    return col(c) - shift(c, n, w)


def pct_change(c: Column | str, n: int, w: WindowSpec) -> Column:
    return ratio(col(c), shift(c, n, w)) - 1


def forward_fill(c: Column | str, w: WindowSpec) -> Column:
    return F.last(col(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def rolling_mean(c: Column | str, n: int, least: int, w: WindowSpec) -> Column:
    own = last_rows(w, n)
    return enough(col(c), own, least, F.avg(col(c)).over(own))


def rolling_std(c: Column | str, n: int, least: int, w: WindowSpec) -> Column:
    """Sample deviation; exactly 0 where all values are the same."""
    own = last_rows(w, n)
    same = F.min(col(c)).over(own) == F.max(col(c)).over(own)
    return enough(col(c), own, max(2, least), F.when(same, 0.0).otherwise(F.stddev_samp(col(c)).over(own)))


def rolling_sum(c: Column | str, n: int, least: int, w: WindowSpec) -> Column:
    own = last_rows(w, n)
    return enough(col(c), own, least, F.sum(col(c)).over(own))


def rolling_max(c: Column | str, n: int, least: int, w: WindowSpec) -> Column:
    own = last_rows(w, n)
    return enough(col(c), own, least, F.max(col(c)).over(own))


def rolling_min(c: Column | str, n: int, least: int, w: WindowSpec) -> Column:
    own = last_rows(w, n)
    return enough(col(c), own, least, F.min(col(c)).over(own))


def rolling_cov(a: Column | str, b: Column | str, n: int, least: int, w: WindowSpec) -> Column:
    """Population covariance of the rows that have both."""
    own = last_rows(w, n)
    both = col(a).isNotNull() & col(b).isNotNull()
    x, y = F.when(both, col(a)), F.when(both, col(b))
    return enough(x, own, least, F.avg(x * y).over(own) - F.avg(x).over(own) * F.avg(y).over(own))


def rolling_corr(a: Column | str, b: Column | str, n: int, least: int, w: WindowSpec) -> Column:
    """Correlation of the rows that have both, missing without spread."""
    cov, x, y = rolling_cov(a, b, n, least, w), F.when(col(b).isNotNull(), col(a)), F.when(col(a).isNotNull(), col(b))
    spread = rolling_cov(x, x, n, least, w) * rolling_cov(y, y, n, least, w)
    return F.when(spread > 0, cov / F.sqrt(spread))


def running_sum(c: Column, n: int, w: WindowSpec) -> Column:
    """Sum of the last n rows as a difference of two running sums, so its cost doesn't grow with n."""
    whole = F.sum(F.coalesce(c, F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.sum(F.coalesce(c, F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, -n))
    return whole - F.coalesce(before, F.lit(0.0))


def running_moments(a: Column | str, b: Column | str, n: int, w: WindowSpec) -> tuple[Column, Column, Column, Column]:
    """Count, covariance and variances, in population form, of the last n rows that have both; for long windows."""
    both = col(a).isNotNull() & col(b).isNotNull()
    x, y = F.when(both, col(a)), F.when(both, col(b))
    k = running_sum(F.when(both, 1.0), n, w)
    mean = lambda c: running_sum(c, n, w) / F.nullif(k, F.lit(0.0))
    return k, mean(x * y) - mean(x) * mean(y), mean(x * x) - mean(x) * mean(x), mean(y * y) - mean(y) * mean(y)


class Sums:
    """Means and deviations over the last n rows of a key from running sums, at a cost that doesn't grow with n.

    Each column is centred on its key's mean before it is summed, so that little is lost where two long sums are
    subtracted. A window of equal values has exactly their mean and a deviation of exactly 0: the length of the run of
    equal values says so.
    All windows share one partitioning and order. `deviations` names the columns that `std` may be asked for. `spans`
    names the lengths of windows that are asked for more than once, whose differences are then made once.
    """

    def __init__(self, df: DataFrame, by: str | list[str], at: str, columns: dict[str, Column], deviations: tuple[str, ...] = (), spans: dict[str, tuple[int, ...]] | None = None):
        self.w = ordered(by, at)
        self.helpers = [f"_{k}_{c}" for c in columns for k in ("v", "m", "p", "n", "s", "q", "c", "r")]
        whole, before, to_here = (self.w.rowsBetween(a, b) for a, b in ((Window.unboundedPreceding, Window.unboundedFollowing), (Window.unboundedPreceding, -1), (Window.unboundedPreceding, 0)))
        df = df.withColumns({f"_v_{c}": x.cast("double") for c, x in columns.items()})
        df = df.withColumns({f"_m_{c}": F.avg(f"_v_{c}").over(whole) for c in columns} | {f"_p_{c}": F.last(f"_v_{c}", ignorenulls=True).over(before) for c in columns})
        off = {c: F.col(f"_v_{c}") - F.col(f"_m_{c}") for c in columns}
        sums = {f"_n_{c}": F.count(f"_v_{c}").over(to_here) for c in columns} | {f"_s_{c}": F.sum(F.coalesce(off[c], F.lit(0.0))).over(to_here) for c in columns}
        sums |= {f"_q_{c}": F.sum(F.coalesce(off[c] * off[c], F.lit(0.0))).over(to_here) for c in deviations}
        df = df.withColumns(sums | {f"_c_{c}": F.col(f"_v_{c}") != F.col(f"_p_{c}") for c in columns})
        self.df = df.withColumns({f"_r_{c}": F.max(F.when(F.col(f"_c_{c}"), F.col(f"_n_{c}") - 1)).over(to_here) for c in columns})  # values before the current run
        self.made: set[str] = set()
        made = {f"_{k}_{c}_{n}": self._last(k, c, n) for c, lengths in (spans or {}).items() for n in lengths for k in ("nsq" if c in deviations else "ns")}
        self.df, self.made = self.df.withColumns(made), set(made)

    def _last(self, kind: str, c: str, n: int) -> Column:
        if (name := f"_{kind}_{c}_{n}") in self.made:
            return F.col(name)
        return F.col(f"_{kind}_{c}") - F.lag(f"_{kind}_{c}", n, 0).over(self.w)

    def _same(self, c: str, k: Column) -> Column:
        return F.col(f"_n_{c}") - F.coalesce(f"_r_{c}", F.lit(0)) >= k

    def mean(self, c: str, n: int, least: int) -> Column:
        k = self._last("n", c, n)
        return F.when(k >= least, F.when(self._same(c, k), F.coalesce(f"_v_{c}", f"_p_{c}")).otherwise(F.col(f"_m_{c}") + self._last("s", c, n) / k))

    def std(self, c: str, n: int, least: int) -> Column:
        """Sample deviation."""
        k, s = self._last("n", c, n), self._last("s", c, n)
        spread = (self._last("q", c, n) - s * s / k) / (k - 1)
        return F.when(k >= max(2, least), F.when(self._same(c, k), 0.0).otherwise(F.sqrt(F.greatest(spread, F.lit(0.0)))))
