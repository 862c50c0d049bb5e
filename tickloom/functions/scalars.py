"""Scalar expressions that operators share. Missing is always SQL NULL: clean() turns NaN and infinities into it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Denominators of this size or less make a ratio missing.
TINY = 1e-12


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    c = col(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def ratio(a: Column | str, b: Column | str, tiny: float = TINY) -> Column:
    a, b = col(a), col(b)
    return F.when(F.abs(b) > tiny, a / b)


def correlation(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation of the rows that hold both, missing without spread, where corr() would divide by zero."""
    a, b = col(a), col(b)
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y), 1e-300)


def clip(c: Column | str, low: float, high: float) -> Column:
    """Null stays null, which greatest and least alone would skip."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def mean_of(columns: list[Column], least: int = 1) -> Column:
    """Mean of the non-null ones, missing if fewer than `least` are there."""
    n = total([F.when(c.isNotNull(), 1).otherwise(0) for c in columns])
    return F.when(n >= least, total([F.coalesce(c, F.lit(0.0)) for c in columns]) / n)


def day_millis(hhmmssmmm: Column | str) -> Column:
    """Milliseconds of the day of a whole number written HHMMSSmmm."""
    t = col(hhmmssmmm).cast("long")
    hours, minutes, seconds = (F.floor(t / 10**k).cast("long") for k in (7, 5, 3))
    return hours * 3_600_000 + minutes % 100 * 60_000 + seconds % 100 * 1000 + t % 1000


def plain_id(c: Column | str) -> Column:
    """An id without blanks and without the .0 of a number read as a float."""
    plain = F.trim(col(c))
    return F.when(plain.contains(".0"), F.regexp_replace(plain, r"\.0$", "")).otherwise(plain)  # most ids need no search


def same_within(a: Column | str, b: Column | str, absolute: float = 1e-8, relative: float = 1e-10) -> Column:
    """|a - b| <= absolute + relative |a|, and two nulls agree."""
    a, b = col(a), col(b)
    return F.coalesce(F.abs(a - b) <= absolute + relative * F.abs(a), a.isNull() & b.isNull())


def ordinary_share(code: Column | str) -> Column:
    """Whether a code is an ordinary share of the three mainland exchanges."""
    return col(code).rlike(r"^(60[0135]\d{3}|68[89]\d{3})\.SH$|^(00[0-3]\d{3}|30[01]\d{3})\.SZ$|^([48]\d{5}|92\d{4})\.BJ$")


def finite_array(c: Column | str) -> Column:
    """Whether an array holds finite doubles only."""
    return F.coalesce(F.forall(col(c), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def local_date(ts: Column | str, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(col(ts), zone))


def completion_ceiling(now: Column | str, zone: str = "Asia/Shanghai", hour: int = 20, minute: int = 30) -> Column:
    """The last usable business date: before the given local time it is yesterday."""
    local = F.from_utc_timestamp(col(now), zone)
    late = F.hour(local) * 60 + F.minute(local) >= hour * 60 + minute
    return F.when(late, F.to_date(local)).otherwise(F.date_sub(F.to_date(local), 1))


def first_rule(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The label of the first rule whose expression the text in small letters matches."""
    low = F.lower(text)
    out = F.lit(default)
    for pattern, label in reversed(rules):
        out = F.when(low.rlike(pattern), label).otherwise(out)
    return out
