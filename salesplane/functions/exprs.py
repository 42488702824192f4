"""Column-expression helpers shared by every block (all JVM-side built-ins)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int; NULL counts as false (pandas NaN comparisons are False)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (never raises under ANSI mode)."""
    return F.try_divide(col(a), col(b))


def div_or(a, b, default) -> Column:
    return F.coalesce(safe_div(a, b), F.lit(default))


def pct_change(cur, prev) -> Column:
    """pandas ``pct_change`` for one pair: NULL prev -> NULL, prev 0 -> +-inf or NaN->NULL.

    0/0 is NaN in pandas and is filled with 0 by every caller, so it is 0 here;
    x/0 keeps its infinity because downstream flags see it before cleaning.
    """
    cur, prev = col(cur), col(prev)
    return (F.when(prev.isNull() | cur.isNull(), F.lit(None).cast("double"))
            .when(prev == 0, F.when(cur > 0, F.lit(INF)).when(cur < 0, F.lit(-INF))
                  .otherwise(F.lit(None).cast("double")))
            .otherwise((cur - prev) / prev))


def safe_corr(x, y) -> Column:
    """Pearson r as an aggregate; NULL (not an ANSI error) when either side is constant."""
    x, y = col(x).cast("double"), col(y).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def finite(c) -> Column:
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(INF))


def inf_to_null(c) -> Column:
    c = col(c)
    return F.when(finite(c), c)


def clip(c, lo=None, hi=None) -> Column:
    c = col(c)
    if lo is not None:
        c = F.greatest(c, F.lit(lo))
    if hi is not None:
        c = F.least(c, F.lit(hi))
    return c


def r6(c) -> Column:
    """Deterministic 6-decimal rounding: floor(x*1e6+0.5)/1e6 (+0.0 folds -0.0).

    The same arithmetic is written in the DuckDB oracle, so both engines produce
    bit-identical doubles from identical inputs.
    """
    c = col(c)
    return F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6) + F.lit(0.0)


def cents(c) -> Column:
    """Integer cents, halves away from zero: ``round(c * 100)`` without its decimal
    arithmetic, which writes out each double, where the fraction is exact."""
    x = col(c) * 100
    size = F.abs(x)
    whole = F.floor(size)
    up = whole + F.when(size - whole >= 0.5, 1).otherwise(0)
    return F.when(size < 1e15, F.when(x < 0, -up).otherwise(up)).otherwise(F.round(x).cast("long"))


def cents_sum(c) -> Column:
    """Exact sum of money values: sum of integer cents, back to a double."""
    return F.sum(cents(c)).cast("double") / 100


def any_of(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def contains_any(text: Column, needles, lower: bool = True) -> Column:
    t = F.lower(text) if lower else text
    return any_of([t.contains(n.lower() if lower else n) for n in needles])


def count_hits(text: Column, needles) -> Column:
    """Number of needles that occur (lower-cased substring) in ``text``."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a + b, [t.contains(n.lower()).cast("int") for n in needles])


def sanitize_name(name: str) -> str:
    """Column-name form of a label: lower case, spaces -> _, parentheses dropped."""
    return str(name).lower().replace(" ", "_").replace("(", "").replace(")", "")
