"""Expanding time splits (L1-L7) expressed as row predicates.

A row is tagged with every (split_id, role) whose date window contains it:
one ``explode`` over a literal array of split windows, no join and no copy of
the data per split.  Training rows belong to several expanding splits, so the
long-form output grows by at most the number of splits.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _d(y, m):
    return date(y, m, 1)


def expanding_windows(base_year: int, include_holdout: bool = True):
    """L1: four quarter-ahead splits after a full base year, plus the optional
    fifth (two full years -> Q1 of the third)."""
    y0, y1 = base_year, base_year + 1
    out = []
    for k, (m_train_end, m_val) in enumerate([(1, 1), (4, 4), (7, 7), (10, 10)], start=1):
        train_end = _d(y1, m_train_end)
        out.append((k, _d(y0, 1), train_end, _d(y1, m_val), _d(y1, m_val + 3) if m_val < 10 else _d(y1 + 1, 1),
                    f"{y0}_full" + (f"+{y1}_Q1" + "".join(f"Q{i}" for i in range(2, k)) if k > 1 else "")
                    + f" -> {y1}_Q{k}"))
    if include_holdout:
        out.append((5, _d(y0, 1), _d(y1 + 1, 1), _d(y1 + 1, 1), _d(y1 + 1, 4), f"{y0}_full+{y1}_full -> {y1 + 1}_Q1"))
    return out


def history_windows(first: date | None, last: date | None):
    """L1 over a table's whole history, of which ``first`` and ``last`` are the first and last
    date: a split for every quarter after the first calendar year, up to the last date's,
    trained on all that is before its quarter.  ``expanding_windows`` are the first five."""
    out, y0 = [], first.year if first else 0
    starts = [_d(y, m) for y in range(y0 + 1, last.year + 1) for m in (1, 4, 7, 10) if _d(y, m) <= last] if first else []
    for k, start in enumerate(starts, start=1):
        y, q = start.year, start.month // 3 + 1
        past = "+".join([*(f"{x}_full" for x in range(y0, y)), *([f"{y}_" + "".join(f"Q{i}" for i in range(1, q))] if q > 1 else [])])
        out.append((k, _d(y0, 1), start, start, _d(y, start.month + 3) if q < 4 else _d(y + 1, 1), f"{past} -> {y}_Q{q}"))
    return out


def windows_of(df: DataFrame, date_col: str = "sales_month"):
    """``history_windows`` of the dates of ``df``."""
    return history_windows(*df.agg(F.min(date_col), F.max(date_col)).first())


def cutoff_windows(base_year: int):
    """L2 (v1): train is everything up to the cut-off, validate the next quarter."""
    y1 = base_year + 1
    return [(k, _d(1900, 1), _d(y1, m), _d(y1, m), _d(y1, m + 3) if m < 10 else _d(y1 + 1, 1), f"<= cut {k}")
            for k, m in enumerate([1, 4, 7, 10], start=1)]


def _explode_windows(df: DataFrame, windows, roles, date_col: str) -> DataFrame:
    """``df`` with a struct ``_s`` for each (window, role) that holds the row.  Rows that no
    window holds go first; the rest is plain conditions, which Spark compiles (a filter of an
    array of windows by a lambda is interpreted for every row)."""
    d = F.col(date_col)
    spans = [(w, role, w[1 if role == "train" else 3], w[2 if role == "train" else 4]) for w in windows for role in roles]
    reach = (d >= F.lit(min(lo for *_, lo, _ in spans))) & (d < F.lit(max(hi for *_, hi in spans)))
    hits = F.array(*[F.when((d >= F.lit(lo)) & (d < F.lit(hi)), F.struct(
        F.lit(w[0]).alias("split_id"), F.lit(role).alias("role"), F.lit(w[5]).alias("description"))) for w, role, lo, hi in spans])
    return df.where(reach).select("*", F.explode(hits).alias("_s")).where("_s is not null")


def tag_splits(df: DataFrame, windows, date_col: str = "sales_month", drop_empty: bool = True) -> DataFrame:
    """Long form: one output row per (row, split, role) membership.

    ``drop_empty`` keeps only splits whose train and validation windows both
    hold rows (the optional hold-out split exists only when its year does).
    """
    out = _explode_windows(df, windows, ("train", "val"), date_col)
    out = out.select(*df.columns, *[F.col(f"_s.{c}").alias(c) for c in ("split_id", "role", "description")])
    return out.where(F.col("split_id").isin(whole_splits(df, windows, date_col))) if drop_empty else out


def whole_splits(df: DataFrame, windows, date_col: str = "sales_month") -> list:
    """Ids of the splits whose train and validation windows both hold rows: the windows are
    tried on the distinct dates, and a count for each split (at most their number) is read."""
    dates = _explode_windows(df.select(date_col).distinct(), windows, ("train", "val"), date_col)
    roles = dates.groupBy("_s.split_id").agg(F.count_distinct("_s.role").alias("n")).where("n = 2").collect()
    return sorted(r["split_id"] for r in roles)


def split_frames(df: DataFrame, windows, date_col: str = "sales_month") -> list:
    """(split_id, training rows, validation rows) of each split of ``whole_splits``: row
    predicates on ``df``, no row is tagged or copied."""
    d, whole = F.col(date_col), whole_splits(df, windows, date_col)
    own = lambda lo, hi, k: df.where((d >= F.lit(lo)) & (d < F.lit(hi))).withColumn("split_id", F.lit(k))
    return [(k, own(ts, te, k), own(vs, ve, k)) for k, ts, te, vs, ve, _ in windows if k in whole]


def in_windows(df: DataFrame, windows, role: str, date_col: str = "sales_month") -> DataFrame:
    """``df`` with split_id, a row for each of the windows of one ``role`` (train or val) that holds it."""
    return (_explode_windows(df, windows, (role,), date_col)
            .select(*df.columns, F.col("_s.split_id").alias("split_id")))


def train_moments(df: DataFrame, windows, cols, keys=(), date_col: str = "sales_month") -> DataFrame:
    """Count, mean, population std, least and greatest value of ``cols`` over each
    split's training rows, by ``keys``: (split_id, keys..., {col}__n, __mean, __std, __min, __max).

    The fact is aggregated once, by month and ``keys``; what the expanding windows
    add up are these partial moments, a row for each month and key, so no row of
    the fact is copied for the splits it belongs to.  Null keys are a group.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_n_{c}"), F.sum(x).alias(f"_s_{c}"), F.var_pop(x).alias(f"_v_{c}"),
                 F.min(x).alias(f"_a_{c}"), F.max(x).alias(f"_b_{c}")]
    months = in_windows(df.groupBy(date_col, *keys).agg(*aggs), windows, "train", date_col)
    whole = Window.partitionBy("split_id", *keys)  # at most a row for each month
    mean = {c: F.try_divide(F.sum(f"_s_{c}").over(whole), F.sum(f"_n_{c}").over(whole)) for c in cols}
    months = months.select("*", *[m.alias(f"_m_{c}") for c, m in mean.items()])
    out = []
    for c in cols:
        n, away = F.col(f"_n_{c}"), F.try_divide(F.col(f"_s_{c}"), F.col(f"_n_{c}")) - F.col(f"_m_{c}")
        out += [F.sum(n).alias(f"{c}__n"), F.first(f"_m_{c}").alias(f"{c}__mean"),
                F.sqrt(F.try_divide(F.sum(n * (F.col(f"_v_{c}") + away * away)), F.sum(n))).alias(f"{c}__std"),
                F.min(f"_a_{c}").alias(f"{c}__min"), F.max(f"_b_{c}").alias(f"{c}__max")]
    return months.groupBy("split_id", *keys).agg(*out)


def split_summary(tagged: DataFrame, date_col: str = "sales_month") -> DataFrame:
    """L7 + the integrity check: per split and role counts and periods; a split is
    kept only when both roles are non-empty and max(train) < min(val)."""
    s = tagged.groupBy("split_id", "role").agg(F.count("*").alias("rows"), F.min(date_col).alias("start"),
                                                F.max(date_col).alias("end"),
                                                F.count_distinct(date_col).alias("months"))
    tr = s.where(F.col("role") == "train").select("split_id", F.col("end").alias("_tmax"))
    va = s.where(F.col("role") == "val").select("split_id", F.col("start").alias("_vmin"))
    ok = tr.join(va, "split_id").select("split_id", (F.col("_tmax") < F.col("_vmin")).cast("int").alias("ordered"))
    return s.join(ok, "split_id", "left")


def gap_windows(train_end: date, test_start: date, test_end: date, start: date = date(1900, 1, 1)):
    """L3: train before ``train_end``, test in [test_start, test_end) with a gap in between."""
    return [(1, start, train_end, test_start, test_end, f"< {train_end} -> [{test_start}, {test_end})")]


def month_holdout_windows(months):
    """L4: consecutive months -> (train all but the last two, validate, test) as two splits."""
    ms = sorted(months)
    tr_end, val, test = ms[-2], ms[-2], ms[-1]
    nxt = lambda d: date(d.year + (d.month // 12), d.month % 12 + 1, 1)
    return [(1, ms[0], tr_end, val, nxt(val), "month hold-out: validation"),
            (2, ms[0], tr_end, test, nxt(test), "month hold-out: test")]


def holdout_year_windows(train_years, holdout_year: int):
    """All training years -> the whole hold-out year."""
    return [(1, date(min(train_years), 1, 1), date(max(train_years) + 1, 1, 1),
             date(holdout_year, 1, 1), date(holdout_year + 1, 1, 1), f"hold-out {holdout_year}")]


def random_split(df: DataFrame, fraction: float = 0.8, seed: int = 42, key_cols=None) -> DataFrame:
    """Repeatable 80/20 split by a hash of the row key (independent of partitioning)."""
    key_cols = key_cols or ["sales_month", "primary_platform", "store_name", "brand_name", "product_code"]
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]), F.lit(1_000_000)) / 1_000_000.0
    return df.withColumn("role", F.when(h < fraction, "train").otherwise("val"))
