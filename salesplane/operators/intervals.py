"""Joins of points with intervals of any number and length (J5), and the promotional
calendar on an event table of any size (C1-C5).

An interval of n days belongs to the length class 2^l >= n and lies in at most two
bins of that width, so it becomes at most two rows.  A point has one bin in each
class that occurs, so the join is an equi-join on (class, bin) with the exact bounds
tested afterwards; a pair meets at most once and no nested-loop join is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flag
from .calendar import event_column


def _day(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def _bin(day: Column, cls: Column) -> Column:
    return F.call_function("shiftright", day, cls)


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str) -> DataFrame:
    """All pairs with ``start`` <= ``point`` <= ``end`` (dates, both ends inside): the columns of
    ``points``, then those of ``intervals``; their names must differ.  Nulls and intervals that
    end before they start meet nothing; repeated rows meet as often as they occur.

    The length classes that occur (20 at most, as dates span some 10^6 days) reach the
    driver; a point is copied once for each of them.
    """
    both = set(points.columns) & set(intervals.columns)
    if both:
        raise ValueError(f"columns on both sides: {sorted(both)}")
    lo, hi = _day(F.col(start)), _day(F.col(end))
    # The least l with 2^l >= hi - lo + 1: the binary digits of hi - lo.
    cls = F.when(hi == lo, 0).otherwise(F.length(F.bin(hi - lo)))
    spans = intervals.where(hi >= lo).select("*", cls.cast("int").alias("_cls"))
    classes = [r[0] for r in spans.select("_cls").distinct().collect()]
    if not classes:
        return points.limit(0).join(intervals.limit(0), F.col(point) == F.col(start))
    first, last = _bin(lo, F.col("_cls")), _bin(hi, F.col("_cls"))
    spans = spans.select("*", F.explode(F.when(first == last, F.array(first)).otherwise(F.array(first, last))).alias("_bin"))
    day = _day(F.col(point))
    cells = F.array(*[F.struct(F.lit(c).alias("c"), _bin(day, F.lit(c)).alias("b")) for c in sorted(classes)])
    dealt = points.where(F.col(point).isNotNull()).select("*", F.explode(cells).alias("_cell"))
    hit = (F.col("_cell.c") == F.col("_cls")) & (F.col("_cell.b") == F.col("_bin")) & (day >= lo) & (day <= hi)
    return dealt.join(spans, hit).select(*points.columns, *intervals.columns)


def event_intervals(events: DataFrame) -> DataFrame:
    """(event, anchor, days, intensity) plus first_day and last_day: an event holds the
    days whose distance to its anchor is at most half of ``days``."""
    reach = F.floor(F.col("days") / 2).cast("int")
    return events.select("*", F.date_sub("anchor", reach).alias("first_day"), F.date_add("anchor", reach).alias("last_day"))


def calendar_by_join(dates: DataFrame, events: DataFrame, date_col: str = "d", names=()) -> DataFrame:
    """C1-C5 of ``calendar_features`` for an event table of any size, as joins.

    ``events`` has a row for each event and anchor day, neighbouring years included;
    ``names`` lists the events that get an is_<event> column.  Null dates keep their row
    with flags 0 and null distances, as does a date without anchors around it.
    Dates and anchor days are made distinct first, so at most one row a calendar day
    is ordered to find the next and the last anchor.
    """
    days = dates.select(F.col(date_col).cast("date").alias("_d")).distinct()
    away = F.abs(F.datediff("_d", "anchor"))
    peak = F.col("intensity") * F.greatest(F.lit(0.0), 1 - F.try_divide(away, F.col("days") / 2))
    held = interval_join(days, event_intervals(events.select("event", "anchor", "days", "intensity")), "_d", "first_day", "last_day")
    held = held.groupBy(F.col("_d").alias("_held")).agg(F.max(peak).alias("_peak"), F.lit(1).alias("_any"),
                                  *[F.max((F.col("event") == n).cast("int")).alias(event_column(n)) for n in names])
    anchors = events.select(F.col("anchor").alias("_a")).where("_a is not null").distinct()
    # Years are few; each holds its first anchor and its sorted anchor days (366 at most).
    years = anchors.groupBy(F.year("_a").alias("_y")).agg(F.min("_a").alias("_first"), F.sort_array(F.collect_list("_a")).alias("_all"))

    def of_year(shift: int, name: str) -> DataFrame:
        return years.select((F.col("_y") - shift).alias("_year"), F.col("_first").alias(f"_first{name}"), F.col("_all").alias(f"_all{name}"))

    out = days.select("_d", F.year("_d").alias("_year"))
    for shift, name in ((0, ""), (1, "_next"), (-1, "_prev")):
        out = out.join(of_year(shift, name), "_year", "left")
    out = out.join(held, F.col("_d") == F.col("_held"), "left")
    d = F.col("_d")
    none = F.array().cast("array<date>")
    here, after, before = (F.coalesce(F.col(f"_all{n}"), none) for n in ("", "_next", "_prev"))
    nearest_next = F.array_min(F.filter(F.concat(here, after), lambda a: a > d))
    nearest_last = F.array_max(F.filter(F.concat(here, before), lambda a: a < d))
    # C5 counts from the year's first anchor, or the last year's in January to June.
    behind = F.greatest(F.coalesce(F.datediff(d, "_first"), F.lit(0)), F.lit(0))
    last_year = F.coalesce(F.datediff(d, "_first_prev"), F.lit(0))
    from_last = F.least(F.when((behind == 0) & (F.month(d) <= 6), last_year).otherwise(behind), F.lit(365))
    return out.select(d.alias(date_col), flag(F.coalesce(F.col("_any"), F.lit(0)) == 1).alias("is_promotional_period"),
                      *[F.coalesce(F.col(f"`{event_column(n)}`"), F.lit(0)).alias(event_column(n)) for n in names],
                      F.least(F.datediff(nearest_next, d), F.lit(365)).alias("days_to_next_promo"),
                      F.when(d.isNotNull(), from_last).alias("days_from_last_promo"),
                      F.least(F.datediff(d, nearest_last), F.lit(365)).alias("true_days_since_last_promo"),
                      F.coalesce(F.col("_peak"), F.lit(0.0)).alias("event_intensity"))


def yearly_events(spark, promo_events, years) -> DataFrame:
    """``constants.PROMO_EVENTS`` as a table of (event, anchor, days, intensity) for each of ``years``."""
    from datetime import date
    rows = [(name, date(y, m, d), float(dur), float(inten)) for y in years for name, dates, dur, inten in promo_events for m, d in dates]
    return spark.createDataFrame(rows, "event string, anchor date, days double, intensity double")
