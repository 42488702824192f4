"""Global statistics that must be exact but stay distributed.

``percentile`` (exact, linear interpolation) keeps a value->count map in the
final task, unbounded for a fact column.  ``quantiles`` narrows a bracket around
each wanted rank instead: while a bracket holds more than ``limit`` rows, one
aggregate counts its rows in ``bins`` equal steps and the bracket shrinks to the
step that holds the rank; the brackets of all ranks are narrowed in the same pass.
At most ``limit`` values or ``bins`` counts a bracket reach the driver at a time, at
every size of input.
``group_quantiles`` does so for many groups and columns at once, on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _narrowed(base: DataFrame, brackets: list[tuple], bins: int) -> list[list[tuple]]:
    """For each bracket (rows below, least, greatest, rows) its steps with rows, as brackets, from one pass."""
    x, inf = F.col("x"), float("inf")
    at, step = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, (_, a, b, _) in enumerate(brackets):
        inside, width = (x >= F.lit(a)) & (x <= F.lit(b)), b / bins - a / bins  # no overflow
        own = F.least(F.floor((x / bins - F.lit(a) / bins) / width * bins), F.lit(bins - 1)) if width > 0 else F.when(x == a, 0).otherwise(bins - 1)
        at, step = F.when(inside, F.lit(i)).otherwise(at), F.when(inside, own.cast("int")).otherwise(step)
    rows = (base.select("x", "w", at.alias("i"), step.alias("s")).where("i is not null").groupBy("i", "s")
            .agg(F.sum("w").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).collect())
    out = [[] for _ in brackets]
    for r in sorted(rows, key=lambda r: (r["i"], r["s"])):
        own = out[r["i"]]
        own.append((own[-1][0] + own[-1][3] if own else brackets[r["i"]][0], r["a"], r["b"], r["n"]))
    return out


def _values(base: DataFrame, brackets: list[tuple]) -> dict:
    """(value, count) pairs of each bracket, sorted, from one pass."""
    x, at = F.col("x"), F.lit(None).cast("int")
    for i, (_, a, b, _) in enumerate(brackets):
        at = F.when((x >= F.lit(a)) & (x <= F.lit(b)), F.lit(i)).otherwise(at)
    out: dict = {}
    for r in base.select("x", "w", at.alias("i")).where("i is not null").groupBy("i", "x").agg(F.sum("w").alias("n")).collect():
        out.setdefault(brackets[r["i"]], []).append((r["x"], r["n"]))
    return {k: sorted(v) for k, v in out.items()}


def _at(pairs, below, rank):
    """The value of ``rank`` among sorted (value, count) pairs that start at rank ``below``."""
    for v, c in pairs:
        below += c
        if rank < below:
            return v
    return None


def quantiles(df: DataFrame, column: str, probs, limit: int = 10_000, bins: int = 4096, fact: bool = False,
              weight: str | None = None) -> list:
    """Exact linear-interpolation quantiles of a numeric column (NULL and NaN ignored).

    All ranks are narrowed together.  ``fact``: the column has many values, so they are
    not grouped at first.  ``weight``: column with the (whole, positive) number of times that a
    row counts."""
    probs, inf, x = list(probs), float("inf"), F.col("x")
    w = (F.col(weight) if weight else F.lit(1)).cast("long")
    base = df.select(F.col(column).cast("double").alias("x"), w.alias("w")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    known = None
    if not fact:
        first = sorted((r["x"], r["n"]) for r in base.groupBy("x").agg(F.sum("w").alias("n")).limit(limit + 1).collect())
        known = first if len(first) <= limit else None
    if known is not None:
        n = sum(c for _, c in known)
    else:
        finite = F.when(F.abs(x) < inf, x)
        rows = lambda where: F.coalesce(F.sum(F.when(where, F.col("w"))), F.lit(0))
        ends = base.agg(rows(F.lit(True)), rows(x == -inf), rows(F.abs(x) < inf), F.min(finite), F.max(finite)).first()
        n, low, mid, a, b = ends
    if not n:
        return [None] * len(probs)
    wanted = sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})
    if known is not None:
        at = {r: _at(known, 0, r) for r in wanted}
    else:
        whole = [(0, -inf, -inf, low), (low, a, b, mid), (low + mid, inf, inf, n - low - mid)]

        def holder(found, rank):
            return next(k for k in found if k[0] <= rank < k[0] + k[3])

        held = {r: holder([k for k in whole if k[3]], r) for r in wanted}
        while wide := sorted({k for k in held.values() if k[3] > limit and k[1] < k[2]}):
            steps = dict(zip(wide, _narrowed(base, wide, bins)))
            held = {r: holder(steps[k], r) if k in steps else k for r, k in held.items()}
            # a rank that is its bracket's first or last is known
            held = {r: (r, v, v, 1) if (v := k[1] if r == k[0] else k[2] if r == k[0] + k[3] - 1 else None) is not None else k
                    for r, k in held.items()}
        narrow = sorted({k for k in held.values() if k[1] < k[2]})
        pairs = _values(base, narrow) if narrow else {}
        at = {r: _at(pairs[k], k[0], r) if k in pairs else k[1] for r, k in held.items()}
    out = []
    for p in probs:
        pos = p * (n - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        vlo, vhi = float(at[lo]), float(at[hi])
        out.append(vlo if lo == hi else vlo + (pos - lo) * (vhi - vlo))
    return out


def quantile(df: DataFrame, column: str, p: float, **kw):
    return quantiles(df, column, [p], **kw)[0]


def group_quantiles(df: DataFrame, keys, columns, probs, limit: int = 10_000, bins: int = 1024) -> DataFrame:
    """Exact linear-interpolation quantiles of every (group, column): ``keys``,
    ``column``, ``n`` and ``q``, an array in the order of ``probs``.

    All groups, columns and ranks are narrowed together: a pass counts, for each
    bracket with more than ``limit`` rows, its rows in ``bins`` equal steps, and
    each rank moves into its step.  The number of passes depends on the values'
    spread only.  No bracket or bin list reaches the driver, and no task holds more
    than ``limit`` values or ``bins`` counts of a bracket in order.  Null keys are a
    group; NULL and NaN values are ignored; groups without values give no row.
    """
    from ..session import cut_lineage

    x, inf = F.col("x"), float("inf")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), (F.col(c).cast("double") + 0.0).alias("x")) for c in columns])
    long = (df.select(*keys, F.explode(pairs).alias("_v")).select(F.struct(*keys, F.col("_v.column")).alias("g"), F.col("_v.x").alias("x"))
            .where(x.isNotNull() & ~F.isnan(x)))
    finite = F.when(F.abs(x) < inf, x)
    stats = cut_lineage(long.groupBy("g").agg(F.count("*").alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
                                              F.min(finite).alias("flo"), F.max(finite).alias("fhi")))

    def pos(p):
        return F.lit(float(p)) * (F.col("n") - 1)

    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(pos(p)), F.ceil(pos(p))) for p in probs])))
    ranks = stats.select("g", F.explode(wanted).alias("rank"), "lo", "hi", "flo", "fhi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))
    bracket = ["g", "lo", "hi"]
    here = F.col("rank") - F.col("below")
    in_step = (here < F.col("upto")) & (here >= F.col("upto") - F.col("c"))
    in_order = Window.partitionBy(*bracket)
    is_wide = (F.col("inside") > limit) & (F.col("lo") < F.col("hi"))
    while True:
        wide = ranks.where(is_wide)
        if wide.isEmpty():
            break
        width = F.col("fhi") / 2 - F.col("flo") / 2
        step = (F.when(x == -inf, -1).when(x == inf, bins)
                .when(width > 0, F.least(F.floor((x / 2 - F.col("flo") / 2) / F.nullif(width, F.lit(0.0)) * bins), F.lit(bins - 1)))
                .otherwise(F.when(x == F.col("lo"), 0).otherwise(bins - 1)))
        inside = long.join(wide.select(*bracket, "flo", "fhi").distinct(), "g").where((x >= F.col("lo")) & (x <= F.col("hi")))
        counts = (inside.groupBy(*bracket, step.alias("step")).agg(F.count("*").alias("c"), F.min(x).alias("a"), F.max(x).alias("b"))
                  .withColumn("upto", F.sum("c").over(in_order.orderBy("step"))))
        moved = wide.join(counts, bracket).where(in_step).select(
            "g", "rank", F.col("a").alias("lo"), F.col("b").alias("hi"), F.col("a").alias("flo"), F.col("b").alias("fhi"),
            (F.col("below") + F.col("upto") - F.col("c")).alias("below"), F.col("c").alias("inside"))
        ranks = cut_lineage(ranks.where(~is_wide).unionByName(moved))
    narrow = ranks.where("lo < hi")
    values = (long.join(narrow.select(*bracket).distinct(), "g").where((x >= F.col("lo")) & (x <= F.col("hi")))
              .groupBy(*bracket, "x").agg(F.count("*").alias("c")).withColumn("upto", F.sum("c").over(in_order.orderBy("x"))))
    found = (narrow.join(values, bracket).where(in_step).select("g", "rank", "x")
             .unionByName(ranks.where("lo = hi").select("g", "rank", F.col("lo").alias("x"))))
    found = found.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at"))

    def value(p):
        low, high = F.col("at")[F.floor(pos(p))], F.col("at")[F.ceil(pos(p))]
        return F.when(low == high, low).otherwise(low + (pos(p) - F.floor(pos(p))) * (high - low))

    return (stats.select("g", "n").join(found, "g")
            .select("g.*", "n", F.array(*[value(p) for p in probs]).alias("q")))


def sorted_quantile(arr, p: float):
    """Linear-interpolation quantile of a sorted array column (NULL when empty)."""
    n = F.size(arr)
    pos = (n - 1) * F.lit(p)
    lo = F.floor(pos).cast("int")
    hi = F.ceil(pos).cast("int")
    vlo = F.element_at(arr, lo + 1)
    vhi = F.element_at(arr, hi + 1)
    return F.when(n > 0, vlo + (pos - lo) * (vhi - vlo))


def scalars(df: DataFrame, **aggs) -> dict:
    """One-pass global aggregates returned as Python scalars (a single row)."""
    row = df.agg(*[e.alias(k) for k, e in aggs.items()]).first()
    return {k: row[k] for k in aggs}
