"""Exact quantiles that scale with the row count.

Spark's exact ``percentile`` keeps a value->count map in one buffer, which
is fine for features with few distinct values (days, counts, cents in a
bounded range) but not for a continuous column over 10^8 rows.  Here an
approximate-quantile sketch (bounded memory, partial aggregation) brackets
the answer: with relative rank error e = 1/accuracy the order statistics
we need lie between the values at ranks q -/+ 3e, widened by one distinct
value on each side (the sketch's ceil(p n) rank convention can sit one
rank off floor / ceil((n - 1) q)).  Only the rows inside the bracket --
O(n / accuracy) of them, grouped to (value, count) -- are ranked exactly,
on top of the count of rows below it.  The result is the linear
interpolation between the order statistics at floor(h) and ceil(h),
h = (n - 1) q (pandas / ``percentile`` semantics).

All columns are handled together: four single-row aggregate passes over
the data whatever the number of columns; only those few scalars per
column reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, cols: list[str], q: float, accuracy: int = 10_000) -> dict[str, float | None]:
    """{column: exact q-quantile} (NULLs ignored; None for an empty column)."""
    eps = 3.0 / accuracy
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    # pass 1: count and sketch bracket per column
    r1 = x.agg(*[F.struct(F.count(c).alias("n"),
                          F.percentile_approx(c, [max(0.0, q - eps), min(1.0, q + eps)], accuracy).alias("ab"))
                 .alias(c) for c in cols]).first()
    live = [c for c in cols if r1[c]["n"] > 0]
    out: dict[str, float | None] = {c: None for c in cols}
    if not live:
        return out
    n = {c: r1[c]["n"] for c in live}
    a = {c: r1[c]["ab"][0] for c in live}
    b = {c: r1[c]["ab"][1] for c in live}
    # pass 2: widen by one distinct value on each side
    r2 = x.agg(*[F.struct(F.max(F.when(F.col(c) < a[c], F.col(c))).alias("lo"),
                          F.min(F.when(F.col(c) > b[c], F.col(c))).alias("hi")).alias(c) for c in live]).first()
    lo_v = {c: r2[c]["lo"] if r2[c]["lo"] is not None else a[c] for c in live}
    hi_v = {c: r2[c]["hi"] if r2[c]["hi"] is not None else b[c] for c in live}
    # pass 3: rows below each bracket
    r3 = x.agg(*[F.count_if(F.col(c) < lo_v[c]).alias(c) for c in live]).first()
    h = {c: (n[c] - 1) * q for c in live}
    # pass 4: the bracketed values of every column, ranked within the column
    tagged = F.array(*[F.when((F.col(c) >= lo_v[c]) & (F.col(c) <= hi_v[c]),
                              F.struct(F.lit(c).alias("f"), F.col(c).alias("x"))) for c in live])
    band = (x.select(F.explode(tagged).alias("e")).where(F.col("e").isNotNull())
            .select("e.f", "e.x").groupBy("f", "x").agg(F.count(F.lit(1)).alias("cnt")))
    below = F.create_map(*[v for c in live for v in (F.lit(c), F.lit(r3[c]))])
    lo_r = F.create_map(*[v for c in live for v in (F.lit(c), F.lit(math.floor(h[c])))])
    hi_r = F.create_map(*[v for c in live for v in (F.lit(c), F.lit(math.ceil(h[c])))])
    w = Window.partitionBy("f").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = band.select("f", "x", (F.sum("cnt").over(w) + below[F.col("f")]).alias("upto"))
    picked = ranked.groupBy("f").agg(
        F.min(F.when(F.col("upto") > lo_r[F.col("f")], F.col("x"))).alias("v_lo"),
        F.min(F.when(F.col("upto") > hi_r[F.col("f")], F.col("x"))).alias("v_hi"))
    for r in picked.toLocalIterator():
        c = r["f"]
        frac = h[c] - math.floor(h[c])
        out[c] = r["v_lo"] + (r["v_hi"] - r["v_lo"]) * frac
    return out


def exact_quantile(df: DataFrame, col: str, q: float, accuracy: int = 10_000) -> float | None:
    """Exact q-quantile of one column."""
    return exact_quantiles(df, [col], q, accuracy)[col]


def grouped_exact_quantile(df: DataFrame, keys: list[str], col: str, q: float, out: str,
                           accuracy: int = 10_000) -> DataFrame:
    """Exact q-quantile of ``col`` per group of ``keys`` -> (keys..., out).

    The same bracket method per group: a sketch per group (partial
    aggregation, so a hot group is merged from partial sketches), the
    bracket widened by one distinct value, then only the bracketed rows
    are ranked within their group.  The per-group bracket tables hold one
    row per group and come out of an aggregation, so AQE knows their exact
    size before planning the joins and broadcasts them only when small."""
    eps = 3.0 / accuracy
    x = df.select(*keys, F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    b1 = (x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                               F.percentile_approx("x", [max(0.0, q - eps), min(1.0, q + eps)], accuracy).alias("ab"))
          .select(*keys, "n", F.col("ab")[0].alias("a"), F.col("ab")[1].alias("b")))
    b2 = (x.join(b1, keys).groupBy(*keys)
          .agg(F.first("n").alias("n"),
               F.coalesce(F.max(F.when(F.col("x") < F.col("a"), F.col("x"))), F.first("a")).alias("lo_v"),
               F.coalesce(F.min(F.when(F.col("x") > F.col("b"), F.col("x"))), F.first("b")).alias("hi_v")))
    j = x.join(b2, keys)
    below = j.groupBy(*keys).agg(F.count_if(F.col("x") < F.col("lo_v")).alias("below"),
                                 F.first("n").alias("n"))
    band = (j.where(F.col("x").between(F.col("lo_v"), F.col("hi_v")))
            .groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("c")))
    w = Window.partitionBy(*keys).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = (F.col("n") - 1).cast("double") * F.lit(q)
    ranked = band.join(below, keys).select(*keys, "x", h.alias("h"),
                                           (F.sum("c").over(w) + F.col("below")).alias("upto"))
    picked = ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("upto") > F.floor("h"), F.col("x"))).alias("v_lo"),
        F.min(F.when(F.col("upto") > F.ceil("h"), F.col("x"))).alias("v_hi"),
        F.first("h").alias("h"))
    return picked.select(*keys, (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("h") - F.floor("h")))
                         .alias(out))
