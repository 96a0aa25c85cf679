"""Range joins as equi-joins on bins, and interval overlaps by a sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN_DAYS = 32   # width of the finest bins
STEP = 16       # an interval over more bins than this goes to bins STEP times as wide


def _day(c: Column | str) -> Column:
    return F.unix_date(c)


def levels(longest_days: int) -> int:
    """Number of length classes for intervals of up to ``longest_days``."""
    n = 1
    while longest_days > BIN_DAYS * STEP ** n:
        n += 1
    return n


def binned(intervals: DataFrame, start: str, end: str, n_levels: int) -> DataFrame:
    """Intervals with the bins they touch (``level``, ``bin``).

    The class of an interval follows its length, so it has at most STEP + 1
    rows however long it is (beyond the last class, as many as it needs)."""
    days = F.datediff(end, start) + 1
    level = F.lit(n_levels - 1)
    for k in range(n_levels - 2, -1, -1):
        level = F.when(days <= BIN_DAYS * STEP ** (k + 1), F.lit(k)).otherwise(level)
    x = intervals.where(F.col(start) <= F.col(end)).withColumn("level", level)
    width = F.lit(BIN_DAYS) * F.pow(F.lit(STEP), F.col("level")).cast("int")
    return x.withColumn("bin", F.explode(F.sequence(F.floor(_day(start) / width), F.floor(_day(end) / width))))


def join_intervals(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, keys: list[str],
                   how: str = "left", longest_days: int | None = None) -> DataFrame:
    """``points`` joined to the intervals of equal ``keys`` that hold the day ``point``.

    A day lies in one bin of each class and an interval has one row per bin,
    so a pair meets exactly once.  With one class, the usual case, points are
    not multiplied; ``longest_days`` saves the look for the longest interval
    (longer ones are still joined, only with more rows)."""
    if longest_days is None:
        longest_days = intervals.agg(F.max(F.datediff(end, start) + 1)).first()[0] or 1
    n = levels(longest_days)
    right = binned(intervals, start, end, n)
    right = right.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("level").alias("_level"), F.col("bin").alias("_bin"),
                         F.col(start).alias("_start"), F.col(end).alias("_end"),
                         *[c for c in intervals.columns if c not in (*keys, start, end)])
    at = lambda k: F.floor(_day(point) / (BIN_DAYS * STEP ** k))
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    if n == 1:
        left, met = points, (*same, F.col("_bin") == at(0))
        names = points.columns
    elif how == "inner":
        left = points.withColumn("_p", F.explode(F.array(*[F.struct(F.lit(k).alias("l"), at(k).alias("b")) for k in range(n)])))
        met, names = (*same, F.col("_p.l") == F.col("_level"), F.col("_p.b") == F.col("_bin")), points.columns
    else:
        # a point without interval shows once: classes are looked up one by one, for the points' distinct keys and days
        days = points.select(*keys, point).distinct()
        found = join_intervals(days, intervals, point, start, end, keys, "inner", longest_days)
        extra = [c for c in found.columns if c not in (*keys, point)]
        found = found.select(*[F.col(c).alias(f"_{c}") for c in (*keys, point)], *extra)
        on = [F.col(c) == F.col(f"_{c}") for c in (*keys, point)]
        return points.join(found, on, "left").drop(*[f"_{c}" for c in (*keys, point)])
    inside = F.col(point).between(F.col("_start"), F.col("_end"))
    x = left.join(right, [*met, inside], how)
    return x.select(*names, *[c for c in intervals.columns if c not in (*keys, start, end)])


def join_promotions(lines: DataFrame, promotions: DataFrame, date_col: str = "order_date", longest_days: int | None = None) -> DataFrame:
    """Left range join of sales lines to the promotions active that day (JOI-04);
    overlapping promotions fan out exactly as BETWEEN does."""
    return join_intervals(lines, promotions.select("category", "promo_name", "start_date", "end_date"), date_col,
                          "start_date", "end_date", ["category"], "left", longest_days)


def overlaps(intervals: DataFrame, name: str, start: str, end: str, keys: list[str], longest_days: int | None = None) -> DataFrame:
    """Stretches of days that more than one interval covers (DQ-06): keys,
    from_date, to_date, n, names.

    A sweep: every interval is +1 on its first day and -1 after its last;
    running sums per key give the number of intervals between two such days.
    Only the stretches that overlap are looked up again for their names."""
    real = intervals.where(F.col(start) <= F.col(end))
    ends = F.explode(F.array(F.struct(F.col(start).alias("d"), F.lit(1).alias("step")),
                             F.struct(F.date_add(F.col(end), 1).alias("d"), F.lit(-1).alias("step")))).alias("e")
    turns = real.select(*keys, ends).groupBy(*keys, F.col("e.d").alias("from_date")).agg(F.sum("e.step").alias("step"))
    w = Window.partitionBy(*keys).orderBy("from_date")
    runs = (turns.withColumn("n", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("to_date", F.date_sub(F.lead("from_date").over(w), 1)).where("n > 1"))
    held = join_intervals(runs.select(*keys, "from_date", "to_date", "n"), real.select(*keys, start, end, name), "from_date", start, end,
                          keys, "inner", longest_days)
    return held.groupBy(*keys, "from_date", "to_date", "n").agg(F.sort_array(F.collect_list(name)).alias("names"))
