"""Time intelligence (WIN-03..05): MTD/QTD/YTD, rolling window, vs last year.

The daily series is the calendar (bounded by the number of days) left
joined to the day's revenue, so period-to-date values exist on days
without sales, as in a calendar-filtered measure.  Windows partition by
period (year / quarter / month); only the rolling window spans periods and
runs over the day series (one row per day)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.dax import blank_sub, div, dsum


def daily_revenue(sales: DataFrame, calendar: DataFrame, as_of: Column, by=(), since: Column | None = None) -> DataFrame:
    """Calendar days up to ``as_of`` with the revenue of that day (NULL = BLANK).
    With ``by`` every group that ever sold has a row for every day from
    ``since`` on, so running totals have no gaps."""
    # exact DECIMAL day totals so running sums do not depend on addition order
    day = sales.groupBy(*by, F.col("sales_date").alias("date")).agg(
        F.sum(F.col("revenue").cast("decimal(18,2)")).alias("revenue"))
    if by:
        every = sales.select(*by).distinct().withColumn("date", F.explode(F.sequence(since, as_of)))
        return (every.join(calendar.select("date", "year", "month_num", "quarter"), "date")
                .join(day, [*by, "date"], "left"))
    cal = calendar.where(F.col("date") <= as_of).select("date", "year", "month_num", "quarter")
    return cal.join(day, "date", "left")


def period_to_date(series: DataFrame, by=(), rolling_days: int = 30) -> DataFrame:
    """MEA-08/09/10/12: MTD, QTD, YTD and the inclusive rolling window."""
    upto = (Window.unboundedPreceding, Window.currentRow)
    base = [F.col(b) for b in by]
    mtd = Window.partitionBy(*base, "year", "month_num").orderBy("date").rowsBetween(*upto)
    qtd = Window.partitionBy(*base, "year", "quarter").orderBy("date").rowsBetween(*upto)
    ytd = Window.partitionBy(*base, "year").orderBy("date").rowsBetween(*upto)
    roll = (Window.partitionBy(*base).orderBy(F.unix_date("date"))
            .rangeBetween(-(rolling_days - 1), 0))
    r = F.col("revenue")
    return series.select(*by, "date", r.cast("double").alias("revenue"),
                         F.sum(r).over(mtd).cast("double").alias("revenue_mtd"),
                         F.sum(r).over(qtd).cast("double").alias("revenue_qtd"),
                         F.sum(r).over(ytd).cast("double").alias("revenue_ytd"),
                         F.sum(r).over(roll).cast("double").alias(f"revenue_{rolling_days}d_rolling"))


def vs_last_year_daily(series: DataFrame, by=()) -> DataFrame:
    """MEA-11 at day grain: same day last year (29 Feb -> 28 Feb)."""
    prev = series.select(*by, F.col("date").alias("ly_date"), F.col("revenue").alias("revenue_ly"))
    cur = series.withColumn("ly_date", F.add_months("date", -12))
    x = cur.join(prev, [*by, "ly_date"], "left")
    cur_v, ly_v = F.col("revenue").cast("double"), F.col("revenue_ly").cast("double")
    return x.select(*by, "date", cur_v.alias("revenue"), ly_v.alias("revenue_ly"),
                    div(blank_sub(cur_v, ly_v), ly_v).alias("revenue_vs_ly"))


def monthly_revenue(sales: DataFrame, by=()) -> DataFrame:
    """Revenue per (year, month)."""
    return sales.groupBy(*by, F.year("sales_date").alias("year"), F.month("sales_date").alias("month_num")) \
        .agg(dsum("revenue").alias("revenue"))  # exact sum, as double


def with_prior(df: DataFrame, period: str, step: int, value: str, prior: str, by=(), last: Column | None = None) -> DataFrame:
    """``value`` of every period next to that of ``step`` periods before, as ``prior``.

    ``period`` is a number that grows by one from period to period.  A period
    without rows of its own is listed when the one before it has some and it
    lies not after ``last``, so what vanished shows.  Every row serves its own
    period and the later one; there is no self-join."""
    own = [c for c in df.columns if c not in (*by, period)]
    shared = F.array(F.struct(F.col(period).alias("p"), *[F.col(c).alias(c) for c in own], F.lit(None).cast(df.schema[value].dataType).alias(prior)),
                     F.struct((F.col(period) + step).alias("p"), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in own],
                              F.col(value).alias(prior)))
    x = df.select(*by, F.explode(shared).alias("e")).select(*by, F.col("e.p").alias(period), *[f"e.{c}" for c in (*own, prior)])
    if last is not None:
        x = x.where(F.col(period) <= last)
    return x.groupBy(*by, period).agg(*[F.max(c).alias(c) for c in (*own, prior)])


def growth(value: str, prior: str) -> Column:
    """Change relative to the earlier period: -1 for a vanished one, BLANK without an earlier one."""
    return div(blank_sub(F.col(value), F.col(prior)), F.col(prior))


def month_index(date: Column | str) -> Column:
    return F.year(date) * 12 + F.month(date) - 1


def vs_last_year_monthly(monthly: DataFrame, as_of: Column, by=()) -> DataFrame:
    """MEA-11 at month grain: the same month of the previous year, up to the month of ``as_of``."""
    m = monthly.withColumn("mi", F.col("year") * 12 + F.col("month_num") - 1).select(*by, "mi", "revenue")
    x = with_prior(m, "mi", 12, "revenue", "revenue_ly", by, month_index(as_of))
    year, month = F.expr("CAST(mi div 12 AS INT)"), F.expr("CAST(mi % 12 + 1 AS INT)")
    return x.select(*by, year.alias("year"), month.alias("month_num"),
                    F.concat(year, F.lit("-"), F.lpad(month.cast("string"), 2, "0")).alias("year_month"),
                    "revenue", "revenue_ly", growth("revenue", "revenue_ly").alias("revenue_vs_ly"))
