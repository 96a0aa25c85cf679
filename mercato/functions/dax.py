"""DAX-style semantics on Spark columns.

BLANK is NULL; DIVIDE returns BLANK on a zero or BLANK denominator; BLANK
counts as 0 under + and -; COUNTROWS over no rows is BLANK.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div(num: Column, den: Column) -> Column:
    """DIVIDE(num, den): NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def blank_sub(a: Column, b: Column) -> Column:
    """a - b where a BLANK operand counts as 0 (BLANK - BLANK stays BLANK)."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def count_rows_if(cond: Column) -> Column:
    """COUNTROWS(FILTER(...)): BLANK (NULL) when nothing matches."""
    return F.nullif(F.count_if(cond), F.lit(0))


def count_rows_if0(cond: Column) -> Column:
    """COALESCE(COUNTROWS(FILTER(...)), 0)."""
    return F.count_if(cond)


def dsum(col: str | Column, scale: int = 2) -> Column:
    """Exact sum of a fixed-point column (cents, tenths) returned as double:
    summed as DECIMAL so the total does not depend on row order."""
    x = F.col(col) if isinstance(col, str) else col
    return F.sum(x.cast(f"decimal(18,{scale})")).cast("double")


def davg(col: str | Column, scale: int = 2) -> Column:
    """AVERAGE of a fixed-point column: exact sum / non-blank count."""
    x = F.col(col) if isinstance(col, str) else col
    return F.try_divide(dsum(x, scale), F.nullif(F.count(x), F.lit(0)))
