"""Exact quantiles from stored quantile sketches and one refining scan.

A mergeable sketch (KLL) of every measure is stored per key, say category
and month.  For any coarser group and any choice of keys the sketches are
merged, which gives a bracket of two values around the wanted rank; one
scan of the facts then counts the values below the bracket and, by value,
those inside it.  The counts say whether the bracket holds the rank: where
it doesn't (a sketch errs with small probability), that group is scanned
again without bracket, so the result is exact in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 2048        # size of a sketch: its rank error is about 0.15 %
MARGIN = 0.005  # half the width of a bracket, in rank


def sketches(df: DataFrame, keys: list[str], measures: list[str], k: int = K) -> DataFrame:
    """(keys, measure, n, sketch): one sketch of the non-null values of every measure and key."""
    aggs = [F.struct(F.lit(m).alias("measure"), F.count(m).alias("n"),
                     F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(k)).alias("sketch")).alias(m) for m in measures]
    one = df.groupBy(*keys).agg(*aggs)
    return one.select(*keys, F.explode(F.array(*measures)).alias("e")).select(*keys, "e.*").where(F.col("n") > 0)


def _group(by: list[str]) -> Column:
    """The group as one key; inside it NULL equals NULL."""
    return F.struct(F.lit(0).alias("_"), *by).alias("group")


def brackets(stored: DataFrame, by: list[str], q: float, margin: float = MARGIN, k: int = K) -> DataFrame:
    """(group, measure, n, low, high): values whose ranks lie ``margin`` below and above the quantile, from merged sketches."""
    ends = F.array(F.lit(max(0.0, q - margin)), F.lit(min(1.0, q + margin)))
    merged = stored.groupBy(_group(by), "measure").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    values = merged.withColumn("v", F.kll_sketch_get_quantile_double("sketch", ends))
    # at the ends of the distribution the bracket is open
    return values.select("group", "measure", "n",
                         (F.lit(None).cast("double") if q <= margin else F.col("v")[0]).alias("low"),
                         (F.lit(None).cast("double") if q >= 1 - margin else F.col("v")[1]).alias("high"))


def _refined(facts: DataFrame, bracketed: DataFrame, by: list[str], measures: list[str], q: float) -> DataFrame:
    """(group, measure, value, held): the quantile where the bracket holds it.  One scan of ``facts`` for all measures."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("x")) for m in measures]))
    x = facts.select(_group(by), values.alias("e")).select("group", "e.*").where(F.col("x").isNotNull())
    below, above = (F.coalesce(c, F.lit(False)) for c in (F.col("x") < F.col("low"), F.col("x") > F.col("high")))
    counted = (x.join(bracketed, ["group", "measure"]).where(~above)
               .groupBy("group", "measure", "n", F.when(~below, F.col("x")).alias("x")).agg(F.count(F.lit(1)).alias("c")))
    # the row without value counts what lies below, and sorts first
    upto = F.sum("c").over(Window.partitionBy("group", "measure").orderBy(F.asc_nulls_first("x"))
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = (F.col("n") - 1) * F.lit(float(q))
    at = lambda rank: F.min(F.when((F.col("upto") > rank) & F.col("x").isNotNull(), F.col("x")))
    picked = counted.withColumn("upto", upto).groupBy("group", "measure", "n").agg(
        at(F.floor(h)).alias("v_lo"), at(F.ceil(h)).alias("v_hi"),
        F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("c"))), F.lit(0)).alias("below"), F.max("upto").alias("last"))
    held = (F.col("below") <= F.floor(h)) & (F.col("last") > F.ceil(h))
    return picked.select("group", "measure", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (h - F.floor(h))).alias("value"), held.alias("held"))


def sketched_quantiles(facts: DataFrame, stored: DataFrame, by: list[str], names: dict[str, str], q: float,
                       where: Column | None = None, margin: float = MARGIN) -> DataFrame:
    """Exact q-quantile (linear interpolation) of every measure per group: (by, names).

    ``names`` maps measures to result columns; ``where`` may use the keys of
    the stored sketches only, as it selects facts and sketches alike.  Null
    values are left out, null keys are a group; a group without any value of
    a measure shows NULL, one without values of any measure has no row."""
    measures = list(names)
    if where is not None:
        facts, stored = facts.where(where), stored.where(where)
    bracketed = brackets(stored.where(F.col("measure").isin(*measures)), by, q, margin)
    # one row per group and measure, cut from the scan that made it
    result = _refined(facts, bracketed, by, measures, q).where("held").checkpoint(eager=True)
    missed = bracketed.join(result, ["group", "measure"], "left_anti")
    if not missed.isEmpty():
        whole = missed.withColumns({c: F.lit(None).cast("double") for c in ("low", "high")})
        result = result.unionByName(_refined(facts, whole, by, measures, q))
    return result.groupBy("group").agg(*[F.max(F.when(F.col("measure") == m, F.col("value"))).alias(out) for m, out in names.items()]) \
        .select(*[F.col("group")[c].alias(c) for c in by], *names.values())
