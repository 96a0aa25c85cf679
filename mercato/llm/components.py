"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercato.llm.common import written


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest node around it."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    around = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return around.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (u, v) of long ids -> (node, root): the smallest node of the component, for every node but roots.

    Loops and repeated links do no harm.  Every round is written to the
    shared folder; the rounds end when a pair of stars changes nothing.
    """
    e = written(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "links")
    before = _fingerprint(e)
    while before[0]:
        # a forest of stars is final: one root for each node, and no root below another
        if e.groupBy("u").count().filter("count > 1").isEmpty() and e.join(
                e.select(F.col("u").alias("x")), F.col("v") == F.col("x"), "left_semi").isEmpty():
            break
        e = written(_small_star(_large_star(e)), "links")
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
