"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled (by a digest of the id); a document's
virtual finish time is the source's words up to and including it, divided
by the source's target.  Sources with less text than their target start
over, up to ``max_passes`` times.  All copies are ordered by finish time
over all sources and the order is truncated at the total budget.

Running totals are never a window over a whole source: rows are dealt to
buckets of the shuffle order, the bucket totals are added up per source,
and the window runs inside one (source, bucket).  The truncation works the
same way on the finish times: a range histogram finds the bin in which the
budget runs out, a second one splits that bin, and only the rows of the
last range are sorted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BINS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[int], max_passes: int) -> DataFrame:
    """(skey, source_size) -> target: the budget shared by weight, each source stopping at its cap.

    Sources are ranked by key; weights repeat along the ranks.  A source is
    capped when its cap per weight is below the level that the rest would
    share, so one pass in order of cap per weight settles every target.
    Only one row per source goes through this.
    """
    rank = F.row_number().over(Window.orderBy("skey")) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    w = (sizes.withColumn("weight", weight)
         .withColumn("cap", (F.col("source_size") * max_passes).cast("double"))
         .withColumn("full_at", F.col("cap") / F.col("weight")))
    every = Window.partitionBy()
    before = Window.orderBy("full_at", "skey").rowsBetween(Window.unboundedPreceding, -1)
    w = (w.withColumn("budget", F.sum("source_size").over(every))
         .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open_weight"))
         .withColumn("is_open", F.col("full_at") > F.col("level")))
    first_open = F.min(F.when(F.col("is_open"), F.struct("full_at", "level"))).over(every)
    w = w.withColumn("first_open", first_open)
    capped = F.col("first_open").isNull() | (F.col("full_at") < F.col("first_open.full_at"))
    return w.select("skey", "source_size",
                    F.when(capped, F.col("cap")).otherwise(F.col("first_open.level") * F.col("weight")).alias("target"))


def _running(rows: DataFrame) -> DataFrame:
    """Add ``upto``: words of the source up to and including the row in shuffle order."""
    rows = rows.withColumn("bucket", F.substring("shuffle", 1, 3))  # 4,096 ranges of the hex digest
    totals = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("skey", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    inside = (Window.partitionBy("skey", "bucket").orderBy("shuffle", "id", "size", "row")
              .rowsBetween(Window.unboundedPreceding, 0))
    return (rows.withColumn("here", F.sum("size").over(inside)).join(totals, ["skey", "bucket"])
            .withColumn("upto", F.col("here") + F.col("before")).drop("here", "before", "bucket"))


def _finishes(max_passes: int) -> Column:
    """Finish times of a document's copies, one per pass; none for an empty document."""
    times = [(F.col("source_size") * p + F.col("upto")) / F.col("target") for p in range(max_passes)]
    return F.when((F.col("size") > 0) & (F.col("target") > 0), F.array(*times)).otherwise(
        F.array().cast("array<double>"))


def _bin(finish: Column, low: float, step: float) -> Column:
    at = F.floor((finish - F.lit(low)) / F.lit(step))
    return F.least(F.greatest(at, F.lit(0)), F.lit(BINS - 1))


def _cut(docs: DataFrame, budget: int) -> tuple[list[tuple[float, float, int]], DataFrame | None]:
    """Where the order of finish times is truncated at the budget.

    Returns nested ranges [(low, step, bin)]: copies in a bin before the
    last one of a level are all taken; and of the last bin the copies that
    still fit, by (row, copy), or None when everything fits.
    """
    copies = docs.select("row", "skey", "shuffle", "id", "size", F.posexplode("finishes").alias("copy", "finish"))
    top = copies.agg(F.max("finish")).first()[0]
    levels, taken, low, width = [], 0, 0.0, top
    for _ in range(2):
        if not width:
            break
        step = width / BINS
        at = _bin(F.col("finish"), low, step)
        sums = {r["bin"]: r["words"] for r in  # at most BINS rows, whatever the data
                copies.groupBy(at.alias("bin")).agg(F.sum("size").alias("words")).collect()}
        edge = next((k for k in range(BINS) if (taken := taken + sums.get(k, 0)) > budget), None)
        if edge is None:
            return [(low, step, BINS)], None
        taken -= sums[edge]
        levels.append((low, step, edge))
        copies = copies.filter(at == edge)
        low, width = low + edge * step, step
    order = (Window.orderBy("finish", "skey", "shuffle", "id", "size", "copy", "row")
             .rowsBetween(Window.unboundedPreceding, 0))
    last = copies.withColumn("sofar", F.sum("size").over(order))
    return levels, last.filter(F.col("sofar") <= budget - taken).select("row", "copy")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, max_passes: int = 3, seed: str = "mix",
        carry: Sequence[str] = ()) -> DataFrame:
    """Decide how many copies of each document the mix takes.

    Returns one row per input row: id, source, size (words), source_size,
    target, copies, taken (= copies x size), finish_times.  A null text is
    empty; empty documents have size 0 and are never taken.  A null source
    is a source of its own, ranked last.  Null ids are shuffled like an empty
    id; repeated rows are separate documents.  The total taken is the budget
    (all words of the input) less the part of one copy that no longer fits.
    Reruns take the same rows: the shuffle order is a digest of seed and id.
    An empty table gives an empty result; columns named in ``carry`` are
    carried along and others ignored.
    """
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    source = F.col(source_col).cast("string")
    sized = written(docs.select(
        F.col(id_col).alias("id"), F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("skey"),
        F.md5(key).alias("shuffle"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.struct(*[F.col(c) for c in carry] or [F.lit(0)]).alias("carried"))
        .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    targets = written(source_targets(sized.groupBy("skey").agg(F.sum("size").alias("source_size")),
                                     weights, max_passes), "mix-targets")
    timed = written(_running(sized).join(targets, "skey").withColumn("finishes", _finishes(max_passes)), "mix-times")
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    levels, edge = _cut(timed, budget)

    def in_full(f: Column) -> Column:
        inside, earlier = F.lit(True), F.lit(False)
        for low, step, bin_ in levels:
            at = _bin(f, low, step)
            earlier, inside = earlier | (inside & (at < bin_)), inside & (at == bin_)
        return earlier

    copies = F.size(F.filter("finishes", in_full))
    if edge is not None:
        timed = timed.join(edge.groupBy("row").agg(F.count(F.lit(1)).alias("extra")), "row", "left")
        copies = copies + F.coalesce(F.col("extra"), F.lit(0))
    out = timed.withColumn("copies", copies.cast("long"))
    return out.select(F.col("id").alias(id_col), *[F.col("carried")[c].alias(c) for c in carry],
                      F.when(F.col("skey") != "1", F.substring("skey", 2, 1 << 30)).alias(source_col),
                      "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
                      F.slice("finishes", F.lit(1), F.col("copies").cast("int")).alias("finish_times"))


def mixed(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", finish_col: str = "finish") -> DataFrame:
    """The mixed stream: ``docs`` with each document as often as taken, range-sorted by finish time.

    Ids must be unique and not null here (decisions are matched by id).
    """
    taken = decisions.select(F.col(id_col).alias("__id"), F.explode("finish_times").alias(finish_col))
    return docs.join(taken, F.col(id_col) == F.col("__id")).drop("__id").orderBy(finish_col, id_col)
