"""Exact distinct counts by any slicer, from stored bitmaps (MEA-04, MEA-25).

A distinct count can't be summed over groups.  What is stored instead is,
for every combination of the slicers (``SLICERS``), the set of ids as
bitmaps: the id space is cut into buckets of 64 ids, and a group has one
bitmap (8 bytes) per bucket it touches.  A group holds few of the ids of a
stretch, as an order has one month, store and channel, so wider bitmaps
would be mostly zeros.  Any coarser count is an OR of bitmaps per bucket and
a sum of their bit counts: the order lines are not read again, partial ORs
run before the shuffle, and no group of rows has to meet in one task.  New
lines only add bitmaps: ``appended`` ORs them in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.sources.retail import Retail

SLICERS = ["sales_month", "region", "store_type", "channel", "category"]
IDS = {"nb_orders_distinct": "orders", "nb_clients": "customers"}


def sold(r: Retail) -> DataFrame:
    """Order lines with the slicers (JOI-01..03)."""
    stores = r.stores.select("store_id", "region", "store_type")
    return (r.with_orders(r.priced_lines.select("order_id", "category"), r.orders.drop("order_status"))
            .withColumn("sales_month", F.trunc("order_date", "MM")).join(stores, "store_id"))


def _packed(groups: DataFrame, by, bits: Column) -> DataFrame:
    """One bitmap per group and bucket: the OR of ``bits``, as 8 bytes."""
    g = groups.groupBy(*by, "bucket").agg(F.bit_or(bits).alias("bits"))
    return g.select(*by, "bucket", F.unhex(F.lpad(F.hex("bits"), 16, "0")).alias("ids"))


def _bits(ids: str = "ids") -> Column:
    """The bitmap of 8 bytes as an integer."""
    return F.conv(F.hex(ids), 16, -10).cast("bigint")


def bitmaps(lines: DataFrame, id_col: str, by=SLICERS, dealt=lambda df, *keys: df) -> DataFrame:
    """(slicers, bucket, ids): the distinct ids of every group, 64 ids to a bitmap.

    ``dealt`` may shuffle the lines by bucket; what it keeps together is
    summed there, and a stored file then holds whole buckets."""
    x = F.col(id_col).cast("bigint")
    lines = lines.where(x.isNotNull()).select(*by, F.shiftright(x, 6).alias("bucket"), F.expr(f"shiftleft(1L, CAST(CAST({id_col} AS BIGINT) & 63 AS INT))").alias("bit"))
    return _packed(dealt(lines, "bucket"), by, F.col("bit"))


def slicer_bitmaps(r: Retail) -> DataFrame:
    """Orders and customers of every slicer combination: (slicers, id_kind, bucket, ids).

    The two bitmaps of a line go through one aggregation, so lines are read once."""
    ids = F.explode(F.array(F.struct(F.lit("orders").alias("id_kind"), F.col("order_id").alias("id")),
                            F.struct(F.lit("customers").alias("id_kind"), F.col("customer_id").alias("id")))).alias("e")
    return bitmaps(sold(r).select(*SLICERS, ids).select(*SLICERS, "e.id_kind", "e.id"), "id", [*SLICERS, "id_kind"], r.dealt)


def rolled_up(stored: DataFrame, by=()) -> DataFrame:
    """Bitmaps of coarser groups: the ids of a group are those of its parts."""
    return _packed(stored, [*by, "id_kind"], _bits())


def appended(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored bitmaps with those of new lines; lines already counted change nothing."""
    return rolled_up(stored.unionByName(new), [c for c in stored.columns if c not in ("id_kind", "bucket", "ids")])


def distinct_counts(stored: DataFrame, by=(), where: Column | None = None) -> DataFrame:
    """MEA-04 (orders) and MEA-25 (customers), each counted once per group of ``by``, in the filter context ``where``."""
    x = stored if where is None else stored.where(where)
    n = lambda kind: F.sum(F.when(F.col("id_kind") == kind, F.bit_count("bits")))
    # counted as integers: no bitmap is packed that is only counted
    g = x.groupBy(*by, "id_kind", "bucket").agg(F.bit_or(_bits()).alias("bits"))
    aggs = [F.coalesce(n(kind), F.lit(0)).alias(name) for name, kind in IDS.items()]
    return g.groupBy(*by).agg(*aggs) if by else g.agg(*aggs)
