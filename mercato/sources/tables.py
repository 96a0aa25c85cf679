"""Catalog tables: scan with fallback (SRC-07/08), overwrite rules (SRC-10/11)."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str, fallback_dir: str | None = None) -> DataFrame | None:
    """SRC-07/08: catalog table if it exists, else <fallback_dir>/<name>.parquet,
    else None (no bare except: only a missing table falls back)."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if fallback_dir:
        path = os.path.join(fallback_dir, f"{name}.parquet") if "://" not in fallback_dir \
            else f"{fallback_dir.rstrip('/')}/{name}.parquet"
        try:
            return spark.read.parquet(path)
        except Exception as e:  # noqa: BLE001 - only "path does not exist" is expected
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                return None
            raise
    return None


def overwrite_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """SRC-10: replace a Parquet catalog table wholesale, even when ``df``
    reads that same table.  The result is written to a staging table first;
    the old table is renamed away, the new one renamed in, and only then is
    the old one dropped, so a crash leaves a complete copy under one of the
    three names (``recover_table`` puts it back)."""
    spark = df.sparkSession
    recover_table(spark, name)
    stage, old = f"{name}__stage_{uuid.uuid4().hex[:8]}", f"{name}__old"
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(stage)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def recover_table(spark: SparkSession, name: str) -> None:
    """After a crash inside ``overwrite_table``: restore the old table if the new one never came in, else drop it."""
    old = f"{name}__old"
    if spark.catalog.tableExists(old):
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")


def insert_overwrite(df: DataFrame, name: str) -> None:
    """SRC-11: overwrite contents but keep the table (and its grants).
    insertInto is positional, so columns are first put in the target's order."""
    target_cols = df.sparkSession.table(name).columns
    df.select(*[F.col(c) for c in target_cols]).write.insertInto(name, overwrite=True)


def append_idempotent(df: DataFrame, name: str, keys: list[str], partition_col: str,
                      order_col: str | None = None) -> None:
    """SRC-09: rerunnable append: rows whose keys (nulls equal each other) are
    in the table replace the stored ones, wherever those are, so a rerun
    duplicates nothing and a key that moves leaves its old partition.  Of
    several rows of one key the largest ``order_col``, then the largest whole
    row, stays.  Rewritten are the partitions of the batch and those in which
    its keys are stored (dynamic partition overwrite from a staging table,
    dropped in any case); partitions that become empty are dropped last, so
    a run cut short is mended by a rerun."""
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in keys]
    first = [order_col] if order_col else []
    pick = F.max(F.struct(*first, *[F.col(c).alias(f"v_{c}") for c in rest])).alias("row")
    batch = df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"row.v_{c}").alias(c) for c in rest])
    if not spark.catalog.tableExists(name):
        batch.write.format("parquet").partitionBy(partition_col).saveAsTable(name)
        return
    existing = spark.table(name)
    part = F.col(partition_col)
    null_safe = lambda left, right, cols: reduce(
        lambda x, y: x & y, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols])
    a, b = existing.alias("a"), batch.select(*keys).alias("b")
    stored = a.join(b, null_safe("a", "b", keys), "left_semi").select(part)
    stage, touched = (f"{name}__{x}_{uuid.uuid4().hex[:8]}" for x in ("merge", "touched"))
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        # one row per partition of the batch or of its keys, with whether the table has it
        (stored.withColumn("old", F.lit(True)).unionByName(batch.select(part, F.lit(False).alias("old")))
         .groupBy(partition_col).agg(F.bool_or("old").alias("old")).write.format("parquet").saveAsTable(touched))
        keep = (a.join(b, null_safe("a", "b", keys), "left_anti")
                .alias("a").join(spark.table(touched).alias("t"), null_safe("a", "t", [partition_col]), "left_semi"))
        keep.unionByName(batch.select(*existing.columns)).write.format("parquet").partitionBy(partition_col).saveAsTable(stage)
        spark.table(stage).select(*existing.columns).write.insertInto(name, overwrite=True)
        emptied = (spark.table(touched).where("old").alias("t")
                   .join(spark.table(stage).select(partition_col).distinct().alias("s"), null_safe("t", "s", [partition_col]), "left_anti"))
        for row in emptied.select(part.cast("string")).toLocalIterator():
            value = "null" if row[0] is None else "'" + row[0].replace("\\", "\\\\").replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition_col} = {value})")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
        spark.sql(f"DROP TABLE IF EXISTS {touched}")
