"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mercato.session import scratch_path

# Rows per Arrow batch handed to Python: documents are kilobytes to megabytes
# each, so the default of 10,000 rows would be too much memory at once.
ARROW_ROWS = 1000


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of a text batch sent to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table under the shared checkpoint folder."""
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lineage cut that survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sample(df: DataFrame, rows: int, key: Column) -> DataFrame:
    """At most ``rows`` rows, those with the smallest values of ``key`` (a 64-bit hash).

    A cut-off that four times as many rows should pass is applied first, so
    what meets in one place does not grow with the number of tasks.
    """
    total = df.count()
    df = df.withColumn("__hash", key)
    if total > 8 * rows:
        df = df.filter(F.col("__hash") < -(1 << 63) + int((1 << 64) * (4 * rows / total)))
    return df.orderBy("__hash").limit(rows).drop("__hash")
