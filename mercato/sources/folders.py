"""Whole-folder moves of Parquet tables through the Hadoop file system (any store that Spark reaches)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mercato.session import scratch_path


def _fs(spark: SparkSession, *paths: str):
    make = spark._jvm.org.apache.hadoop.fs.Path
    out = [make(p) for p in paths]
    return out[0].getFileSystem(spark._jsc.hadoopConfiguration()), out


def exists(spark: SparkSession, path: str) -> bool:
    fs, (p,) = _fs(spark, path)
    return fs.exists(p)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, (p,) = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new folder under the shared checkpoint folder, for several readers."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that isn't taken yet."""
    fs, (a, b) = _fs(spark, source, target)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def drop(spark: SparkSession, path: str) -> None:
    fs, (p,) = _fs(spark, path)
    fs.delete(p, True)


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Rename a staged folder into place, the old one away and then out."""
    fs, (new, cur, old) = _fs(spark, staged, target, f"{target}__old")
    if not fs.exists(cur) and fs.exists(old):  # an earlier swap was cut short
        fs.rename(old, cur)
    fs.delete(old, True)
    if fs.exists(cur) and not fs.rename(cur, old):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, cur):
        raise OSError(f"cannot move {staged} to {target}")
    fs.delete(old, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; an existing one stays."""
    fs, (final, part) = _fs(spark, path, f"{path}.part")
    fs.mkdirs(final.getParent())
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.exists(final):
        fs.rename(part, final)
    fs.delete(part, False)


def get_text(spark: SparkSession, path: str) -> str:
    fs, (p,) = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, none if there is no folder."""
    fs, (p,) = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
