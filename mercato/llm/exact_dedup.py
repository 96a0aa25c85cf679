"""Exact dedup by content-defined chunk recipes.

A rolling gear hash cuts each text into chunks at positions that depend on
the content alone.  Chunks are deduplicated by content and named by a
64-bit identifier; a job over the distinct chunks verifies that no two
different chunks share a name (if two do, every name is lengthened by
another seeded hash and verified again).  With verified names, two texts
are equal exactly when their ordered lists of chunk names (recipes) are
equal, so the grouping and the join that follow move recipes, about one
name per kilobyte, and never the documents.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from mercato.llm.common import arrow_batches, text_of, written

WINDOW = 32      # bytes the 32-bit gear hash depends on
SLAB = 4 << 20   # bytes hashed at a time


def _gear() -> np.ndarray:
    """256 well-mixed 32-bit words (a splitmix finaliser over 1..256)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def cut_candidates(data: np.ndarray, bits: int) -> np.ndarray:
    """Ends of possible chunks: positions whose rolling hash has ``bits`` leading zeros."""
    found = []
    for at in range(0, len(data), SLAB):
        lead = min(at, WINDOW - 1)
        h = GEAR[data[at - lead:at + SLAB]]
        for s in (1, 2, 4, 8, 16):  # h[i] = sum of GEAR[b[i-k]] << k for k < 32
            g = h.copy()
            g[s:] += h[:-s] << np.uint32(s)
            h = g
        found.append(np.flatnonzero(h[lead:] >> np.uint32(32 - bits) == 0) + at + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def cut(offsets: np.ndarray, candidates: list[int], smallest: int, largest: int) -> tuple[list[int], list[int]]:
    """Chunk ends over all texts, and for each text the number of chunks up to its end."""
    ends, upto, k = [], [0], 0
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        while start < end:
            k = bisect_left(candidates, start + smallest, k)
            nxt = candidates[k] if k < len(candidates) else end
            start = min(nxt, end, start + largest)
            ends.append(start)
        upto.append(len(ends))
    return ends, upto


def chunked(docs: DataFrame, bits: int = 10, smallest: int = 256, largest: int = 16384) -> DataFrame:
    """(id, text) -> (id, sha256, chunks array<binary>); the chunks concatenate to the text."""
    if not WINDOW <= smallest <= largest:
        raise ValueError("the smallest chunk must hold the hash window")
    arrow_batches(docs.sparkSession)
    schema = T.StructType([docs.schema["id"], T.StructField("sha256", T.StringType()),
                           T.StructField("chunks", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text").cast(pa.large_binary())
            _, off, data = text.buffers()
            offsets = np.frombuffer(off, np.int64)[text.offset:text.offset + len(text) + 1]
            base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
            raw = np.frombuffer(data, np.uint8)[base:base + size] if size else np.empty(0, np.uint8)
            ends, upto = cut(offsets - base, cut_candidates(raw, bits).tolist(), smallest, largest)
            pieces = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.array([0, *ends], np.int32)),
                                                                    pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("sha256"), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pieces)],
                names=["id", "sha256", "chunks"])

    return docs.select("id", F.sha2(F.col("text"), 256).alias("sha256"), "text").mapInArrow(run, schema)


def seeded_hash(chunk: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), chunk)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column, int], Column] = seeded_hash, bits: int = 10) -> DataFrame:
    """Group rows of equal text; of each group the row with the largest id stays.

    Returns one row per input row: id, keep_id, group_size, kept, text_sha256
    (of the UTF-8 text).  A null text counts as empty; all empty texts are
    one group.  A null id is smaller than any other.  Of repeated rows (same
    text, same largest id) exactly one is kept.  An empty table gives an
    empty result.  Other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    parts = chunked(base, bits)

    def name(chunk: Column, seeds: int) -> Column:
        return F.array(*[digest(chunk, s) for s in range(seeds)]) if seeds > 1 else digest(chunk, 0)

    distinct, seeds = parts.select(F.explode("chunks").alias("chunk")), 1
    while not (distinct.select(name(F.col("chunk"), seeds).alias("name"), "chunk").distinct()
               .groupBy("name").count().filter("count > 1").isEmpty()):
        seeds += 1
    recipes = written(parts.select("id", "sha256", F.transform("chunks", lambda c: name(c, seeds)).alias("recipe"))
                      .withColumn("row", F.monotonically_increasing_id()), "recipes")
    # written, so that the join below reads two plain shuffles and a hot recipe's rows can be split
    groups = written(recipes.groupBy("recipe").agg(F.max(F.struct("id", "row")).alias("stays"),
                                                   F.count(F.lit(1)).alias("group_size")), "groups")
    return recipes.join(groups, "recipe").select(
        F.col("id").alias(id_col), F.col("stays.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), F.col("sha256").alias("text_sha256"))
