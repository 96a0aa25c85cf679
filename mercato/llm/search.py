"""Exact top-k inner-product search by a dual walk of cover trees.

The top of the tree is a bounded set of pivot vectors: every vector belongs
to the cell of its nearest pivot, and a cell's covering radius is the
largest distance in it.  The queries of a cell are one query node.  Pairs
of query node and cell that cannot reach the worst k-th score (known from
the pivots, which are vectors of the table) are dropped before anything
moves, then pairs of single query and cell.  What is left is dealt to
blocks of a cell, and inside a block both sides are indexed by cover trees
and walked together.  Large cells, as those of a vector that is repeated
very often, are dealt to many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.llm.common import hash_sample, written
from mercato.llm.cover_tree import search

SCALE = 256
CELL_ROWS = 2048      # vectors a cell should have
MOST_PIVOTS = 4096    # pivots, whatever the data: they are broadcast
BLOCK_ROWS = 8192     # vectors of a block
QUERY_ROWS = 65536    # queries that meet a block in one task
PIVOT_ROWS = 1024     # vectors compared with all pivots at a time


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, v, dim) of the vectors that take part: no null, no component null or non-finite.

    A component that is no long after scaling raises an error, as its scores are none either."""
    x = lambda c: c.cast("double")
    fine = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < float("inf")))
    scaled = F.transform(vector_col, lambda c: F.when(F.abs(x(c)) < 2.0 ** 54, F.floor(SCALE * x(c)))
                         .otherwise(F.raise_error(F.lit("a vector component is too large for scores of 64 bits")).cast("long")))
    return (vectors.filter(F.col(vector_col).isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), scaled.cast("array<long>").alias("v"))
            .withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("v")))


def _matrix(v: pa.Array, dim: int) -> np.ndarray:
    flat = v.flatten() if isinstance(v, (pa.ListArray, pa.LargeListArray)) else v
    return np.asarray(flat).reshape(len(v), dim).astype(np.int64)


class Pivots:
    """Pivot vectors of every dimension, with their ids and rows."""

    def __init__(self, rows: list) -> None:
        self.by_dim = {}
        for d in sorted({len(r["v"]) for r in rows}):
            mine = [r for r in rows if len(r["v"]) == d]
            v = np.array([r["v"] for r in mine], np.int64).reshape(len(mine), d)
            self.by_dim[d] = (v, np.array([r["row"] for r in mine], np.int64))

    def cells(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each vector and the distance; without pivots one cell around zero."""
        p = self.centres(v.shape[1]).astype(float)
        x = v.astype(float)
        d = (x * x).sum(axis=1)[:, None] - 2 * x @ p.T + (p * p).sum(axis=1)
        cell = d.argmin(axis=1)
        return cell, np.sqrt(((x - p[cell]) ** 2).sum(axis=1))

    def centres(self, dim: int) -> np.ndarray:
        return self.by_dim[dim][0] if dim in self.by_dim else np.zeros((1, dim), np.int64)

    def floors(self, v: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
        """A score that each query's k-th best reaches: its k-th best among the pivots but itself."""
        if v.shape[1] not in self.by_dim or len(self.by_dim[v.shape[1]][0]) <= k:
            return np.full(len(v), -np.inf)
        p, rows = self.by_dim[v.shape[1]]
        x, y = v.astype(float), p.astype(float)
        s = x @ y.T
        s[own[:, None] == rows] = -np.inf
        worst = np.partition(s, -k, axis=1)[:, -k]
        # below the exact score, whatever the rounding of the sums
        return worst - 1e-9 * np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1).max()) - 1e-6


def _by_dim(batch: pa.RecordBatch):
    dims = np.asarray(batch.column("dim"))
    for d in np.unique(dims).tolist():
        part = batch.filter(pa.array(dims == d))
        for at in range(0, part.num_rows, PIVOT_ROWS):
            yield d, part.slice(at, PIVOT_ROWS)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """The k rows of largest inner product for each query row, exactly.

    Components are floor(256 x); a query's own row is no candidate, rows of
    equal id are.  Vectors that are null or hold a null or non-finite
    component take no part, and vectors of different length are
    not compared.  Vectors of any size are scored exactly; a component or a
    score in the result that is no 64-bit integer raises an error.  Returns query_id, rank (from 1), vec_id, score; ties go to
    the smaller id (a null id is larger than any), and a query with fewer
    than k candidates has them all.  An empty table gives an empty result.
    """
    no_id = (1 << 63) - 1  # stands for a null id among candidates
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS))
    vecs = written(integer_vectors(vectors, id_col, vector_col), "vectors")
    # 32 bits a component where the whole table fits
    kind = "int" if vecs.filter(F.exists("v", lambda c: F.abs(c) >= 2 ** 31)).isEmpty() else "long"
    vecs = vecs.withColumn("v", F.col("v").cast(f"array<{kind}>"))
    n = vecs.count()
    wanted = min(MOST_PIVOTS, max(16, n // CELL_ROWS))
    pivots = Pivots(hash_sample(vecs, wanted, F.xxhash64("row")).select("row", "v").collect())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, part in _by_dim(b):
                cell, far = pivots.cells(_matrix(part.column("v"), d))
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), part.column("dim"),
                                                  pa.array(cell.astype(np.int32)), pa.array(far), part.column("v")],
                                                 names=["row", "id", "dim", "cell", "far", "v"])

    cells = written(vecs.select("row", "id", "dim", "v").mapInArrow(
        assign, f"row long, id long, dim int, cell int, far double, v array<{kind}>"), "cells")
    queries = cells.withColumnRenamed("id", id_col).filter(is_query).withColumnRenamed(id_col, "id")
    # one row per cell: at most MOST_PIVOTS, and one for each further dimension
    stats = {(r["dim"], r["cell"]): (r["n"], r["radius"]) for r in
             cells.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect()}
    chunks = max(1, -(-queries.count() // QUERY_ROWS))
    blocks = {key: -(-count // BLOCK_ROWS) for key, (count, _) in stats.items()}

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with the cells that can hold one of its best k."""
        for b in batches:
            for d, part in _by_dim(b):
                v, own = _matrix(part.column("v"), d), np.asarray(part.column("row"))
                here, far = np.asarray(part.column("cell")), np.asarray(part.column("far"))
                known = sorted(c for dim, c in stats if dim == d)
                centre = pivots.centres(d)
                r = np.array([stats[d, c][1] for c in known])
                pf = centre[known].astype(float)
                pn = np.sqrt((pf * pf).sum(axis=1))
                floors = pivots.floors(v, own, k)
                for node in np.unique(here).tolist():
                    mine = np.flatnonzero(here == node)
                    c, radius = centre[node].astype(float), far[mine].max()
                    most = pf @ c + radius * pn + r * np.sqrt(c @ c) + radius * r
                    left = np.flatnonzero(most + 1e-9 * np.abs(most) + 1e-6 >= floors[mine].min())
                    x = v[mine].astype(float)
                    most = x @ pf[left].T + np.sqrt((x * x).sum(axis=1))[:, None] * r[left]
                    q, at = np.nonzero(most + 1e-9 * np.abs(most) + 1e-6 >= floors[mine][:, None])
                    rows = [(int(i), known[left[j]], s) for i, j in zip(mine[q], at) for s in range(blocks[d, known[left[j]]])]
                    for lo in range(0, len(rows), BLOCK_ROWS):
                        some = rows[lo:lo + BLOCK_ROWS]
                        take = pa.array([i for i, _, _ in some], pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [part.column("row").take(take), part.column("id").take(take), part.column("dim").take(take),
                             pa.array([c for _, c, _ in some], pa.int32()), pa.array([s for _, _, s in some], pa.int32()),
                             pa.array(floors[[i for i, _, _ in some]]), part.column("v").take(take)],
                            names=["row", "id", "dim", "cell", "block", "floor", "v"])

    asked = written(queries.select("row", "id", "dim", "cell", "far", "v").mapInArrow(
        reach, f"row long, id long, dim int, cell int, block int, floor double, v array<{kind}>").withColumn(
        "chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")), "asked")
    counts = spark.createDataFrame([(d, c, b) for (d, c), b in blocks.items()], "dim int, cell int, blocks int")
    # a block goes to the chunks of queries that reach it, and nowhere else
    met = asked.select(*[F.col(c).alias(c) for c in ("dim", "cell", "block", "chunk")]).distinct()
    data = (cells.select("row", "id", "dim", "cell", "v").join(F.broadcast(counts), ["dim", "cell"])
            .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
            .join(met, ["dim", "cell", "block"]).select("row", "id", "dim", "cell", "block", "chunk", "v"))

    def walk(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        d = key[0].as_py()
        a, b = left.combine_chunks(), right.combine_chunks()
        found = []
        if len(a) and len(b):
            column = lambda t, c: t.column(c).chunk(0)
            ids = np.asarray(column(a, "id").fill_null(no_id))
            best = search(_matrix(column(b, "v"), d), np.asarray(column(b, "row")), _matrix(column(a, "v"), d), ids,
                          np.asarray(column(a, "row")), np.asarray(column(b, "floor")), k)
            found = [(q, i, c, r, -s) for q, i, rows in zip(column(b, "row").to_pylist(), column(b, "id").to_pylist(), best)
                     for s, c, r in rows]
        cols = list(zip(*found)) if found else [()] * 5
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(["query_row", "query_id", "vec_id", "row", "score"], cols)})

    by = ["dim", "cell", "block", "chunk"]
    found = data.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(
        walk, "query_row long, query_id long, vec_id long, row long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("vec_id") != no_id, F.col("vec_id")).alias("vec_id"), "score"))
