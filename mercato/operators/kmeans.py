"""K-Means with all restarts advanced together (ML-02, ML-03).

One job per iteration: every task holds the centres of all running
restarts (restarts x k points), assigns each of its rows once per restart
and hands on sums per (restart, cluster), so at most restarts x k short
rows per task are shuffled and that many meet on the driver, whatever the
number of rows.  A restart rests when its centres move by no more than
``tol``; the one of least cost then goes on until none of its centres
moves any more (a fixed point).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED_ROWS = 4096  # rows of the sample, chosen by hash, that the first centres come from
TOL = 1e-4        # squared shift of the centres, in standard units, at which a restart rests
ROUNDING = 12     # digits of a centre, so that the order of additions doesn't show


@dataclass(frozen=True)
class Model:
    centres: np.ndarray    # k x features, in standard units
    cost: float            # sum of squared distances to the nearest centre
    iterations: int
    converged: bool
    costs: tuple[float, ...]  # of every restart as it rested
    mean: dict[str, float]
    std: dict[str, float]


def standardised(df: DataFrame, features: list[str]) -> tuple[DataFrame, dict[str, float], dict[str, float]]:
    """ML-02: features less their mean, by their population deviation (a constant feature becomes 0)."""
    row = df.agg(*[F.struct(F.avg(f).alias("mean"), F.stddev_pop(f).alias("std")).alias(f) for f in features]).first()
    mean = {f: row[f]["mean"] or 0.0 for f in features}
    std = {f: row[f]["std"] or 1.0 for f in features}
    out = [((F.col(f) - F.lit(mean[f])) / F.lit(std[f])).alias(f) for f in features]
    return df.select(*[c for c in df.columns if c not in features], *out), mean, std


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every row the nearest centre (ties: the first) and its squared distance."""
    d = np.stack([np.einsum("ij,ij->i", x - c, x - c) for c in centres], 1)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


def _first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows, each drawn with the squared distance to those before as its weight."""
    rng = np.random.default_rng(seed)
    out = [sample[rng.integers(len(sample))]]
    for _ in range(k - 1):
        far = _nearest(sample, np.array(out))[1]
        out.append(sample[rng.choice(len(sample), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(sample))])
    return np.array(out)


def _sums(df: DataFrame, features: list[str], centres: dict[int, np.ndarray]) -> dict[tuple[int, int], tuple[np.ndarray, int, float]]:
    """(restart, cluster) -> sum of rows, number of rows, cost: one pass for all restarts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {r: [np.zeros_like(c), np.zeros(len(c), np.int64), np.zeros(len(c))] for r, c in centres.items()}
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy(zero_copy_only=False) for f in features])
            for r, c in centres.items():
                at, d = _nearest(x, c)
                total, n, cost = sums[r]
                for j in range(x.shape[1]):
                    total[:, j] += np.bincount(at, weights=x[:, j], minlength=len(c))
                n += np.bincount(at, minlength=len(c))
                cost += np.bincount(at, weights=d, minlength=len(c))
        rows = [(r, i, total[i].tolist(), int(n[i]), float(cost[i])) for r, (total, n, cost) in sums.items() for i in range(len(n))]
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                          pa.array(cols[2], pa.list_(pa.float64())), pa.array(cols[3], pa.int64()),
                                          pa.array(cols[4], pa.float64())], names=["restart", "cluster", "total", "n", "cost"])

    parts = df.select(*[F.col(f).cast("double").alias(f) for f in features]).mapInArrow(
        run, "restart int, cluster int, total array<double>, n long, cost double")
    added = parts.groupBy("restart", "cluster").agg(
        *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(len(features))], F.sum("n").alias("n"), F.sum("cost").alias("cost"))
    return {(row["restart"], row["cluster"]): (np.array([row[f"t{i}"] for i in range(len(features))]), row["n"], row["cost"])
            for row in added.take(sum(map(len, centres.values())))}


def _advanced(df: DataFrame, features: list[str], running: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, float, float]]:
    """One iteration of every restart: its new centres, the cost under the old ones, and the squared shift."""
    sums, out = _sums(df, features, running), {}
    for r, old in running.items():
        parts = [sums[r, i] for i in range(len(old))]
        new = np.array([old[i] if n == 0 else np.round(total / n, ROUNDING) for i, (total, n, _) in enumerate(parts)])
        out[r] = new, sum(cost for _, _, cost in parts), float(((new - old) ** 2).sum())
    return out


def fit(df: DataFrame, key: str, features: list[str], k: int = 5, seed: int = 42, restarts: int = 10, max_iter: int = 300,
        tol: float = TOL) -> Model:
    """The best of ``restarts`` fits of k centres to the standardised ``features``.

    ``df`` is read once per iteration: hand in a stored table.  An empty
    cluster keeps its centre.  Fewer rows than k leave some centres equal."""
    x, mean, std = standardised(df, features)
    sample = np.array([tuple(row) for row in x.orderBy(F.xxhash64(key), key).limit(SEED_ROWS).select(*features).toLocalIterator()], float)
    if not len(sample):
        raise ValueError("no rows to cluster")
    running = {r: _first_centres(sample, k, seed + r) for r in range(restarts)}
    resting: dict[int, tuple[np.ndarray, float]] = {}
    iteration = 0
    while running and iteration < max_iter:
        iteration += 1
        for r, (centres, cost, shift) in _advanced(x, features, running).items():
            running[r] = centres
            if shift <= tol or iteration == max_iter:
                resting[r] = running.pop(r), cost
    best = min(resting, key=lambda r: (round(resting[r][1], 6), r))
    centres, cost = resting[best]
    shift = 1.0
    while shift and iteration < 2 * max_iter:
        iteration += 1
        before = centres
        centres, cost, shift = _advanced(x, features, {best: before})[best]
    return Model(centres, cost, iteration, not shift, tuple(resting[r][1] for r in range(restarts)), mean, std)


def distances(df: DataFrame, model: Model, features: list[str]) -> DataFrame:
    """``df`` with the squared distance to every centre (``distance``), as column expressions."""
    unit = [(F.col(f).cast("double") - F.lit(model.mean[f])) / F.lit(model.std[f]) for f in features]
    square = [sum(((u - F.lit(float(c))) * (u - F.lit(float(c))) for u, c in zip(unit, centre)), F.lit(0.0)) for centre in model.centres]
    return df.withColumn("distance", F.array(*square))


def assign(df: DataFrame, model: Model, features: list[str], out: str = "segment_id") -> DataFrame:
    """``df`` with the number of the nearest centre (ties: the first)."""
    d = F.col("distance")
    return distances(df, model, features).withColumn(out, (F.array_position(d, F.array_min(d)) - 1).cast("int")).drop("distance")
