import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import search as S
from mercato.llm.cover_tree import build, search


def brute(rows, k):
    """(id, vector) -> sorted (query id, rank, id, score) per query row."""
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (qi, q) in enumerate(ok):
        if qi is None or qi % 50:
            continue
        best = sorted((-sum(x * y for x, y in zip(q, v)), i is None, i or 0) for b, (i, v) in enumerate(ok)
                      if b != a and len(v) == len(q))[:k]
        out += [(qi, r, None if no else i, -s) for r, (s, no, i) in enumerate(best, 1)]
    return sorted(out, key=str)


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, row int").repartition(3)
    got = S.top_k(df, F.col("vec_id") % 50 == 0, k).collect()
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=str)


@pytest.mark.parametrize("cell_rows, block_rows", [(2048, 8192), (16, 32)])
def test_edges(spark, monkeypatch, cell_rows, block_rows):
    monkeypatch.setattr(S, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(S, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in np.float32(centres[i % 6] + 0.1 * rng.normal(size=8))]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 420)]           # a vector that is very common
    rows += [(150, rows[3][1]), (150, rows[3][1]), (None, rows[5][1]), (-50, rows[8][1])]
    rows += [(500, None), (550, []), (600, [1.0, None]), (650, [float("nan")] * 8), (700, [float("inf")] * 8),
             (750, [1.0, 2.0]), (751, [0.5, -0.25]), (800, [0.0] * 8)]
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows) == brute(rows, 5)


def test_empty_and_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]


def test_cover_tree_invariants_and_search():
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(20, 6))[rng.integers(0, 20, 1500)] * 300 + rng.normal(size=(1500, 6)) * 9).round()
    root = build(x)
    todo, inner = [root], 0
    while todo:
        node = todo.pop()
        assert np.linalg.norm(x[node.rows] - x[node.centre], axis=1).max() <= node.radius + 1e-6  # covering
        if node.children:
            inner += 1
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            assert node.centre in [c.centre for c in node.children]  # nesting
            assert all(c.radius <= node.radius / 2 + 1e-6 for c in node.children)
            todo += node.children
    assert inner > 1
    q, ids = x[:40].astype(np.int64), np.arange(1500)
    got = search(q, np.arange(40), x.astype(np.int64), ids, ids, np.full(40, -np.inf), 5)
    scores = q @ x.astype(np.int64).T
    for i in range(40):
        assert got[i] == sorted((-int(scores[i, j]), j, j) for j in range(1500) if j != i)[:5]


def test_wide_integers_are_exact():
    q = np.array([[2 ** 27, 1]], np.int64)
    p = np.array([[2 ** 27, 1], [2 ** 27, 2], [2 ** 27, 0]], np.int64)
    best = search(q, np.array([-1]), p, np.arange(3), np.arange(3), np.array([-np.inf]), 3)[0]
    assert [b[1] for b in best] == [1, 0, 2]


def test_wide_vectors_take_part(spark):
    """One component of 2^20 and more: the best match, not a left-out one."""
    assert run(spark, [(0, [1.0, 1.0]), (1, [2.0, 1.0]), (2, [float(2 ** 20), 1.0])]) == [
        (0, 1, 2, 256 * 256 * (2 ** 20 + 1)), (0, 2, 1, 256 * 256 * 3)]
    rng = np.random.default_rng(4)
    size = 10.0 ** rng.uniform(-2, 7, 400)  # scores beyond the integers of a double
    rows = [(i, [float(np.float32(x)) for x in s * rng.normal(size=4)]) for i, s in enumerate(size)]
    assert run(spark, rows) == brute(rows, 5)


def test_scores_beyond_64_bits(spark):
    # products of 2^80 that don't reach a result are no error
    rows = [(0, [2.0 ** 32, 1.0]), (1, [-(2.0 ** 32), 0.0])] + [(i, [1.0, float(i)]) for i in range(2, 9)]
    assert run(spark, rows) == brute(rows, 5)
    with pytest.raises(Exception):
        run(spark, [(0, [2.0 ** 32]), (1, [2.0 ** 32])])
    with pytest.raises(Exception, match="too large"):
        run(spark, [(0, [2.0 ** 60]), (1, [1.0])])


@pytest.mark.parametrize("query_rows", [1, 3])
def test_chunks_of_queries(spark, monkeypatch, query_rows):
    monkeypatch.setattr(S, "QUERY_ROWS", query_rows)
    monkeypatch.setattr(S, "CELL_ROWS", 16)
    monkeypatch.setattr(S, "PIVOT_ROWS", 7)
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(0, 700, 5)]
    assert run(spark, rows) == brute(rows, 5)
