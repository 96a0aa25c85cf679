import hashlib
from collections import defaultdict

import numpy as np
import pytest
from edge import edge_texts
from pyspark.sql import functions as F

from mercato.llm import exact_dedup as D


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return groups


@pytest.mark.parametrize("digest", [D.seeded_hash, lambda c, s: F.pmod(F.xxhash64(F.lit(s), c), F.lit(5))])
def test_edges_whatever_the_hash(edges, digest):
    """A hash of five values collides all the time; verified names still tell all texts apart."""
    rows = D.exact_dedup(edges, digest=digest).collect()
    groups = expected([t[:2] for t in edge_texts()])
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(rows) == len(edge_texts())
    for sha, ids in by_sha.items():
        mine = [r for r in rows if r.text_sha256 == sha]
        assert len(mine) == len(ids) == mine[0].group_size
        assert sum(r.kept for r in mine) == 1
        best = max((i for i in ids if i is not None), default=None)
        assert {r.keep_id for r in mine} == {best}
        assert all(r.doc_id == best for r in mine if r.kept)


def test_empty_table(edges):
    assert D.exact_dedup(edges.limit(0)).collect() == []


def test_chunks_join_to_the_text_and_cuts_depend_on_content(spark, edges):
    base = edges.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    for r in D.chunked(base).join(base.select("id", "text"), "id").collect():
        assert b"".join(r.chunks) == r.text.encode()
        assert all(len(c) >= 256 for c in r.chunks[:-1]) and all(len(c) <= 16384 for c in r.chunks)
    text = next(t[1] for t in edge_texts() if t[0] == 6)
    two = spark.createDataFrame([(1, text), (2, "something in front " + text)], "id long, text string")
    a, b = (set(r.chunks) for r in D.chunked(two).orderBy("id").collect())
    assert len(a & b) >= len(a) - 2  # the shift changes the first chunks only


def test_candidates_across_slabs(monkeypatch):
    data = np.random.default_rng(0).integers(0, 256, 10000).astype(np.uint8)
    whole = D.cut_candidates(data, 6)
    monkeypatch.setattr(D, "SLAB", 777)
    assert (D.cut_candidates(data, 6) == whole).all() and len(whole) > 50
