import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from edge import edge_texts

from mercato.llm import crf, quality as Q, toxicity as X
from mercato.llm.labels import without_copies


def test_marginals_are_those_of_the_enumerated_chain():
    rng = np.random.default_rng(0)
    n, e, starts, trans = 11, rng.normal(size=11) * 2, np.zeros(11, bool), rng.normal(size=(2, 2))
    starts[[0, 3, 4, 9]] = True
    z, p, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(e[t] * y[t] for t in range(n)) + sum(trans[y[t - 1], y[t]] for t in range(n) if not starts[t]))
        z, p = z + w, p + w * np.array(y)
        for t in range(n):
            if not starts[t]:
                pairs[y[t - 1], y[t]] += w
    got, expected_pairs = crf.marginals(e, starts, trans)
    assert np.allclose(got, p / z) and np.allclose(expected_pairs, pairs / z)
    assert len(crf.marginals(np.empty(0), np.empty(0, bool), trans)[0]) == 0


def test_fit_recovers_a_sticky_chain():
    rng = np.random.default_rng(1)
    y, x = [0], []
    for t in range(4000):
        y.append(y[-1] if rng.random() < 0.95 else 1 - y[-1])
    y = np.array(y)
    x = (y + rng.normal(size=len(y)) * 1.5)[:, None]
    starts = np.zeros(len(y), bool)
    starts[0] = True
    w, trans = crf.fit(lambda w: (x - 0.5) @ w, lambda r: (x - 0.5).T @ r, 1, y, starts, steps=100)
    p, _ = crf.marginals((x - 0.5) @ w, starts, trans)
    alone = ((x[:, 0] > 0.5) == y).mean()
    assert ((p > 0.5) == y).mean() > alone + 0.1 and trans[0, 0] > trans[0, 1]


def held(i, folds):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds


@pytest.fixture(scope="module")
def bigger(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_toxicity_on_held_out_rows(bigger):
    docs, labels = bigger
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = X.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.held_out == (held(r.doc_id, 3) == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    test = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(t == p for t, p in test) / len(test) > 0.95
    assert not any(p for t, p in test if not t)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        for s in r.spans:
            assert texts[r.doc_id][s.start:s.end].strip() == texts[r.doc_id][s.start:s.end] != ""


def test_quality_on_held_out_rows(bigger):
    docs, labels = bigger
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = Q.quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.held_out == (held(r.doc_id, 5) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    test = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(t == p for t, p in test) / len(test) > 0.95


@pytest.mark.parametrize("module", [X, Q])
def test_edges_and_missing_labels(spark, edges, labels, module):
    run = module.toxicity if module is X else module.quality
    rows = run(edges, labels).collect()  # no label of a usable row: every score is the same
    assert len(rows) == len(edge_texts()) and all(0 <= r.score <= 1 for r in rows)
    assert run(edges.limit(0), labels).collect() == []
    assert {r.score for r in run(edges, labels.limit(0)).collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(-60, 60)] + [(None, 1, 1), (1, None, None)],
                                 "doc_id long, quality int, toxic int")
    assert len(run(edges, some).collect()) == len(edge_texts())


def test_lines_of_any_text():
    texts = pa.array(["", "\n", "one line", "a\n\nb !! !!\n" * 3, "É" * 5 + " ÉÉ x|y | |", " " * 50], pa.large_string())
    x, size, upto = Q.line_features(texts)
    assert upto.tolist() == [0, 1, 3, 4, 14, 15, 16] and np.isfinite(x).all()
    for i, t in enumerate(texts.to_pylist()):
        assert size[upto[i]:upto[i + 1]].tolist() == [len(v.encode()) for v in t.split("\n")]
    assert x[14, 2] > 0.7  # capital letters beyond ASCII count as capitals


def test_copies_count_once():
    a, b = "some words that are copied all over the place again", "entirely different words stand here for once in a while"
    assert without_copies([a, a, b, a + " tail"], [1, 1, 0, 1]) == ([a, b], [1, 0])


def test_an_id_that_documents_repeat_brings_one_text(spark):
    from pyspark.sql import functions as F

    from mercato.llm.labels import labelled_sample
    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.union(spark.createDataFrame([(8, "another")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0)], "doc_id long, toxic int")
    a, b = (labelled_sample(docs.repartition(n), labels, "toxic", F.lit(True)) for n in (2, 5))
    assert a == b and len(a[0]) == 2 and sorted(a[1]) == [0, 1]
