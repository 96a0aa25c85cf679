"""K-Means: all restarts in one job per iteration."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import kmeans as K


def _blobs(spark, seed=5, n=600, k=4):
    rng = np.random.default_rng(seed)
    centre = rng.uniform(-20, 20, (k, 2))
    x = np.vstack([rng.normal(c, 1.0, (n // k, 2)) for c in centre])
    rows = [(i, float(a), float(b * 1000)) for i, (a, b) in enumerate(x)]  # features on different scales
    return spark.createDataFrame(rows, "id long, a double, b double").repartition(5).checkpoint(), np.array([r[1:] for r in rows])


def _lloyd(x, centres):
    """Plain iteration of one restart."""
    while True:
        at = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        new = np.array([x[at == i].mean(0) if (at == i).any() else centres[i] for i in range(len(centres))])
        if np.allclose(new, centres, atol=1e-11):
            return new, ((x - centres[at]) ** 2).sum()
        centres = new


def test_every_restart_ends_where_it_would_alone(spark):
    df, x = _blobs(spark)
    model = K.fit(df, "id", ["a", "b"], k=4, restarts=6, tol=0.0)
    z = (x - x.mean(0)) / x.std(0)
    sample = np.array([tuple(r) for r in K.standardised(df, ["a", "b"])[0].orderBy(F.xxhash64("id"), "id").select("a", "b").collect()])
    want = [_lloyd(z, K._first_centres(sample, 4, 42 + r)) for r in range(6)]
    assert model.costs == pytest.approx([c for _, c in want], rel=1e-9)
    assert model.cost == pytest.approx(min(model.costs)) and model.converged
    best = min(want, key=lambda w: w[1])[0]
    assert np.allclose(sorted(map(tuple, model.centres)), sorted(map(tuple, best)), atol=1e-8)


def test_assignment_is_the_nearest_centre(spark):
    df, x = _blobs(spark)
    model = K.fit(df, "id", ["a", "b"], k=4, restarts=2)
    got = {r.id: r.segment_id for r in K.assign(df, model, ["a", "b"]).collect()}
    z = (x - x.mean(0)) / x.std(0)
    want = ((z[:, None] - model.centres[None]) ** 2).sum(-1).argmin(1)
    assert [got[i] for i in range(len(x))] == want.tolist()


def test_one_job_per_iteration_for_all_restarts(spark, monkeypatch):
    df, _ = _blobs(spark)
    passes, one_pass = [], K._sums
    monkeypatch.setattr(K, "_sums", lambda d, f, centres: (passes.append(len(centres)), one_pass(d, f, centres))[1])
    model = K.fit(df, "id", ["a", "b"], k=4, restarts=10)
    assert passes[0] == 10 and passes[-1] == 1 and passes == sorted(passes, reverse=True)  # restarts leave as they rest
    assert len(passes) == model.iterations < 60


def test_layout_of_partitions_changes_nothing(spark):
    df, _ = _blobs(spark)
    a, b = (K.fit(df.repartition(n), "id", ["a", "b"], k=4, restarts=3) for n in (1, 7))
    assert np.allclose(a.centres, b.centres, atol=1e-9) and a.cost == pytest.approx(b.cost)


def test_few_or_equal_rows(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(3)], "id long, a double, b double")
    model = K.fit(same, "id", ["a", "b"], k=5, restarts=2)
    assert model.cost == 0 and K.assign(same, model, ["a", "b"]).select("segment_id").distinct().count() == 1
    with pytest.raises(ValueError):
        K.fit(same.limit(0), "id", ["a", "b"])


def test_a_wrong_centre_shows(spark):
    from mercato.operators.segments import fixed_point
    df, _ = _blobs(spark)
    model = K.fit(df, "id", ["a", "b"], k=4, restarts=2)
    fitted = K.assign(df, model, ["a", "b"])
    fine = fixed_point(fitted, model, ["a", "b"]).collect()
    assert sum(r.n_customers for r in fine) == 600 and all(r.n_nearer_elsewhere == 0 and r.centre_off < 1e-9 for r in fine)
    swapped = fitted.withColumn("segment_id", F.when(F.col("id") < 10, (F.col("segment_id") + 1) % 4).otherwise(F.col("segment_id")).cast("int"))
    bad = fixed_point(swapped, model, ["a", "b"]).collect()
    assert sum(r.n_nearer_elsewhere for r in bad) == 10 and max(r.centre_off for r in bad) > 1e-3
