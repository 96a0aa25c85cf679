"""Exact quantiles from stored sketches."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.functions import sketches as S


def _facts(spark, n=20_000):
    # heavy ties in a, a continuous b with nulls, a group of one row and one of nulls
    main = spark.range(n).select((F.col("id") % 7).cast("string").alias("g"), (F.col("id") % 12).alias("month"),
                                 (F.col("id") * F.col("id") % 50).cast("double").alias("a"),
                                 F.when(F.col("id") % 11 > 0, (F.col("id") * 7919 % 10007) / 3.0).alias("b"))
    return main.unionByName(spark.createDataFrame([("one", 1, 2.0, 3.0), ("none", 1, None, None), ("half", 1, 4.0, None), (None, 1, 5.0, 6.0)],
                                                  "g string, month long, a double, b double"))


def _want(facts, by, q, where=lambda r: True):
    groups = {}
    for r in facts.toLocalIterator():
        if where(r):
            groups.setdefault(tuple(r[c] for c in by), []).append((r.a, r.b))
    out = {}
    for k, rows in groups.items():
        cols = [[v for v in c if v is not None] for c in zip(*rows)]
        if any(cols):
            out[k] = tuple(float(np.quantile(c, q)) if c else None for c in cols)
    return out


def _got(df, by):
    return {tuple(r[c] for c in by): (r.qa, r.qb) for r in df.toLocalIterator()}


NAMES = {"a": "qa", "b": "qb"}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_equal_to_sorted_values(spark, q):
    facts = _facts(spark)
    stored = S.sketches(facts, ["g", "month"], ["a", "b"])
    got = _got(S.sketched_quantiles(facts, stored, ["g"], NAMES, q), ["g"])
    want = _want(facts, ["g"], q)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], nan_ok=True) for k in want)


def test_filter_on_keys_and_no_group(spark):
    facts = _facts(spark)
    stored = S.sketches(facts, ["g", "month"], ["a", "b"])
    got = _got(S.sketched_quantiles(facts, stored, [], NAMES, 0.5, F.col("month").isin(1, 2)), [])
    assert got[()] == pytest.approx(_want(facts, [], 0.5, lambda r: r.month in (1, 2))[()])


def test_a_bracket_that_misses_the_rank_is_scanned_again(spark, monkeypatch):
    facts = _facts(spark)
    stored = S.sketches(facts, ["g"], ["a", "b"])
    wrong = S.brackets

    def moved(*args, **kw):
        # one group's bracket lies too high, one too low, one holds nothing
        x = wrong(*args, **kw)
        g = F.col("group.g")
        shift = F.when(g == "1", 5000.0).when(g == "2", -5000.0).otherwise(0.0)
        return x.withColumns({"low": F.when(g == "3", F.lit(9e9)).otherwise(F.col("low") + shift),
                              "high": F.when(g == "3", F.lit(9e9)).otherwise(F.col("high") + shift)})

    monkeypatch.setattr(S, "brackets", moved)
    got, want = _got(S.sketched_quantiles(facts, stored, ["g"], NAMES, 0.5), ["g"]), _want(facts, ["g"], 0.5)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_one_scan_and_few_rows_past_it(spark, tmp_path):
    _facts(spark, 100_000).write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    S.sketches(facts, ["g", "month"], ["a", "b"]).write.parquet(str(tmp_path / "s"))
    bracketed = S.brackets(spark.read.parquet(str(tmp_path / "s")), ["g"], 0.5)
    df = S._refined(facts, bracketed, ["g"], ["a", "b"], 0.5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^\]]*\ba#", plan.split("Initial Plan")[0])) == 1
    inside = facts.join(bracketed.where("measure = 'b'").select("group.g", "low", "high"), "g").where("b BETWEEN low AND high").count()
    assert inside < 0.03 * facts.count()


def test_empty(spark):
    facts = spark.createDataFrame([], "g string, a double, b double")
    stored = S.sketches(facts, ["g"], ["a", "b"])
    assert S.sketched_quantiles(facts, stored, ["g"], NAMES, 0.5).count() == 0
