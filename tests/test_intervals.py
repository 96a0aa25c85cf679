"""Range join on bins by length class; overlaps by a sweep."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mercato.operators.quality import promo_overlap, promo_overlap_stretches
from mercato.plans.joins import binned, join_intervals, join_promotions, levels

D0 = dt.date(1969, 6, 1)  # days before and after the epoch


def _promos(spark, n, longest, seed=1):
    r, rows = random.Random(seed), []
    for i in range(n):
        s = r.randrange(2000)
        rows.append((r.choice("abc"), f"p{i}", D0 + dt.timedelta(s), D0 + dt.timedelta(s + r.choice([0, 1, r.randrange(longest), -1]))))
    return rows, spark.createDataFrame(rows, "category string, promo_name string, start_date date, end_date date")


def _lines(spark, n=400, seed=2):
    r = random.Random(seed)
    rows = [(i, r.choice("abcd"), D0 + dt.timedelta(r.randrange(-50, 4000))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, category string, order_date date")


@pytest.mark.parametrize("longest, hint", [(30, None), (30, 10), (700, None), (700, 30), (3000, None), (20_000, 20_000)])
def test_same_rows_as_between(spark, longest, hint):
    (promos, p), (lines, l) = _promos(spark, 60, longest), _lines(spark)
    got = sorted((r.id, r.promo_name) for r in join_promotions(l, p, longest_days=hint).collect())
    want = []
    for i, c, d in lines:
        hit = [n for pc, n, s, e in promos if pc == c and s <= d <= e]
        want += [(i, n) for n in hit] or [(i, None)]
    assert got == sorted(want, key=lambda x: (x[0], x[1] or "")) or sorted(got, key=str) == sorted(want, key=str)
    inner = sorted((r.id, r.promo_name) for r in join_intervals(l, p, "order_date", "start_date", "end_date", ["category"], "inner", hint).collect())
    assert inner == sorted(w for w in want if w[1] is not None)


def test_rows_per_interval_do_not_grow_with_its_length(spark):
    _, p = _promos(spark, 200, 20_000)
    n = levels(20_000)
    assert n == 3 and max(r["count"] for r in binned(p, "start_date", "end_date", n).groupBy("promo_name").count().collect()) <= 17


def test_no_plan_lists_the_days_of_promotions(spark, sf_dir):
    for name in ("sales_daily", "promo_overlap_stretches"):
        plan = E.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        steps = [x for x in plan.split("\n") if "sequence(" in x]
        assert steps and all("FLOOR" in x.split("sequence(")[1] for x in steps)  # bins, not days
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("lead", [0, 9])
def test_stretches_cover_the_days_of_a_plain_count(spark, lead):
    promos, p = _promos(spark, 40, 120)
    days = {}
    for c, n, s, e in promos:
        for k in range((e - s).days + 1 + lead if e >= s - dt.timedelta(lead) else 0):
            days.setdefault((c, s - dt.timedelta(lead) + dt.timedelta(k)), []).append(n)
    want = {k: (len(v), "|".join(sorted(v))) for k, v in days.items() if len(v) > 1}
    got = {(r.category, r.promo_date): (r.n_promos, r.promo_names) for r in promo_overlap(p, lead).collect()}
    assert got == want and len(want) > 20
    runs = promo_overlap_stretches(p, lead).collect()
    assert sum((r.to_date - r.from_date).days + 1 for r in runs) == len(want) and len(runs) < len(want)


def test_nothing(spark):
    p = spark.createDataFrame([], "category string, promo_name string, start_date date, end_date date")
    _, l = _lines(spark, 5)
    assert join_promotions(l, p).where(F.col("promo_name").isNull()).count() == 5
    assert promo_overlap(p).count() == 0


def test_one_promotion_takes_over_from_another(spark):
    d = lambda k: D0 + dt.timedelta(k)
    p = spark.createDataFrame([("a", "A", d(0), d(10)), ("a", "B", d(11), d(20)), ("a", "C", d(5), d(15))],
                              "category string, promo_name string, start_date date, end_date date")
    got = sorted((r.from_date, r.to_date, r.n_promos, r.promo_names) for r in promo_overlap_stretches(p).collect())
    assert got == [(d(5), d(10), 2, "A|C"), (d(11), d(15), 2, "B|C")]
