"""Distinct counts from bitmaps."""

import re

import pytest
from pyspark.sql import functions as F

from mercato.operators import distinct as D
from mercato.plans.gold import Gold, write_table
from mercato.sources.retail import load


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("gold"))
    write_table(D.slicer_bitmaps(load(spark, sf_dir)), out, "gold_slicer_bitmaps")
    return Gold(spark, out).slicer_bitmaps


@pytest.mark.parametrize("by", [[], ["region"], ["sales_month"], ["category", "store_type"], D.SLICERS])
def test_equal_to_count_distinct(spark, sf_dir, stored, by):
    lines = D.sold(load(spark, sf_dir))
    want = lines.groupBy(*by).agg(F.count_distinct("order_id").alias("nb_orders_distinct"), F.count_distinct("customer_id").alias("nb_clients"))
    got = D.distinct_counts(stored, by)
    assert sorted(map(tuple, got.toLocalIterator())) == sorted(map(tuple, want.toLocalIterator()))


def test_counts_read_the_bitmaps_alone(stored):
    df = D.distinct_counts(stored, ["region"], F.col("channel") == "drive")
    assert {re.search(r"/(gold_\w+)/", f)[1] for f in df.inputFiles()} == {"gold_slicer_bitmaps"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "EqualTo(channel,drive)" in plan and "Join" not in plan


def test_appended_lines_count_once(spark):
    schema = "g string, id_kind string, id long"
    lines = lambda rows: D.bitmaps(spark.createDataFrame(rows, schema), "id", ["g", "id_kind"])
    first = lines([("a", "orders", 1), ("a", "orders", 40_000), ("b", "orders", 1), ("a", "customers", 9)])
    again = lines([("a", "orders", 1), ("a", "orders", 2), ("b", "orders", 10**15), ("c", "customers", 9), ("c", "customers", None)])
    both = D.appended(first, again)
    counts = lambda by: {r[0] if by else None: (r.nb_orders_distinct, r.nb_clients)
                         for r in D.distinct_counts(both, by).toLocalIterator()}
    assert counts(["g"]) == {"a": (3, 1), "b": (2, 0), "c": (0, 1)}
    assert counts([]) == {None: (4, 1)}
    assert counts([]) == {None: (4, 1)} and D.distinct_counts(D.appended(both, again)).first() == D.distinct_counts(both).first()


def test_no_rows(spark):
    empty = spark.createDataFrame([], "g string, id_kind string, bucket long, ids binary")
    assert D.distinct_counts(empty).first() == (0, 0) and D.distinct_counts(empty, ["g"]).count() == 0
