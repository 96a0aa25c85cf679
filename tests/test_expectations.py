"""Expectations observed by the write itself; quarantine; a breach keeps the old table."""

import re

import pytest
from pyspark.sql import functions as F

from mercato.operators import expectations as E
from mercato.operators.expectations import ExpectationError, RowRule, TableRule

RULES = [RowRule("v_known", "v IS NOT NULL"), RowRule("v_small", "v < 100"), RowRule("id_positive", "id > 0", "warn"),
         TableRule("rows", E.rows, 2, 5), TableRule("most", E.largest("v"), high=50)]


def _df(spark, rows):
    return spark.createDataFrame(rows, "id long, v long")


def _ids(df):
    return sorted(r.id for r in df.toLocalIterator())


def _report(spark, base):
    return {r.rule: (r.action, r.observed, r.passed) for r in E.checks(spark, base).toLocalIterator()}


def test_failing_rows_are_set_apart_and_the_rest_is_stored(spark, tmp_path):
    base = str(tmp_path)
    rows = [(1, 10), (2, 20), (0, 30), (4, None), (5, 500)]
    assert E.checked_write(_df(spark, rows), base, "t", RULES) == 3
    assert _ids(spark.read.parquet(f"{base}/t")) == [0, 1, 2] and spark.read.parquet(f"{base}/t").columns == ["id", "v"]
    apart = E.quarantined(spark, base, "t", "id long, v long")
    # NULL < 100 is no pass, so both rules name that row
    assert sorted((r.id, r._failed) for r in apart.toLocalIterator()) == [(4, "v_known,v_small"), (5, "v_small")]
    assert _report(spark, base) == {"v_known": ("quarantine", 1.0, True), "v_small": ("quarantine", 2.0, True),
                                    "id_positive": ("warn", 1.0, False), "rows": ("fail", 3.0, True), "most": ("fail", 30.0, True)}


@pytest.mark.parametrize("rows, broken", [
    ([(1, 10)], "rows"), ([(i, 10) for i in range(1, 9)], "rows"), ([(1, 10), (2, 60)], "most"), ([], "rows")])
def test_a_breach_keeps_the_old_table_and_is_reported(spark, tmp_path, rows, broken):
    base = str(tmp_path)
    E.checked_write(_df(spark, [(7, 1), (8, 2)]), base, "t", RULES)
    with pytest.raises(ExpectationError, match=broken):
        E.checked_write(_df(spark, rows), base, "t", RULES)
    assert _ids(spark.read.parquet(f"{base}/t")) == [7, 8]
    assert [r.rule for r in E.checks(spark, base).where("NOT passed AND action = 'fail'").toLocalIterator()][:1] == [broken]
    left = {p.name for p in tmp_path.iterdir()}
    assert left == {"t", "_checks"}
    E.checked_write(_df(spark, [(1, 1), (2, 2), (3, 3)]), base, "t", RULES)  # and the next write goes through
    assert _ids(spark.read.parquet(f"{base}/t")) == [1, 2, 3]


def test_shares_of_failing_rows(spark, tmp_path):
    base, df = str(tmp_path), _df(spark, [(1, 1), (2, 2), (3, None), (4, None)])
    E.checked_write(df, base, "a", [RowRule("v_known", "v IS NOT NULL", at_most=0.5)])
    with pytest.raises(ExpectationError):
        E.checked_write(df, base, "b", [RowRule("v_known", "v IS NOT NULL", at_most=0.4)])
    E.checked_write(df, base, "c", [RowRule("v_known", "v IS NOT NULL", "fail", 0.5)])
    with pytest.raises(ExpectationError):
        E.checked_write(df, base, "d", [RowRule("v_known", "v IS NOT NULL", "fail")])
    assert spark.read.parquet(f"{base}/a").count() == 2 and spark.read.parquet(f"{base}/c").count() == 4
    assert not (tmp_path / "b").exists() and not (tmp_path / "d").exists()


def test_all_rows_set_apart_leave_an_empty_table(spark, tmp_path):
    base = str(tmp_path)
    assert E.checked_write(_df(spark, [(1, None)]), base, "t", [RowRule("v_known", "v IS NOT NULL")], ["id"]) == 0
    assert spark.read.schema("v long, id long").parquet(f"{base}/t").count() == 0


def test_partitions_of_the_table_stay(spark, tmp_path):
    base = str(tmp_path)
    E.checked_write(_df(spark, [(1, 1), (1, 2), (2, None), (3, 3)]), base, "t", [RowRule("v_known", "v IS NOT NULL")], ["id"])
    assert {p.name for p in (tmp_path / "t").iterdir() if "=" in p.name} == {"id=1", "id=3"}


def test_the_checks_cost_no_second_scan(spark, tmp_path):
    """The write reads its source once: every source row is counted once."""
    base, seen = str(tmp_path), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000, numPartitions=4).withColumn("v", F.col("id") % 7).mapInArrow(count, "id long, v long")
    assert E.checked_write(df, base, "t", [*RULES[:3], TableRule("rows", E.rows, 1000, 1000), TableRule("thirds", E.share("v < 3"), 0.4, 0.5)]) == 1000
    assert seen.value == 1000


@pytest.mark.parametrize("rule", [lambda: RowRule("a b", "true"), lambda: RowRule("a", "true", "drop"), lambda: TableRule("a", E.rows, action="quarantine")])
def test_rules_that_make_no_sense(rule):
    with pytest.raises(ValueError):
        rule()


def test_every_gold_table_of_a_build_is_checked(spark, sf_dir, tmp_path):
    from mercato.plans import gold
    from mercato.sources.retail import load
    counts = gold.build(spark, sf_dir, str(tmp_path))
    rules = gold.expectations(load(spark, sf_dir))
    seen = {(r.tbl, r.rule): r for r in E.checks(spark, str(tmp_path)).toLocalIterator()}
    assert set(seen) == {(t, r.name) for t, every in rules.items() for r in every}
    assert all(r.passed for r in seen.values() if r.action != "warn")
    assert all(seen[t, "rows"].observed == counts[t] for t in rules if (t, "rows") in seen)
    plan = spark.read.parquet(f"{tmp_path}/gold_sales_daily").where("sales_year = 1998")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*sales_year", plan)
