"""Expectations on a table, evaluated by the write itself (DQ-01, DQ-03, SRC-12).

Row rules mark the rows that break them; table rules bound an aggregate of
the rows that are stored (expected counts, shares, dates).  All of them are
observed metrics of the one job that writes the table: no second scan.
Rows that break a quarantine rule are written by the same job to a folder
per broken rule, beside the good ones.  Only when no rule that guards the
table is breached are the good rows renamed into place; otherwise the old
table stays.  Every write appends its report to ``_checks``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato.sources import folders

FAILED = "_failed"
GOOD = f"{FAILED}=__HIVE_DEFAULT_PARTITION__"  # where rows without a failed rule land
REPORT = ("run string, tbl string, rule string, action string, observed double, low double, high double, "
          "passed boolean")


@dataclass(frozen=True)
class RowRule:
    """``ok`` (SQL) must hold for a row; NULL is a failure.

    ``quarantine`` sets failing rows apart, and stops the table from being
    replaced when their share exceeds ``at_most``; ``fail`` lets no more
    than that share pass; ``warn`` only reports."""

    name: str
    ok: str
    action: str = "quarantine"
    at_most: float = 1.0

    def __post_init__(self) -> None:
        _known(self.name, self.action, ("quarantine", "fail", "warn"))


@dataclass(frozen=True)
class TableRule:
    """An aggregate of the stored rows lies in [low, high]; None is no bound.

    ``value`` takes the column that is true for stored rows, as observed
    metrics know no filter: see ``rows``, ``share`` and ``largest``."""

    name: str
    value: Callable[[Column], Column]
    low: float | None = None
    high: float | None = None
    action: str = "fail"

    def __post_init__(self) -> None:
        _known(self.name, self.action, ("fail", "warn"))


def _known(name: str, action: str, actions: Sequence[str]) -> None:
    if not name.isidentifier():
        raise ValueError(f"rule name {name!r} is no identifier")
    if action not in actions:
        raise ValueError(f"{name}: action {action!r} is none of {', '.join(actions)}")


def rows(good: Column) -> Column:
    return F.count_if(good)


def share(condition: str) -> Callable[[Column], Column]:
    """Share of the stored rows for which ``condition`` holds (NULL for none)."""
    return lambda good: F.try_divide(F.count_if(good & F.expr(condition)), F.count_if(good))


def largest(value: str) -> Callable[[Column], Column]:
    return lambda good: F.max(F.when(good, F.expr(value)))


def smallest(value: str) -> Callable[[Column], Column]:
    return lambda good: F.min(F.when(good, F.expr(value)))


def total(value: str) -> Callable[[Column], Column]:
    return lambda good: F.sum(F.when(good, F.expr(value)))


class ExpectationError(ValueError):
    """A rule that guards the table is breached; the stored table is as it was."""

    def __init__(self, table: str, report: list[tuple]) -> None:
        self.table, self.report = table, report
        super().__init__(f"{table}: " + "; ".join(f"{r[2]} observed {r[4]}" for r in report if not r[7] and r[3] != "warn"))


def _judged(table: str, run: str, rules: Sequence[RowRule | TableRule], seen: dict) -> list[tuple]:
    out = []
    for rule in rules:
        value = seen[f"rule_{rule.name}"]
        if isinstance(rule, RowRule):
            # only a quarantine takes any share of failing rows by default
            spared = rule.action == "quarantine" or rule.at_most < 1
            low, high = None, rule.at_most * seen["rows"] if spared else 0.0
        else:
            low, high = rule.low, rule.high
        passed = value is not None and (low is None or value >= low) and (high is None or value <= high)
        out.append((run, table, rule.name, rule.action, *(None if x is None else float(x) for x in (value, low, high)), passed))
    return out


def checked_write(df: DataFrame, base: str, name: str, rules: Sequence[RowRule | TableRule] = (),
                  partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` to <base>/<name> under ``rules``; returns the number of stored rows.

    Failing rows go to <base>/_quarantine/<name>/run=<id>, the report to
    <base>/_checks (a table without rules leaves none).  Raises ``ExpectationError`` on a breach."""
    spark, base, run = df.sparkSession, base.rstrip("/"), uuid.uuid4().hex
    if len({r.name for r in rules}) != len(rules):
        raise ValueError(f"{name}: rule names repeat")
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    apart = [r for r in row_rules if r.action == "quarantine"]
    broken = {r.name: ~F.coalesce(F.expr(r.ok), F.lit(False)) for r in row_rules}
    failed = F.nullif(F.concat_ws(",", *[F.when(broken[r.name], F.lit(r.name)) for r in apart]), F.lit("")) if apart else F.lit(None)
    marked = df.withColumn(FAILED, failed.cast("string"))
    good = F.col(FAILED).isNull()
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("stored"),
               *[F.count_if(c).alias(f"rule_{k}") for k, c in broken.items()],
               *[r.value(good).cast("double").alias(f"rule_{r.name}") for r in rules if isinstance(r, TableRule)]]
    obs, stage = Observation(f"{name}-{run}"), f"{base}/_stage_{name}"
    observed = marked.observe(obs, *metrics)
    # the few folders of broken rules need no sort of the rows
    writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "32")
    try:
        out = (observed if apart else observed.drop(FAILED)).write.mode("overwrite")
        parts = [*([FAILED] if apart else []), *partition_by]
        (out.partitionBy(*parts) if parts else out).parquet(stage)
    finally:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", writers)
    seen = dict(obs.get)
    report = _judged(name, run, rules, seen)
    if report:
        spark.createDataFrame(report, REPORT).coalesce(1).write.mode("append").parquet(f"{base}/_checks")
    source = stage
    if apart:
        source = f"{base}/_good_{name}"
        folders.drop(spark, source)
        if folders.exists(spark, f"{stage}/{GOOD}"):
            folders.move(spark, f"{stage}/{GOOD}", source)
        else:
            empty = spark.createDataFrame([], df.schema).write
            (empty.partitionBy(*partition_by) if partition_by else empty).parquet(source)
        if seen["stored"] < seen["rows"]:
            folders.move(spark, stage, f"{base}/_quarantine/{name}/run={run}")
        folders.drop(spark, stage)
    if any(not r[7] and r[3] != "warn" for r in report):
        folders.drop(spark, source)
        raise ExpectationError(name, report)
    folders.swap(spark, source, f"{base}/{name}")
    return seen["stored"]


def checks(spark: SparkSession, base: str) -> DataFrame:
    """The reports of all writes under ``base``."""
    return spark.read.schema(REPORT).parquet(f"{base.rstrip('/')}/_checks")


def quarantined(spark: SparkSession, base: str, name: str, schema) -> DataFrame:
    """Rows set apart from a table, with the rules they broke (``_failed``) and the run."""
    path = f"{base.rstrip('/')}/_quarantine/{name}"
    wide = spark.createDataFrame([], schema).withColumns({"run": F.lit(""), FAILED: F.lit("")})
    return spark.read.schema(wide.schema).parquet(path) if folders.exists(spark, path) else wide
