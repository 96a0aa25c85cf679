"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry builds the retail views over the warehouse folder and runs one
operator (or one question / report) on them.  ``mercato.plans.oracle``
holds the matching DuckDB SQL under the same names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.sources.retail import Retail, load

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Queries whose result has no SQL oracle (iterative ML, streaming).
ROWS_ONLY: set[str] = set()


def register(name: str, rows_only: bool = False):
    def deco(fn: Callable[[Retail], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(load(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        if rows_only:
            ROWS_ONLY.add(name)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the modules fills REGISTRY
    from mercato.plans import catalog  # noqa: F401
    return dict(REGISTRY)
