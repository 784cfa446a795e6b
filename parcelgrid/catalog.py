"""Registry of named jobs for the driver contract.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs one job over the fixture
tables of a scale-factor folder; ``ORACLE[name]`` is the independent DuckDB
SQL for the same result (absent where no SQL form exists).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelgrid import fixtures as fx
from parcelgrid.sources.tables import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Lake(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tables(lake: Lake):
    """The four core conformed tables."""
    return (fx.epc_assessments(lake), fx.master_properties(lake),
            fx.ownership_records(lake), fx.corporate_registry(lake))


def load_all():
    """Import every module that registers jobs."""
    from parcelgrid import jobs, jobs_feeds, jobs_signals  # noqa: F401
    return QUERIES, ORACLE
