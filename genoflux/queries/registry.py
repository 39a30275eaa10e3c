"""All driver-table queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from . import q_columns, q_diff, q_io, q_jobs, q_joins, q_stream

_MODULES = [q_diff, q_columns, q_joins, q_io, q_jobs, q_stream]


def prepare_session(spark: SparkSession) -> None:
    """Settings the queries rely on (UTC text formatting, checkpoint root)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def wrapped(queries: dict) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _wrap(fn) for k, fn in queries.items()}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for m in _MODULES:
        out.update(wrapped(m.QUERIES))
    return out


def all_oracles() -> dict[str, str]:
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
