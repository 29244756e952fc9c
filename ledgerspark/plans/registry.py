"""Name -> query function and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.plans.fixtures import PRELUDE, Views

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None, also: str = "", raw: str | None = None):
    """Register a function of ``Views``; ``sql`` continues the prelude, ``also`` adds CTEs to it, ``raw`` stands alone."""

    def add(fn: Callable[[Views], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = PRELUDE + (f", {also}\n" if also else "") + sql
        if raw is not None:
            ORACLES[key] = raw
        return fn

    return add


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: fn(Views(spark, folder))

    return {key: bind(fn) for key, fn in QUERIES.items()}
