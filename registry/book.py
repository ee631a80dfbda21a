"""Where the registered queries are kept: name, Spark query, and oracle SQL if any."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from registry.fixtures import Data, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
STATEMENTS: dict[str, str] = {}  # the oracles as written, without the views they use


def query(name: str, sql: str | None = None):
    """Register ``f(data) -> DataFrame`` under a name, with its oracle statement."""

    def register(func: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: func(Data(spark, sf_dir))
        if sql is not None:
            STATEMENTS[name], ORACLES[name] = sql, oracle(sql)
        return func

    return register
