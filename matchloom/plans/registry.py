"""Named queries, each with its SQL counterpart where SQL can say the same."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchloom.functions.arrays import name_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows are checked."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.selectExpr(
        *[
            f"round({name_sql(f.name)}, {digits}) AS {name_sql(f.name)}"
            if isinstance(f.dataType, T.DoubleType)
            else name_sql(f.name)
            for f in df.schema.fields
        ]
    )
