"""The list of registered queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    """Register a callable ``(spark, sf_dir) -> DataFrame`` under ``name``, with its oracle if there is one."""

    def register(make):
        def tidied(spark, sf_dir):
            return tidy(make(spark, sf_dir))

        QUERIES[name] = tidied
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return register


def tidy(frame: DataFrame) -> DataFrame:
    """Doubles to six decimals (and never -0.0), so that summation order does not show."""
    columns: list[Column] = []
    for f in frame.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = (F.round(column.cast("double"), 6) + F.lit(0.0)).alias(f.name)
        columns.append(column)
    return frame.select(*columns)


def rd(expression: str) -> str:
    """The same rounding in the oracle."""
    return f"round(cast({expression} as double), 6) + 0.0"
