"""The table of registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.numbers import zero_free

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is the same result as SQL over the raw tables."""

    def keep(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return keep


def rounded(df: DataFrame, digits: int = 6, **finer: int) -> DataFrame:
    """Round every double column for comparison across engines; ``finer`` sets digits per column."""
    return df.select(*[
        zero_free(F.round(F.col(f"`{f.name}`"), finer.get(f.name, digits))).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


# ---------------------------------------------------------------- SQL text helpers
def r6(*names: str) -> str:
    """SQL select items: each column rounded to six digits, negative zero removed."""
    return ", ".join(f"round({n}, 6) + 0e0 AS {n}" for n in names)


def dec(expression: str, digits: int) -> str:
    """SQL: nearest decimal of the exact double, ties to even."""
    return f"CAST(printf('%.{digits}f', CAST({expression} AS DOUBLE)) AS DOUBLE) + 0e0"
