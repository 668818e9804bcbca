"""Helpers shared by the text operators."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

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


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the six ASCII blanks of WORD."""
    return text.encode().split() if text else []


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


@cache
def category_table(categories: str) -> np.ndarray:
    """Truth table over all code points: does the general category start with one of ``categories``?"""
    wanted = tuple(categories.split())
    return np.fromiter(
        (unicodedata.category(chr(c)).startswith(wanted) for c in range(0x110000)), dtype=bool, count=0x110000
    )


def fold_of(key: Column, folds: int) -> Column:
    """Checksum fold of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def each(function: Callable, schema: T.StructType) -> Callable[..., Column]:
    """A column function: ``function(value)`` returns one tuple per row, in the order of ``schema``.

    Rows travel in Arrow batches, whose size in bytes Spark bounds.
    """
    names = schema.fieldNames()

    def batch(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([function(v) for v in values], columns=names)

    return pandas_udf(batch, schema)


def kept_rows(docs: DataFrame, text_col: str, column: Callable[[Column], Column], test: Column) -> DataFrame:
    """Rows of ``docs`` whose ``column(text)``, named ``m`` in ``test``, passes; columns stay as they are."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    judged = row.select("row", column(F.col(f"row.`{text_col}`")).alias("m"))
    return judged.where(test).select("row.*")


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside; the session's setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)
