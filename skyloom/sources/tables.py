"""History, grid, feature, archive and metrics tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import schemas
from skyloom.session import durable, path_exists


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw history from CSV with a fixed schema (no inference pass)."""
    return spark.read.schema(schemas.RAW_HISTORY).option("header", True).csv(path)


def read_daily_csv(spark: SparkSession, path: str, extra: str | None = None) -> DataFrame:
    """Daily history from CSV, in one file or by date, dates parsed; ``extra`` puts key columns (DDL) in front."""
    schema = _keyed(schemas.DAILY_HISTORY, extra)
    return spark.read.schema(schema).option("header", True).csv(path).select(*schema.fieldNames())


def write_daily_csv(df: DataFrame, path: str, date: str = "date") -> None:
    """Daily history as CSV; a write replaces the dates that occur in ``df`` and no others."""
    df.hint("rebalance", date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "header", True).partitionBy(date).csv(path)


def _keyed(schema: T.StructType, extra: str | None) -> T.StructType:
    return T.StructType(T.StructType.fromDDL(extra).fields + schema.fields) if extra else schema


def write_partitioned(df: DataFrame, path: str, by: str = "date", sort: Iterable[str] = ()) -> None:
    """Replace only the partitions that occur in ``df``.

    The rebalance hint groups rows by partition value and lets adaptive execution split a very large
    day over several tasks and merge small ones, so neither hot days nor tiny files arise.
    """
    df = df.hint("rebalance", by)
    if sort:
        df = df.sortWithinPartitions(by, *sort)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def _write_years(df: DataFrame, path: str, time: str) -> None:
    """Replace the days of ``df`` in a table partitioned by year.

    Years are the unit of overwriting, so the other days of the touched years are merged in first;
    untouched years are neither read nor written.
    """
    new = df.withColumn("year", F.year(time))
    if path_exists(df.sparkSession, path):
        days = new.select("year", F.to_date(time).alias("_day")).distinct()
        old = df.sparkSession.read.parquet(path).join(days.select("year").distinct(), "year", "left_semi")
        others = old.withColumn("_day", F.to_date(time)).join(days, ["year", "_day"], "left_anti").drop("_day")
        new = durable(new.unionByName(others, allowMissingColumns=True), "years")
    write_partitioned(new, path, "year")


def write_grid(df: DataFrame, path: str, time: str = "valid_time") -> None:
    """The long grid table by year; a write replaces the days it holds and no others."""
    _write_years(df, path, time)


def read_grid(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    """All years, or only the directories of the wanted ones."""
    df = spark.read.parquet(path)
    return df if years is None else df.filter(F.col("year").isin(*years))


def union_periods(df: DataFrame, periods: list[tuple[int, int]], time: str = "ts") -> DataFrame:
    """Rows whose year lies in any of the (disjoint) periods, as one filtered scan."""
    year = F.year(time)
    wanted = F.lit(False)
    for first, last in periods:
        wanted = wanted | year.between(first, last)
    return df.filter(wanted)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union by name of files whose columns drifted."""
    result, *rest = parts
    for part in rest:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def write_features(df: DataFrame, path: str, date: str = "date") -> None:
    """Feature table by year; a write replaces the days it holds and no others."""
    _write_years(df, path, date)


def read_features(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    """S7."""
    return read_grid(spark, path, years).drop("year")


def write_archive(df: DataFrame, path: str) -> None:
    """Archive entries as JSON lines, newest first within and across files."""
    ordered = df.orderBy(F.col("date").desc(), F.col("hour").desc())
    ordered.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_archive(spark: SparkSession, path: str, multiline: bool = False, extra: str | None = None) -> DataFrame:
    """JSON lines, or a single JSON array with ``multiline``; ``extra`` adds key columns as DDL."""
    return spark.read.schema(_keyed(schemas.ARCHIVE, extra)).option("multiLine", multiline).json(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Nested metrics as JSON."""
    df.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """S10."""
    return spark.read.schema(schemas.METRICS).json(path)


def metrics_record(folds: DataFrame, top: DataFrame, summary: DataFrame, model: str) -> DataFrame:
    """One nested row from fold metrics, top features and table counts.

    The folded lists hold one entry per fold and per reported feature, both fixed small numbers.
    """
    fold_list = folds.agg(F.sort_array(F.collect_list(F.struct(
        F.col("fold").cast("int").alias("fold"), "f1", "auc"))).alias("folds"),
        F.avg("f1").alias("mean_f1"), F.avg("auc").alias("mean_auc"))
    top_list = top.agg(F.sort_array(F.collect_list(F.struct("importance", "feature")), asc=False).alias("t")).select(
        F.transform("t", lambda s: F.struct(s["feature"].alias("feature"), s["importance"].alias("importance"))).alias("t"))
    return fold_list.withColumn("top_features", top_list.scalar()).select(
        F.lit(model).alias("model"), "mean_f1", "mean_auc", "folds", "top_features",
        *[summary.select(c).scalar().alias(c) for c in ("n_features", "n_samples", "event_rate")])
