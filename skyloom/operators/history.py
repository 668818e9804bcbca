"""Keyed history: append, upsert, archive order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.numbers import round_exact
from skyloom.functions.visual import compass


def append_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, then all of ``new``.

    ``new`` is reduced to its distinct keys first, so a key repeated in both sides makes no pairs.
    """
    fresh = new.select(*keys).distinct()
    return old.join(fresh, keys, "left_anti").unionByName(new, allowMissingColumns=True)


def latest(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Last write per key. Partial aggregation keeps one row per key and task before the shuffle."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*seq)).alias("_row")).select("_row.*")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The newest row per key over both tables; a key in ``new`` always replaces ``old``."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, ["_side", *seq]).drop("_side")


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """K1."""
    return df.orderBy(*keys)


def newest_first(df: DataFrame, date: str = "date", hour: str = "hour") -> DataFrame:
    """K2: a range-partitioned sort, newest first."""
    return df.orderBy(F.col(date).desc(), F.col(hour).desc())


def tail(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """K8: the last ``n`` rows by key; each task keeps only its own top ``n``."""
    return df.orderBy(*[F.col(k).desc() for k in keys]).limit(n)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Optional columns of a record: absent or missing values take their default."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns(filled)


def archive_columns() -> dict[str, Column]:
    """The 23 fields of an archive entry from an encoded, scored reading."""
    return {
        "date": F.col("date"),
        "hour": F.col("hour"),
        "city": F.coalesce(F.col("city"), F.lit(K.DEFAULT_CITY)),
        "image_path": F.col("image_path"),
        "temp_c": round_exact("temperature", 1),
        "pressure": F.col("pressure"),
        "wind_speed": round_exact("wind_speed", 1),
        "wind_dir": compass("wind_deg"),
        "humidity": F.col("humidity"),
        "clouds": F.coalesce(F.col("clouds"), F.lit(0)),
        "pm25": round_exact(F.coalesce(F.col("pm2_5"), F.lit(0.0)), 1),
        "temp_norm": round_exact("temperature_norm", 3),
        "pressure_norm": round_exact("density", 3),
        "wind_energy": round_exact("wind_energy", 3),
        "humidity_norm": round_exact(F.col("veil_opacity") / F.lit(K.VEIL), 3),
        "cloud_norm": round_exact(F.coalesce(F.col("clouds"), F.lit(0)) / F.lit(100.0), 3),
        "pm_norm": round_exact("fragmentation", 3),
        "dominant": F.coalesce(F.col("dominant"), F.lit(K.VARIABLES[0])),
        "dominant_strength": round_exact(F.coalesce(F.col("dominant_strength"), F.lit(0.0)), 3),
        "dominant2": F.col("dominant2"),
        "ml_ready": F.coalesce(F.col("ml_ready"), F.lit(False)),
        "risk_score": round_exact(F.coalesce(F.col("risk_score"), F.lit(0.0)), 3),
        "event_type": F.coalesce(F.col("event_type"), F.lit("none")),
    }


def archive_entries(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Archive entries; ``keep`` carries extra key columns along."""
    return df.select(*(keep or []), *[value.alias(name) for name, value in archive_columns().items()])
