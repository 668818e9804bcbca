"""The published climate payload (S9) and its recovery from archived pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom import schemas
from skyloom.functions.numbers import round_exact
from skyloom.functions.visual import compass

# How a page embeds its payload
PAYLOAD_PATTERN = r"const (?:C|CLIMATE) = (\{[\s\S]*?\});"


def payload_columns() -> dict[str, Column]:
    """The 30 fields, rounded for display."""
    return {
        "city": F.col("city"), "date": F.date_format("date", "yyyy-MM-dd"), "hour": F.col("hour"),
        "temp_c": F.col("temperature"), "pressure": F.col("pressure"), "wind_speed": F.col("wind_speed"),
        "wind_dir": compass("wind_deg"),
        "wind_dx": round_exact("wind_dx", 3), "wind_dy": round_exact("wind_dy", 3),
        "pm25": F.col("pm2_5"), "humidity": F.col("humidity"),
        "clouds": F.coalesce(F.col("clouds"), F.lit(K.DEFAULT_CLOUDS)),
        "temp_norm": round_exact("temperature_norm", 3), "pressure_norm": round_exact("density", 3),
        "wind_energy": round_exact("wind_energy", 3), "pm_norm": round_exact("fragmentation", 3),
        "humidity_norm": round_exact(F.col("veil_opacity") / F.lit(K.VEIL), 3),
        "cloud_norm": round_exact(F.coalesce(F.col("clouds"), F.lit(K.DEFAULT_CLOUDS)) / F.lit(100.0), 3),
        "rain_1h": round_exact("rain_1h", 2), "rain_norm": round_exact("rain_norm", 3),
        "is_raining": F.col("is_raining"), "weather_id": F.col("weather_id"), "weather_group": F.col("weather_group"),
        "dominant": F.col("dominant"), "dominant_strength": round_exact("dominant_strength", 3),
        "dominant2": F.col("dominant2"), "dominant2_strength": round_exact("second_strength", 3),
        "risk_score": round_exact(F.coalesce(F.col("risk_score"), F.lit(0.0)), 3),
        "event_type": F.coalesce(F.col("event_type"), F.lit("none")),
        "ml_ready": F.coalesce(F.col("ml_ready"), F.lit(False)),
    }


def payload_json(df: DataFrame, keep: tuple[str, ...] = (), name: str = "payload") -> DataFrame:
    """One JSON document per encoded, scored reading."""
    record = F.struct(*[value.alias(field) for field, value in payload_columns().items()])
    return df.select(*keep, F.to_json(record, {"ignoreNullFields": "false"}).alias(name))


def read_payload(df: DataFrame, name: str = "payload") -> DataFrame:
    """Parse payload text with the union schema; fields a version lacks are NULL."""
    return df.withColumn("_p", F.from_json(name, schemas.PAYLOAD)).select(
        *[c for c in df.columns if c != name], "_p.*")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Whole pages as ``html`` with their file name."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("page"), F.col("value").alias("html"))


def extract_payloads(pages: DataFrame, pattern: str = PAYLOAD_PATTERN, html: str = "html") -> DataFrame:
    """Records of archived pages of any version; pages without a payload are dropped."""
    found = pages.withColumn("payload", F.regexp_extract(html, pattern, 1)).filter(F.col("payload") != "")
    return read_payload(found.drop(html))


def page_facts(pages: DataFrame, html: str = "html") -> DataFrame:
    """S13 on tracked pages: language, title and the embedded script number."""
    number = F.regexp_extract(html, r"track\((\d+)\)", 1)
    return pages.select(
        "page_id", F.regexp_extract(html, '<html[^>]*lang="([a-zA-Z-]+)"', 1).alias("lang"),
        F.regexp_extract(html, "<title>([^<]*)</title>", 1).alias("title"),
        F.when(number != "", number).cast("long").alias("track"))
