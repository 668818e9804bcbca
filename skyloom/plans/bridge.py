"""The given tables as the inputs of the operators, in DataFrame and in SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_readings(events: DataFrame) -> DataFrame:
    """Sub-daily physical series: one reading per event, one site per user."""
    v, e = F.col("value"), F.col("event_id")
    lift = v / (v + 40.0)
    return events.select(
        F.col("user_id").alias("site_id"), "ts", F.to_date("ts").alias("date"), "event_id",
        (F.lit(273.15) + F.lit(46.0) * v / (v + 40.0)).alias("temp_k"),
        (F.lit(273.15) + F.lit(20.0) * v / (v + 40.0)).alias("dewpoint_k"),
        (F.lit(99000) + F.lit(40) * (e % 101)).cast("double").alias("pressure_pa"),
        (e % 21 - 10).cast("double").alias("wind_u"), (e % 13 - 6).cast("double").alias("wind_v"),
        (v / 100000.0).alias("precip_m"), ((e % 100) / 100.0).alias("cloud_cover"),
    )


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return as_readings(table(spark, sf, "events"))


READINGS = """readings AS (
  SELECT user_id AS site_id, ts, CAST(ts AS DATE) AS date, event_id,
    273.15e0 + 46e0 * value / (value + 40e0) AS temp_k,
    273.15e0 + 20e0 * value / (value + 40e0) AS dewpoint_k,
    CAST(99000 + 40 * (event_id % 101) AS DOUBLE) AS pressure_pa,
    CAST(event_id % 21 - 10 AS DOUBLE) AS wind_u, CAST(event_id % 13 - 6 AS DOUBLE) AS wind_v,
    value / 100000e0 AS precip_m, (event_id % 100) / 100e0 AS cloud_cover
  FROM events)"""


def as_obs(events: DataFrame) -> DataFrame:
    """Flat live readings with a forecast attached: one per event."""
    v, e = F.col("value"), F.col("event_id")
    kind = F.col("event_type")
    return events.select(
        "event_id", F.col("user_id").alias("site_id"),
        F.concat(F.lit("site_"), F.col("user_id").cast("string")).alias("city"), "ts",
        F.to_date("ts").alias("date"), F.hour("ts").alias("hour"),
        (F.lit(-8.0) + F.lit(54.0) * v / (v + 40.0)).alias("temperature"),
        (F.lit(960) + (e * 7) % 76).cast("int").alias("pressure"),
        (((e * 13) % 281) / 10.0).alias("wind_speed"), ((e * 37) % 360).cast("int").alias("wind_deg"),
        ((e * 11) % 101).cast("int").alias("humidity"), ((e * 29) % 101).cast("int").alias("clouds"),
        v.alias("pm2_5"), F.when(e % 4 == 0, v / 40.0).otherwise(F.lit(0.0)).alias("rain_1h"),
        (F.lit(200) + (e * 17) % 640).cast("int").alias("weather_id"),
        kind.alias("kind"), (v / (v + 40.0)).alias("risk_score"), (kind != "view").alias("ml_ready"),
        F.when(kind == "signup", "heat").when(kind == "error", "cold").when(kind == "click", "rain")
        .when(kind == "view", "wind").otherwise("none").alias("event_type"),
    )


def obs(spark: SparkSession, sf: str) -> DataFrame:
    return as_obs(table(spark, sf, "events"))


OBS = """obs AS (
  SELECT event_id, user_id AS site_id, 'site_' || user_id AS city, ts, CAST(ts AS DATE) AS date,
    CAST(hour(ts) AS INTEGER) AS hour,
    -8e0 + 54e0 * value / (value + 40e0) AS temperature,
    CAST(960 + (event_id * 7) % 76 AS INTEGER) AS pressure,
    ((event_id * 13) % 281) / 10e0 AS wind_speed, CAST((event_id * 37) % 360 AS INTEGER) AS wind_deg,
    CAST((event_id * 11) % 101 AS INTEGER) AS humidity, CAST((event_id * 29) % 101 AS INTEGER) AS clouds,
    value AS pm2_5, CASE WHEN event_id % 4 = 0 THEN value / 40e0 ELSE 0e0 END AS rain_1h,
    CAST(200 + (event_id * 17) % 640 AS INTEGER) AS weather_id,
    event_type AS kind, value / (value + 40e0) AS risk_score, event_type <> 'view' AS ml_ready,
    CASE event_type WHEN 'signup' THEN 'heat' WHEN 'error' THEN 'cold' WHEN 'click' THEN 'rain'
      WHEN 'view' THEN 'wind' ELSE 'none' END AS event_type
  FROM events)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Probability and label per event, for the evaluation operators."""
    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", F.to_date("ts").alias("date"), F.col("user_id").alias("site_id"),
        (v / (v + 40.0)).alias("prob"), (F.col("event_type") == "error").cast("int").alias("label"))


SCORED = """scored AS (
  SELECT event_id, CAST(ts AS DATE) AS date, user_id AS site_id, value / (value + 40e0) AS prob,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label
  FROM events)"""


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """Gridded variables in long form, one row per (time, cell)."""
    line = table(spark, sf, "lineitem")
    return line.groupBy(
        F.col("l_shipdate").alias("valid_time"), F.col("l_linenumber").cast("double").alias("latitude"),
        (F.col("l_suppkey") % 5).cast("double").alias("longitude"),
    ).agg(
        (F.lit(273.15) + F.avg("l_quantity")).alias("t2m"),
        (F.lit(99000.0) + F.avg("l_discount") * 10000.0).alias("sp"),
        F.avg(F.col("l_quantity") - 25.0).alias("u10"), F.avg("l_discount").alias("tcc"),
        F.max("l_tax").alias("tp"),
    )


GRID = """grid AS (
  SELECT l_shipdate AS valid_time, CAST(l_linenumber AS DOUBLE) AS latitude, CAST(l_suppkey % 5 AS DOUBLE) AS longitude,
    273.15e0 + avg(l_quantity) AS t2m, 99000e0 + avg(l_discount) * 10000e0 AS sp,
    avg(l_quantity - 25e0) AS u10, avg(l_discount) AS tcc, max(l_tax) AS tp
  FROM lineitem GROUP BY 1, 2, 3)"""


def ship_days(spark: SparkSession, sf: str) -> DataFrame:
    """A long daily series per site: one row per supplier and ship date."""
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("site_id"), F.to_date("l_shipdate").alias("date")
    ).agg(F.sum("l_quantity").alias("amount"), F.max("l_quantity").alias("peak"),
          F.max(F.when(F.col("l_quantity") >= 40, 1).otherwise(0)).alias("target"))


SHIP_DAYS = """ship_days AS (
  SELECT l_suppkey AS site_id, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS amount,
    max(l_quantity) AS peak, max(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS target
  FROM lineitem GROUP BY 1, 2)"""


# ---------------------------------------------------------------- SQL of the shared stages
PHYSICAL = """physical AS (
  SELECT *, temp_k - 273.15e0 AS temp_c, dewpoint_k - 273.15e0 AS dewpoint_c, pressure_pa / 100e0 AS pressure_hpa,
    sqrt(wind_u * wind_u + wind_v * wind_v) AS wind_speed,
    CASE WHEN lag(precip_m) OVER s IS NULL THEN NULL
      ELSE greatest(precip_m - lag(precip_m) OVER s, 0e0) * 1000e0 END AS precip_mm
  FROM readings WINDOW s AS (PARTITION BY site_id ORDER BY ts, event_id)),
moist AS (
  SELECT *, exp((17.625e0 * dewpoint_c) / (243.04e0 + dewpoint_c) - (17.625e0 * temp_c) / (243.04e0 + temp_c)) AS ratio
  FROM physical)"""

DAILY_FOREST = f"""{READINGS}, {PHYSICAL}, daily AS (
  SELECT site_id, date, max(temp_c) AS temp_c_max, min(temp_c) AS temp_c_min, avg(temp_c) AS temp_c_mean,
    avg(pressure_hpa) AS pressure_hpa_mean, min(pressure_hpa) AS pressure_hpa_min,
    max(wind_speed) AS wind_speed_max, avg(wind_speed) AS wind_speed_mean,
    max(greatest(0e0, least(100e0, 100e0 * ratio))) AS humidity_max,
    avg(greatest(0e0, least(100e0, 100e0 * ratio))) AS humidity_mean,
    coalesce(sum(precip_mm), 0e0) AS precip_mm_sum, avg(cloud_cover) AS cloud_cover_mean
  FROM moist GROUP BY 1, 2)"""

DAILY_SEQUENCE = f"""{READINGS}, {PHYSICAL}, daily AS (
  SELECT site_id, date, max(temp_c) AS temp_c, avg(dewpoint_c) AS dewpoint_c, avg(pressure_hpa) AS pressure_hpa,
    avg(wind_u) AS wind_u, avg(wind_v) AS wind_v, coalesce(sum(precip_mm), 0e0) AS precip_mm,
    avg(cloud_cover) AS cloud_cover
  FROM physical GROUP BY 1, 2)"""

DAILY_LIVE = f"""{OBS}, daily AS (
  SELECT site_id, date, CAST(count(*) AS BIGINT) AS n_readings, max(temperature) AS temp_c_max, min(temperature) AS temp_c_min,
    avg(temperature) AS temp_c_mean, avg(pressure) AS pressure_hpa_mean, min(pressure) AS pressure_hpa_min,
    max(wind_speed) AS wind_speed_max, avg(wind_speed) AS wind_speed_mean, max(humidity) AS humidity_max,
    avg(humidity) AS humidity_mean, coalesce(sum(rain_1h), 0e0) AS precip_mm_sum,
    avg(clouds) / 100e0 AS cloud_cover_mean, avg(pm2_5) AS pm2_5_mean
  FROM obs GROUP BY 1, 2)"""


def norm(x: str, low: float, high: float) -> str:
    return f"greatest(0e0, least(1e0, (CAST({x} AS DOUBLE) - {low}e0) / {high - low}e0))"


VISUAL = f"""{OBS}, norms AS (
  SELECT *, {norm('temperature', 0, 46)} AS temperature_norm, {norm('pressure', 990, 1030)} AS pn,
    {norm('pm2_5', 0, 75)} AS fragmentation, {norm('humidity', 10, 95)} AS hn,
    {norm('wind_speed', 0, 20)} AS wind_energy, {norm('clouds', 0, 100)} AS cn, {norm('rain_1h', 0, 10)} AS rn
  FROM obs),
visual AS (
  SELECT *, 0.3e0 + pn * 0.7e0 AS density, CAST(trunc(6 + pn * 14) AS INTEGER) AS num_layers,
    CAST(trunc(2 + fragmentation * 40) AS INTEGER) AS fragment_count,
    CAST(trunc(160 + (1 - hn) * 80) AS INTEGER) AS opacity_base, CAST(trunc(hn * 80) AS INTEGER) AS veil_opacity,
    sin(radians(CAST(wind_deg AS DOUBLE))) + 0e0 AS wind_dx, -cos(radians(CAST(wind_deg AS DOUBLE))) + 0e0 AS wind_dy,
    CAST(trunc(20 + wind_energy * 180) AS INTEGER) AS stroke_length,
    greatest(1, CAST(trunc(wind_energy * 8) AS INTEGER)) AS stroke_width,
    CAST(trunc(15 + cn * 35) AS INTEGER) AS bg_darkness, rain_1h > 0 AS is_raining,
    CASE WHEN weather_id BETWEEN 200 AND 299 THEN 'storm' WHEN weather_id BETWEEN 300 AND 399 THEN 'drizzle'
      WHEN weather_id BETWEEN 500 AND 599 THEN 'rain' WHEN weather_id BETWEEN 600 AND 699 THEN 'snow'
      WHEN weather_id BETWEEN 700 AND 799 THEN 'atmosphere' WHEN weather_id = 800 THEN 'clear'
      WHEN weather_id > 800 THEN 'clouds' ELSE 'unknown' END AS weather_group,
    (['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSO','SO','OSO','O','ONO','NO','NNO'])
      [CAST(trunc((wind_deg + 11.25e0) / 22.5e0) AS INTEGER) % 16 + 1] AS wind_dir
  FROM norms)"""

DOMINANT = f"""{VISUAL}, score_rows AS (
  SELECT event_id, 1 AS place, 'temperatura' AS name, temperature_norm AS score FROM visual
  UNION ALL SELECT event_id, 2, 'viento', wind_energy FROM visual
  UNION ALL SELECT event_id, 3, 'humedad', veil_opacity / 80e0 FROM visual
  UNION ALL SELECT event_id, 4, 'presion', density FROM visual
  UNION ALL SELECT event_id, 5, 'nubes', clouds / 100e0 FROM visual
  UNION ALL SELECT event_id, 6, 'pm25', fragmentation FROM visual),
ranks AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY score DESC, place) AS rk FROM score_rows),
dominant AS (
  SELECT v.*, a.name AS dominant, a.score AS dominant_strength, b.name AS second, b.score AS second_strength,
    CASE WHEN a.name = 'presion' THEN b.name END AS dominant2
  FROM visual v JOIN ranks a ON a.event_id = v.event_id AND a.rk = 1
  JOIN ranks b ON b.event_id = v.event_id AND b.rk = 2)"""
