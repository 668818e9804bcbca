"""Landed JSON documents to flat readings (S1, J2, X27) and the inline sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom import schemas


def parse_documents(df: DataFrame, weather: str = "weather_doc", air: str | None = "air_doc") -> DataFrame:
    """Parse JSON text columns in place with the explicit schemas."""
    parsed = {weather: F.from_json(weather, schemas.WEATHER)}
    if air:
        parsed[air] = F.from_json(air, schemas.AIR)
    return df.withColumns(parsed)


def read_documents(spark: SparkSession, path: str, kind: str = "weather") -> DataFrame:
    """Landed JSON files as one ``weather_doc`` or ``air_doc`` struct per document."""
    schema = schemas.WEATHER if kind == "weather" else schemas.AIR
    docs = spark.read.schema(schema).json(path)
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias(f"{kind}_doc"))


def _default(value: Column, default) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def weather_columns(doc: str = "weather_doc") -> dict[str, Column]:
    """The scalars of one weather document, optional fields defaulted."""
    w = F.col(doc)
    main, wind, sky = w["main"], w["wind"], F.get(w["weather"], 0)
    return {
        "temperature": main["temp"], "temp_min": main["temp_min"], "temp_max": main["temp_max"],
        "feels_like": _default(main["feels_like"], main["temp"]),
        "humidity": main["humidity"], "pressure": main["pressure"],
        "sea_level": _default(main["sea_level"], main["pressure"]),
        "grnd_level": _default(main["grnd_level"], main["pressure"]),
        "wind_speed": wind["speed"], "wind_deg": wind["deg"], "wind_gust": _default(wind["gust"], wind["speed"]),
        "clouds": w["clouds"]["all"], "visibility": _default(w["visibility"], K.DEFAULT_VISIBILITY),
        "rain_1h": _default(w["rain"]["1h"], 0.0), "rain_3h": _default(w["rain"]["3h"], 0.0),
        "snow_1h": _default(w["snow"]["1h"], 0.0),
        "weather_id": sky["id"], "weather_main": sky["main"], "weather_desc": sky["description"],
        "sunrise": _default(w["sys"]["sunrise"], F.lit(0).cast("long")),
        "sunset": _default(w["sys"]["sunset"], F.lit(0).cast("long")),
        "city": w["name"], "lat": w["coord"]["lat"], "lon": w["coord"]["lon"],
    }


def air_columns(doc: str = "air_doc") -> dict[str, Column]:
    """The scalars of one air-quality document."""
    first = F.get(F.col(doc)["list"], 0)
    parts = {c: _default(first["components"][c], 0.0) for c in ("pm2_5", "pm10", "no2", "o3", "co", "so2", "nh3")}
    return {"aqi": first["main"]["aqi"], **parts}


def flatten_readings(weather: DataFrame, air: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """32 scalars per reading, air quality joined on the coordinates of the weather document.

    ``air`` has one document per coordinate pair. No side is forced to broadcast: at run time Spark
    broadcasts it when it is small, and otherwise splits a coordinate pair that holds a large part
    of the readings over several tasks (adaptive skew join).
    """
    # The key is a struct: an inner join on plain lat and lon would push null checks below the parse
    # and so parse every document once more per check.
    at = F.struct("lat", "lon").alias("_at")
    flat = weather.select(*keep, *[c.alias(n) for n, c in weather_columns().items()]).select("*", at)
    clean = air.select(
        F.col("air_doc.coord.lat").alias("lat"), F.col("air_doc.coord.lon").alias("lon"),
        *[c.alias(n) for n, c in air_columns().items()]).dropna(subset=["lat", "lon"])
    return flat.join(clean.select(at, *air_columns()), "_at", "inner").drop("_at")


def sample_reading(spark: SparkSession) -> DataFrame:
    """One fixed reading."""
    return spark.createDataFrame([tuple(K.SAMPLE_READING.values())], list(K.SAMPLE_READING))
