"""Landed documents, payloads and pages."""

import json

from pyspark.sql import functions as F

from skyloom import schemas
from skyloom.sources import payload, readings

WEATHER = {
    "coord": {"lat": 37.38, "lon": -5.98}, "weather": [{"id": 501, "main": "Rain", "description": "moderate rain"}],
    "main": {"temp": 20.5, "temp_min": 19.0, "temp_max": 22.0, "humidity": 60, "pressure": 1012},
    "wind": {"speed": 3.5, "deg": 200}, "clouds": {"all": 75}, "rain": {"1h": 0.6}, "sys": {}, "name": "Seville",
}
AIR = {"coord": {"lat": 37.38, "lon": -5.98}, "list": [{"main": {"aqi": 2}, "components": {"pm2_5": 7.1, "o3": 60.0}}]}


def test_landed_files_get_their_defaults(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "a").mkdir()
    (tmp_path / "w" / "1.json").write_text(json.dumps(WEATHER))
    (tmp_path / "a" / "1.json").write_text(json.dumps(AIR))
    weather = readings.read_documents(spark, str(tmp_path / "w"))
    air = readings.read_documents(spark, str(tmp_path / "a"), "air")
    row = readings.flatten_readings(weather, air).first().asDict()
    assert len(row) == 32
    want = {
        "feels_like": 20.5, "sea_level": 1012, "grnd_level": 1012, "wind_gust": 3.5, "visibility": 10000, "rain_1h": 0.6,
        "rain_3h": 0.0, "snow_1h": 0.0, "weather_id": 501, "sunrise": 0, "sunset": 0, "city": "Seville", "aqi": 2,
        "pm2_5": 7.1, "o3": 60.0, "no2": 0.0,
    }
    assert {k: row[k] for k in want} == want


def test_documents_without_coordinates_never_match(spark):
    w = spark.createDataFrame([(json.dumps({**WEATHER, "coord": {}}),)], "weather_doc string")
    a = spark.createDataFrame([(json.dumps({**AIR, "coord": {}}),)], "air_doc string")
    parsed = readings.parse_documents(w, air=None), a.withColumn("air_doc", F.from_json("air_doc", schemas.AIR))
    assert readings.flatten_readings(*parsed).count() == 0


def test_sample_reading(spark):
    row = readings.sample_reading(spark).first()
    assert (row["temperature"], row["city"], row["weather_id"]) == (28.4, "Sevilla", 800)


def test_payloads_of_drifting_pages(spark, tmp_path):
    old = 'x\n<script>\nconst CLIMATE = {\n "city": "Seville", "date": "2026-04-25", "temp_c": 23.81, "palette": {"dark": [30.0, 34.2]}, "day_type": "stable"\n};\nconst x = CLIMATE.city;'
    new = 'y<script>\nconst C = {"city": "Seville", "hour": 21, "temp_c": 24.06, "dominant": "presion", "ml_ready": true};\nconst COMP = f();'
    for name, text in {"a.html": old, "b.html": new, "c.html": "<p>nothing</p>"}.items():
        (tmp_path / name).write_text(text)
    rows = {r["page"]: r for r in payload.extract_payloads(payload.read_pages(spark, str(tmp_path))).collect()}
    assert set(rows) == {"a.html", "b.html"}
    assert (rows["a.html"]["day_type"], rows["a.html"]["hour"], rows["a.html"]["temp_c"]) == ("stable", None, 23.81)
    assert (rows["b.html"]["dominant"], rows["b.html"]["ml_ready"]) == ("presion", True)
