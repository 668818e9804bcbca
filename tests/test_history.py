"""Keyed history, the daily table of known readings, archive entries."""

import datetime as dt
import json

import pytest

from skyloom.operators import daily, features, history
from skyloom.sources import tables
from skyloom.session import work_path

# Invented readings with round numbers, so that the expected day can be worked out by hand.
RAW = """datetime,date,hour,temperature,pressure,wind_speed,humidity,clouds,pm2_5,rain_1h
2031-03-04 06:00,2031-03-04,6,10.0,1000,2.0,40,0,1.0,
2031-03-04 11:30,2031-03-04,11,12.0,1002,4.0,50,20,2.0,0.5
2031-03-04 15:10,2031-03-04,15,16.0,1004,8.0,60,40,3.0,
2031-03-04 21:45,2031-03-04,21,14.0,1006,6.0,70,60,6.0,1.5
2031-03-09 07:20,2031-03-09,7,20.0,1015,1.0,30,80,4.0,0.0
2031-03-09 18:05,2031-03-09,18,22.0,1015,3.0,50,100,8.0,0.0
"""


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    path.write_text(RAW)
    from pyspark.sql import functions as F

    return tables.read_raw_csv(spark, str(path)).withColumn("site_id", F.lit(1))


def test_known_readings_give_the_known_days(raw):
    first, second = daily.daily_live(raw).orderBy("date").collect()
    want = {
        "n_readings": 4, "temp_c_max": 16.0, "temp_c_min": 10.0, "temp_c_mean": 13.0, "pressure_hpa_mean": 1003.0,
        "pressure_hpa_min": 1000, "wind_speed_max": 8.0, "wind_speed_mean": 5.0, "humidity_max": 70,
        "humidity_mean": 55.0, "precip_mm_sum": 2.0, "cloud_cover_mean": 0.3, "pm2_5_mean": 3.0,
    }
    for name, value in want.items():
        assert first[name] == pytest.approx(value, abs=1e-9), name
    assert (second["n_readings"], second["temp_c_mean"], second["cloud_cover_mean"]) == (2, pytest.approx(21), pytest.approx(0.9))


def test_touched_days_only(raw):
    touched = raw.filter("date = '2031-03-09'")
    assert [str(r["date"]) for r in daily.daily_live(raw, touched).collect()] == ["2031-03-09"]


def test_live_features_use_partial_history(raw):
    row = features.live_features(daily.daily_live(raw)).first()
    assert row["temp_c_max_ma7"] == pytest.approx((16 + 22) / 2)
    assert row["temp_c_max_lag1"] == 16.0 and row["temp_c_max_lag2"] is None
    assert row["temp_grad"] == pytest.approx(6)
    assert row["pressure_norm"] == pytest.approx(0.4)


def test_status(raw):
    row = daily.history_status(raw, dt.date(2031, 3, 9)).withColumn("text", daily.status_text()).first()
    assert (row["days"], row["readings_today"], row["status"], row["days_missing"]) == (2, 2, "partial_rolling", 5)
    assert row["text"] == "2 días (2/3 lecturas hoy) — faltan 5 para rolling real"


def test_sites_without_readings_are_empty(spark, raw):
    sites = spark.createDataFrame([(1,), (2,)], "site_id int")
    rows = daily.history_status(raw, dt.date(2031, 3, 9), sites=sites).withColumn("text", daily.status_text()).collect()
    found = {r["site_id"]: (r["days"], r["status"], r["text"]) for r in rows}
    assert found[1][:2] == (2, "partial_rolling")
    assert found[2] == (0, "empty", "sin días aún (0/3 lecturas hoy)")


def test_upsert_prefers_new_rows_and_append_replaces_keys(spark):
    schema = "site_id int, date date, hour int, seq int, v string"
    d = dt.date(2024, 1, 1)
    old = spark.createDataFrame([(1, d, 8, 9, "old"), (1, d, 9, 1, "kept")], schema)
    new = spark.createDataFrame([(1, d, 8, 2, "second"), (1, d, 8, 1, "first"), (2, d, 8, 1, "other")], schema)
    merged = history.upsert(old, new, ["site_id", "date", "hour"], ["seq"])
    assert sorted(r["v"] for r in merged.collect()) == ["kept", "other", "second"]
    appended = history.append_new(old, new, ["site_id", "date", "hour"])
    assert sorted(r["v"] for r in appended.collect()) == ["first", "kept", "other", "second"]


def test_partition_overwrite_touches_only_given_days(spark):
    path = work_path(spark, "test")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tables.write_partitioned(spark.createDataFrame([(d1, 1), (d2, 2)], "date date, v int"), path)
    tables.write_partitioned(spark.createDataFrame([(d2, 3)], "date date, v int"), path, sort=["v"])
    assert sorted(r["v"] for r in tables.read_partitioned(spark, path).collect()) == [1, 3]


def test_one_new_day_keeps_the_rest_of_the_year(spark):
    path, grid = work_path(spark, "features"), work_path(spark, "grid-days")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    two = spark.createDataFrame([(1, d, float(d.day)) for d in days[:2]], "site_id int, date date, v double")
    tables.write_features(two, path)
    tables.write_features(spark.createDataFrame([(1, days[2], 3.0), (1, days[1], 9.0)], two.schema), path)
    assert sorted(r["v"] for r in tables.read_features(spark, path).select("v").collect()) == [1.0, 3.0, 9.0]
    assert "day" not in tables.read_features(spark, path).columns
    for hour, day in ((12, 1), (13, 2), (14, 2)):
        rows = [(dt.datetime(2024, 1, day, hour), float(hour))]
        tables.write_grid(spark.createDataFrame(rows, "valid_time timestamp, v double"), grid)
    assert sorted(r["v"] for r in tables.read_grid(spark, grid).collect()) == [12.0, 14.0]


def test_archive_array_and_lines(spark, tmp_path):
    entry = {"date": "2031-07-01", "hour": 12, "city": "Port Example", "dominant": "presion", "risk_score": 0.049, "ml_ready": True}
    path = tmp_path / "archive.json"
    path.write_text(json.dumps([entry, {**entry, "hour": 20}], indent=2))
    kept = tables.read_archive(spark, str(path), multiline=True)
    assert kept.count() == 2 and kept.first()["dominant2"] is None
    out = work_path(spark, "archive")
    tables.write_archive(kept, out)
    assert [r["hour"] for r in history.newest_first(tables.read_archive(spark, out)).collect()] == [20, 12]


def test_grid_years_are_pruned(spark):
    path = work_path(spark, "grid")
    rows = [(dt.datetime(y, 6, 1, 12), 37.0, -6.0, float(y)) for y in (1940, 1990, 2010, 2024)]
    tables.write_grid(spark.createDataFrame(rows, "valid_time timestamp, latitude double, longitude double, t2m double"), path)
    recent = tables.read_grid(spark, path, years=range(2000, 2100))
    assert sorted(r["t2m"] for r in recent.collect()) == [2010.0, 2024.0]
    assert "PartitionFilters: [isnotnull(year" in recent._jdf.queryExecution().toString() or "year" in recent._jdf.queryExecution().toString().split("PartitionFilters")[1][:80]
    both = tables.union_periods(tables.read_grid(spark, path), [(1940, 1990), (2010, 2024)], "valid_time")
    assert both.count() == 4
