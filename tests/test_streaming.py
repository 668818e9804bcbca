"""Streams over many small files equal their batch twins, also after a replay."""

import pytest
from pyspark.sql import functions as F

from skyloom.operators import daily, history
from skyloom.plans import bridge as B
from skyloom.session import work_path
from skyloom.streaming import history as stream


@pytest.fixture(scope="module")
def landed(spark, sf):
    """Events in five files whose order is unrelated to time, so most batches bring late readings."""
    path = work_path(spark, "landed")
    B.table(spark, sf, "events").repartition(5, "event_id").write.parquet(path)
    return path


def _stream(spark, sf, path):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return B.as_obs(stream.ingest(spark, path, schema, files_per_batch=1))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_many_batches_equal_one(spark, sf, landed):
    store = stream.History(work_path(spark, "history"))
    query = stream.status_stream(_stream(spark, sf, landed), store)
    query.awaitTermination()
    obs = B.obs(spark, sf)
    cols = ["site_id", "date", "hour", "event_id", "temperature"]
    twin = history.latest(obs, stream.KEYS, stream.SEQ)
    assert _same(stream.readings(spark, store).select(*cols), twin.select(*cols))
    shown = ["site_id", "date", "n_readings", "temp_c_max", F.round("humidity_mean", 9).alias("h")]
    assert _same(stream.days(spark, store).select(*shown), daily.daily_live(twin).select(*shown))
    live = stream.table(spark, store, "live", ["site_id"])
    days = daily.daily_live(twin).groupBy("site_id").agg(F.count(F.lit(1)).alias("days"))
    assert _same(live.select("site_id", "days"), days)
    batches = spark.read.parquet(store.folder("raw")).select("batch_id").distinct().count()
    assert batches == 5

    # replaying the last batch changes nothing
    before = stream.readings(spark, store).count()
    last = B.as_obs(B.table(spark, sf, "events")).filter("event_id < 50")
    for _ in range(2):
        stream.upsert_batch(last, 99, store)
        stream.refresh_days(last, 99, store)
    assert stream.readings(spark, store).count() == before
    assert _same(stream.days(spark, store).select(*shown), daily.daily_live(twin).select(*shown))

    fresh = stream.History(work_path(spark, "compacted"))
    stream.compact(spark, store, fresh)
    assert _same(stream.readings(spark, fresh).select(*cols), twin.select(*cols))
    assert _same(stream.days(spark, fresh).select(*shown), daily.daily_live(twin).select(*shown))

    # streaming on after the compaction loses nothing: three readings arrive again
    some = work_path(spark, "again")
    B.table(spark, sf, "events").filter("event_id < 3").coalesce(1).write.parquet(some)
    stream.status_stream(_stream(spark, sf, some), fresh).awaitTermination()
    assert _same(stream.readings(spark, fresh).select(*cols), twin.select(*cols))
    assert _same(stream.days(spark, fresh).select(*shown), daily.daily_live(twin).select(*shown))
    assert stream.table(spark, fresh, "live", ["site_id"]).count() == live.count()


def _land(events, path, parts):
    """Each part in a file of its own, in this order."""
    for k, part in enumerate(parts):
        events.where(part).coalesce(1).write.parquet(f"{path}/part={k}")
    return f"{path}/*"


def _daily(spark, sf, source, late):
    store = stream.History(work_path(spark, "daily"))
    stream.daily_stream(_stream(spark, sf, source), store, late=late).awaitTermination()
    return stream.days(spark, store).select("site_id", "date", "n_readings", "temp_c_max", F.round("humidity_mean", 9).alias("h"))


def test_late_readings_can_be_dropped(spark, sf):
    events = B.table(spark, sf, "events")
    early, late = F.col("ts") < "2024-01-05", F.col("ts") >= "2024-01-20"
    some = F.col("event_id") % 3 == 0
    source = _land(events, work_path(spark, "ordered"), [early & ~some, late & ~some, some])
    limit = events.where(late & ~some).agg(F.max("ts") - F.expr("INTERVAL 1 DAY")).first()[0]
    kept = B.as_obs(events.where((early | late) & ~some | some & (F.col("ts") >= F.lit(limit))))
    twin = daily.daily_live(history.latest(kept, stream.KEYS, stream.SEQ)).select(
        "site_id", "date", "n_readings", "temp_c_max", F.round("humidity_mean", 9).alias("h"))
    assert 0 < events.where(some & (F.col("ts") >= F.lit(limit))).count() < events.where(some).count()
    assert _same(_daily(spark, sf, source, "drop"), twin)
    with pytest.raises(ValueError):
        stream.daily_stream(_stream(spark, sf, source), stream.History(work_path(spark, "x")), late="maybe")


def test_policies_agree_where_nothing_is_late(spark, sf):
    events = B.table(spark, sf, "events")
    day = F.dayofmonth("ts")
    source = _land(events, work_path(spark, "timely"), [day <= 10, (day > 10) & (day <= 20), day > 20])
    assert _same(_daily(spark, sf, source, "drop"), _daily(spark, sf, source, "recompute"))


def test_replayed_batch_sees_its_own_limit(spark, sf):
    events = B.obs(spark, sf)
    store = stream.History(work_path(spark, "limit"))
    first, second = events.where("ts >= '2024-01-20'"), events.where("ts < '2024-01-20'")
    assert stream.on_time(first, 0, store, "1 day").count() == first.count()
    assert stream.on_time(second, 1, store, "1 day").count() == 0
    assert stream.on_time(first, 0, store, "1 day").count() == first.count()
    assert stream.on_time(second, 1, store, "1 day").count() == 0


def test_late_day_reaches_the_days_after_it(spark):
    """A late day changes itself and ``REACH`` rows on, of its own site only."""
    known = spark.range(1, 21).select(
        F.lit(1).alias("site_id"), F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("date"))
    known = known.unionAll(known.withColumn("site_id", F.lit(2)))
    measures = ("temp_c_max", "temp_c_min", "temp_c_mean", "pressure_hpa_mean", "pressure_hpa_min", "wind_speed_max",
                "wind_speed_mean", "humidity_max", "humidity_mean", "precip_mm_sum", "cloud_cover_mean")
    known = known.withColumns({c: F.dayofmonth("date").cast("double") for c in measures})
    touched = spark.sql("SELECT 1 AS site_id, DATE '2024-01-05' AS date")
    got = sorted((r["site_id"], r["date"].day) for r in stream.depending_days(known, touched).collect())
    assert got == [(1, d) for d in range(5, 5 + stream.REACH + 1)]
    # what it leaves out does not change with the day
    other = known.withColumn("temp_c_max", F.when((F.col("site_id") == 1) & (F.dayofmonth("date") == 5), 99.0).otherwise(F.col("temp_c_max")))
    from skyloom.operators import features
    before, after = features.live_history(known), features.live_history(other)
    changed = after.exceptAll(before).select("site_id", F.dayofmonth("date").alias("d")).collect()
    assert {(r["site_id"], r["d"]) for r in changed} <= {(1, d) for d in range(5, 5 + stream.REACH + 1)}
    assert (1, 5 + stream.REACH) in {(r["site_id"], r["d"]) for r in changed}


def test_closest_air_document_of_a_reading_stays(spark):
    """Two air documents lie in the bound, one outside, one elsewhere; documents without coordinates match nothing."""
    import json

    def weather(lat, dt, name):
        return json.dumps({"coord": {"lat": lat, "lon": 1.0}, "main": {"temp": 1.0, "pressure": 1000}, "name": name, "dt": dt})

    def air(lat, dt, pm):
        return json.dumps({"coord": {"lat": lat, "lon": 1.0}, "list": [{"main": {"aqi": 1}, "components": {"pm2_5": pm}, "dt": dt}]})

    at = 1_706_000_000
    folders = work_path(spark, "w"), work_path(spark, "a")
    rows = ([weather(5.0, at, "x"), weather(None, at, "y"), weather(6.0, at, "z")],
            [air(5.0, at - 600, 2.0), air(5.0, at - 60, 3.0), air(5.0, at - 7200, 4.0), air(5.0, at + 60, 5.0), air(None, at, 6.0)])
    for folder, lines in zip(folders, rows):
        spark.createDataFrame([(r,) for r in lines], "value string").coalesce(1).write.text(folder)
    store = stream.History(work_path(spark, "s"), keys=("city", "ts"), seq=("nearest",))
    landed = stream.ingest_documents(spark, *folders).withColumn("nearest", -F.col("air_gap"))
    stream.upsert_stream(landed, store).awaitTermination()
    (row,) = stream.readings(spark, store).collect()
    assert (row["city"], row["pm2_5"], row["air_gap"], row["visibility"], row["hour"]) == ("x", 3.0, 60, 10_000, 9)


def test_documents_land_in_several_files_per_batch(spark, sf, monkeypatch):
    """A landing is written by several tasks, its files in no order of time, and still no document is late."""
    import glob

    from skyloom.plans import encode_queries

    places = []
    monkeypatch.setattr(encode_queries, "work_path", lambda *a: places.append(work_path(*a)) or places[-1])
    for key, value in (("spark.sql.files.maxPartitionBytes", "2k"), ("spark.sql.files.openCostInBytes", "1")):
        spark.conf.set(key, value)
    try:
        got = {r["event_id"]: r["aqi"] for r in encode_queries.t1_stream_json(spark, sf).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {r["event_id"]: r["user_id"] % 5 + 1 for r in B.table(spark, sf, "events").collect()}
    landed = [glob.glob(f"{p}/slice={k}/part-*") for p in places if "weather-" in p for k in range(encode_queries._LANDINGS)]
    assert len(landed) == encode_queries._LANDINGS and all(len(files) > 1 for files in landed)


def test_archive_days_land_in_several_files_per_batch(spark, sf, monkeypatch):
    """A turn of days is written by several tasks and still is one batch: the archive has every key once."""
    import glob

    from skyloom.ml import forest
    from skyloom.plans import flows, model_queries

    model = forest.fit_forest(flows.forest_features(B.readings(spark, sf)).cache(), model_queries.COLS, trees=2, depth=2)
    places = []
    monkeypatch.setattr(model_queries, "work_path", lambda *a: places.append(work_path(*a)) or places[-1])
    monkeypatch.setattr(B, "table", lambda s, d, name: s.read.parquet(f"{d}/{name}.parquet").repartition(3))
    current, store = model_queries._archived(spark, sf, model)
    landed = [glob.glob(f"{p}/turn={k}/part-*") for p in places if "landed-" in p for k in range(model_queries._LAND)]
    assert len(landed) == model_queries._LAND and all(len(files) == 3 for files in landed)
    assert current.count() == B.obs(spark, sf).select("site_id", "date", "hour").distinct().count()
    batches = spark.read.parquet(store.folder("raw")).select("batch_id").distinct().count()
    assert batches == model_queries._LAND
