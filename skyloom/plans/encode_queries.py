"""Queries over single readings: physics, encodings, labels, text (P, X, K4-K5, S1, S9, S13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import constants as K
from skyloom.functions import physics, seeds
from skyloom.functions import visual as V
from skyloom.functions.calendar import asset_path, local_time, season
from skyloom.functions.numbers import normalize
from skyloom.ml.scoring import point_estimate
from skyloom.operators import encode, history, labels, series
from skyloom.plans import bridge as B
from skyloom.plans import flows
from skyloom.plans.registry import dec, query, r6, rounded
from skyloom.session import durable, work_path
from skyloom.sources import payload, readings as R
from skyloom.streaming import history as stream


@query("p_physics", f"""WITH {B.READINGS}, {B.PHYSICAL}
SELECT event_id, {r6('temp_c', 'dewpoint_c', 'pressure_hpa', 'wind_speed')},
  round(greatest(0e0, least(100e0, 100e0 * ratio)), 6) AS humidity,
  round(100e0 * greatest(0e0, least(100e0, ratio)), 6) AS humidity_ratio,
  round(temp_c + 2.5e0, 6) AS temp_corrected FROM moist""")
def p_physics(spark: SparkSession, sf: str) -> DataFrame:
    df = series.to_physical(B.readings(spark, sf))
    df = df.withColumns({
        "humidity_ratio": physics.humidity("dewpoint_c", "temp_c", "ratio"),
        "temp_corrected": F.col("temp_c") + F.lit(K.TEMPERATURE_BIAS),
    })
    return rounded(df.select("event_id", "temp_c", "dewpoint_c", "pressure_hpa", "wind_speed", "humidity",
                             "humidity_ratio", "temp_corrected"))


@query("p11_normalize", f"""WITH {B.VISUAL}
SELECT event_id, round(temperature_norm, 6) AS temperature_norm, round(pn, 6) AS pressure_norm,
  round(fragmentation, 6) AS pm2_5_norm, round(hn, 6) AS humidity_norm, round(wind_energy, 6) AS wind_speed_norm,
  round(cn, 6) AS clouds_norm, round(rn, 6) AS rain_1h_norm FROM visual""")
def p11_normalize(spark, sf):
    return rounded(B.obs(spark, sf).select("event_id", *[c.alias(n) for n, c in V.norms().items()]))


# Colour stops of the temperature ramp (position, red, green, blue).
_RAMP = """stops(pos, red, green, blue) AS (VALUES
  (0.00e0, 28, 58, 110), (0.25e0, 45, 85, 140), (0.50e0, 90, 70, 50), (0.75e0, 160, 90, 30), (1.00e0, 190, 110, 20)),
pieces AS (SELECT pos, red, green, blue, lead(pos) OVER w AS pos2, lead(red) OVER w AS red2, lead(green) OVER w AS green2,
  lead(blue) OVER w AS blue2 FROM stops WINDOW w AS (ORDER BY pos))"""


@query("p12_color_ramp", f"""WITH {_RAMP},
t AS (SELECT event_id, greatest(0e0, least(1e0, (46e0 * value / (value + 4e0)) / 46e0)) AS n FROM events),
u AS (SELECT event_id, p.*, (n - pos) / (pos2 - pos) AS f FROM t JOIN pieces p
  ON n >= pos AND (n < pos2 OR pos2 = 1e0 AND n = 1e0))
SELECT event_id, CAST(trunc(red + (red2 - red) * f) AS INTEGER) AS red,
  CAST(trunc(green + (green2 - green) * f) AS INTEGER) AS green, CAST(trunc(blue + (blue2 - blue) * f) AS INTEGER) AS blue
FROM u""")
def p12_color_ramp(spark, sf):
    v = F.col("value")
    warm = B.table(spark, sf, "events").withColumn("n", normalize(F.lit(46.0) * v / (v + 4.0), 0, 46))
    color = V.base_color("n")
    return warm.select("event_id", color[0].alias("red"), color[1].alias("green"), color[2].alias("blue"))


@query("p13_wind_vector", f"""WITH {B.VISUAL}
SELECT event_id, {r6('wind_dx', 'wind_dy')} FROM visual""")
def p13_wind_vector(spark, sf):
    dx, dy = V.wind_vector("wind_deg")
    return rounded(B.obs(spark, sf).select("event_id", dx.alias("wind_dx"), dy.alias("wind_dy")))


@query("p14_visual_scalars", f"""WITH {B.VISUAL}
SELECT event_id, {r6('density', 'fragmentation', 'wind_energy')}, num_layers, fragment_count, opacity_base, veil_opacity,
  stroke_length, stroke_width, bg_darkness, {dec('rn', 3)} AS rain_norm, is_raining, weather_group FROM visual""")
def p14_visual_scalars(spark, sf):
    return rounded(encode.visual_params(B.obs(spark, sf)).select(
        "event_id", "density", "fragmentation", "wind_energy", "num_layers", "fragment_count", "opacity_base",
        "veil_opacity", "stroke_length", "stroke_width", "bg_darkness", "rain_norm", "is_raining", "weather_group"))


_POINT = {
    "temp_c_max": "temperature + 3e0", "temp_c_min": "temperature - 5e0", "temp_c_mean": "temperature",
    "pressure_hpa_mean": "CAST(pressure AS DOUBLE)", "pressure_hpa_min": "pressure - 2e0",
    "wind_speed_max": "wind_speed * 1.5e0", "wind_speed_mean": "wind_speed",
    "humidity_max": "least(100e0, humidity + 10e0)", "humidity_mean": "CAST(humidity AS DOUBLE)",
    "precip_mm_sum": "CASE WHEN clouds > 70 THEN 5e0 ELSE 0e0 END", "cloud_cover_mean": "clouds / 100e0",
}
_POINT_REST = {
    "temp_grad": "0e0", "pressure_grad": "0e0",
    "sin_doy": "sin(2 * pi() * dayofyear(date) / 365e0)", "cos_doy": "cos(2 * pi() * dayofyear(date) / 365e0)",
    "temp_range": "(temperature + 3e0) - (temperature - 5e0)", "heat_intensity": "(temperature + 3e0) - temperature",
    "pressure_deficit": "0e0", "humidity_range": "least(100e0, humidity + 10e0) - humidity",
    "wind_spike": "wind_speed * 1.5e0 - wind_speed",
    "dry_index": "((temperature + 3e0) - (temperature - 5e0)) * (100e0 - humidity)",
    "pressure_norm": "(pressure - 1013e0) / 5e0",
}


def _point_sql() -> str:
    made = dict(_POINT)
    for c in K.ROLLED:
        made |= {f"{c}_ma3": _POINT[c], f"{c}_ma7": _POINT[c]}
    for k in (1, 2, 3):
        made |= {f"{c}_lag{k}": "0e0" if c == "precip_mm_sum" else _POINT[c] for c in K.LAGGED}
    made |= _POINT_REST
    return ", ".join(f"round({x}, 6) + 0e0 AS {n}" for n, x in made.items())


@query("p18_point_estimate", f"WITH {B.OBS} SELECT event_id, site_id, date, {_point_sql()} FROM obs")
def p18_point_estimate(spark, sf):
    return rounded(point_estimate(B.obs(spark, sf), keep=("event_id", "site_id", "date")))


@query("p19_archive_entry", f"""WITH {B.DOMINANT}
SELECT event_id, date, hour, city,
  'output/sky_' || replace(city, ' ', '_') || '_' || strftime(date, '%Y-%m-%d') || '_' || lpad(CAST(hour AS VARCHAR), 2, '0') || 'h.png' AS image_path,
  {dec('temperature', 1)} AS temp_c, pressure, {dec('wind_speed', 1)} AS wind_speed, wind_dir, humidity, clouds,
  {dec('pm2_5', 1)} AS pm25, {dec('temperature_norm', 3)} AS temp_norm, {dec('density', 3)} AS pressure_norm,
  {dec('wind_energy', 3)} AS wind_energy, {dec('veil_opacity / 80e0', 3)} AS humidity_norm,
  {dec('clouds / 100e0', 3)} AS cloud_norm, {dec('fragmentation', 3)} AS pm_norm,
  dominant, {dec('dominant_strength', 3)} AS dominant_strength, dominant2, ml_ready,
  {dec('risk_score', 3)} AS risk_score, event_type FROM dominant""")
def p19_archive_entry(spark, sf):
    shown = flows.encoded(B.obs(spark, sf)).withColumn("image_path", asset_path("city", "date", "hour", "sky"))
    return history.archive_entries(shown, ["event_id"])


_DOC_COLUMNS = ["event_id", "temperature", "temp_min", "temp_max", "feels_like", "humidity", "pressure", "sea_level",
                "grnd_level", "wind_speed", "wind_deg", "wind_gust", "clouds", "visibility", "rain_1h", "rain_3h",
                "snow_1h", "weather_id", "weather_main", "weather_desc", "sunrise", "sunset", "city", "lat", "lon",
                "aqi", "pm2_5", "pm10", "no2", "o3", "co", "so2", "nh3"]


def documents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Landed JSON texts: a weather document per event, an air document per coordinate pair."""
    o, e = B.obs(spark, sf), F.col("event_id")

    def maybe(test, value):
        return F.when(test, value)

    lat, lon = (F.col("site_id") % 90).cast("double"), (F.col("site_id") / 10.0)
    coord = F.struct(lat.alias("lat"), lon.alias("lon"))
    rain = F.when(F.col("rain_1h") > 0, F.struct(
        F.col("rain_1h").alias("1h"), maybe(e % 8 == 0, F.col("rain_1h") * 2.0).alias("3h")))
    weather = F.struct(
        coord.alias("coord"),
        F.array(F.struct(F.col("weather_id").alias("id"), V.weather_group("weather_id").alias("main"),
                         F.col("kind").alias("description"))).alias("weather"),
        F.struct(
            F.col("temperature").alias("temp"), (F.col("temperature") - 2.0).alias("temp_min"),
            (F.col("temperature") + 2.0).alias("temp_max"),
            maybe(e % 3 == 0, F.col("temperature") + 1.0).alias("feels_like"), "humidity", "pressure",
            maybe(e % 5 == 0, F.col("pressure") + 1).alias("sea_level"),
            maybe(e % 7 == 0, F.col("pressure") - 1).alias("grnd_level")).alias("main"),
        F.struct(F.col("wind_speed").alias("speed"), F.col("wind_deg").alias("deg"),
                 maybe(e % 2 == 0, F.col("wind_speed") * 1.5).alias("gust")).alias("wind"),
        F.struct(F.col("clouds").alias("all")).alias("clouds"),
        maybe(e % 3 == 1, F.lit(5000)).alias("visibility"), rain.alias("rain"),
        F.struct(maybe(e % 2 == 1, F.lit(1700000000) + e).alias("sunrise")).alias("sys"),
        F.col("city").alias("name"),
    )
    air = F.struct(
        coord.alias("coord"),
        F.array(F.struct(
            F.struct((F.col("site_id") % 5 + 1).cast("int").alias("aqi")).alias("main"),
            F.struct((F.col("site_id") * 1.5).alias("pm2_5"), maybe(F.col("site_id") % 2 == 0, F.lit(3.5)).alias("no2")
                     ).alias("components"))).alias("list"),
    )
    sites = o.select("site_id").distinct()
    return (
        o.select("event_id", F.to_json(weather).alias("weather_doc")),
        sites.select(F.to_json(air).alias("air_doc")),
    )


_FLAT_SQL = f"""WITH {B.VISUAL}
SELECT event_id, round(temperature, 6) AS temperature, round(temperature - 2, 6) AS temp_min, round(temperature + 2, 6) AS temp_max,
  round(CASE WHEN event_id % 3 = 0 THEN temperature + 1 ELSE temperature END, 6) AS feels_like, humidity, pressure,
  CASE WHEN event_id % 5 = 0 THEN pressure + 1 ELSE pressure END AS sea_level,
  CASE WHEN event_id % 7 = 0 THEN pressure - 1 ELSE pressure END AS grnd_level,
  wind_speed, wind_deg, round(CASE WHEN event_id % 2 = 0 THEN wind_speed * 1.5e0 ELSE wind_speed END, 6) AS wind_gust,
  clouds, CAST(CASE WHEN event_id % 3 = 1 THEN 5000 ELSE 10000 END AS INTEGER) AS visibility, round(rain_1h, 6) AS rain_1h,
  round(CASE WHEN event_id % 8 = 0 THEN rain_1h * 2 ELSE 0e0 END, 6) AS rain_3h, 0e0 AS snow_1h, weather_id,
  weather_group AS weather_main, kind AS weather_desc,
  CAST(CASE WHEN event_id % 2 = 1 THEN 1700000000 + event_id ELSE 0 END AS BIGINT) AS sunrise, CAST(0 AS BIGINT) AS sunset,
  city, CAST(site_id % 90 AS DOUBLE) AS lat, site_id / 10e0 AS lon, CAST(site_id % 5 + 1 AS INTEGER) AS aqi,
  round(site_id * 1.5e0, 6) AS pm2_5, 0e0 AS pm10, CASE WHEN site_id % 2 = 0 THEN 3.5e0 ELSE 0e0 END AS no2,
  0e0 AS o3, 0e0 AS co, 0e0 AS so2, 0e0 AS nh3 FROM visual"""


@query("s1_flatten_json", _FLAT_SQL)
def s1_flatten_json(spark, sf):
    weather, air = documents(spark, sf)
    flat = R.flatten_readings(
        R.parse_documents(weather, air=None), air.withColumn("air_doc", F.from_json("air_doc", R.schemas.AIR)),
        keep=("event_id",))
    return rounded(flat.select(*_DOC_COLUMNS))


_LANDINGS = 4
_FILES = 1 << 30  # a batch takes a landing whole: its files are in no order of time


def _land(spark, sf):
    """JSON lines that are to land: weather documents, and an air document per coordinate pair and hour with readings.

    Both tables name the landing of each document, ``slice``; the landings are in the order of time.
    """
    weather, air = documents(spark, sf)
    seconds = B.obs(spark, sf).select("event_id", "site_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"))
    weather = weather.join(seconds, "event_id").select(
        "dt", F.concat(F.expr("substring(weather_doc, 1, length(weather_doc) - 1)"), F.lit(',"dt":'), F.col("dt").cast("string"),
                       F.lit(',"event_id":'), F.col("event_id").cast("string"), F.lit("}")).alias("value"))
    hours = seconds.select(
        (F.col("site_id") % 90).cast("double").alias("lat"), (F.col("site_id") / 10.0).alias("lon"),
        (F.floor(F.col("dt") / 3600) * 3600).alias("dt")).distinct()
    parsed = air.withColumn("doc", F.from_json("air_doc", R.schemas.AIR)).select(
        F.col("doc.coord.lat").alias("lat"), F.col("doc.coord.lon").alias("lon"), "air_doc")
    air = hours.join(parsed, ["lat", "lon"]).select(
        "dt", F.regexp_replace("air_doc", r"\}\]\}$", F.concat(F.lit(',"dt":'), F.col("dt").cast("string"), F.lit("}]}"))).alias("value"))
    span = seconds.agg(F.min("dt").alias("a"), F.max("dt").alias("b")).first()
    step = (span["b"] - span["a"]) // _LANDINGS + 1
    slices = F.greatest(F.floor((F.col("dt") - F.lit(span["a"])) / F.lit(step)), F.lit(0)).alias("slice")
    return [durable(docs.select(slices, "value"), name) for docs, name in ((weather, "weather"), (air, "air"))]


@query("t1_stream_json", f"""WITH flat AS ({_FLAT_SQL}),
edges AS (SELECT event_id, ts, CAST(make_date(year(ts), 3, 31) AS DATE) AS m, CASE WHEN year(ts) <= 1995 THEN make_date(year(ts), 9, 30)
  ELSE make_date(year(ts), 10, 31) END AS o FROM events),
clock AS (SELECT event_id, ts + CASE WHEN ts >= CAST(m - CAST(dayofweek(m) AS INTEGER) AS TIMESTAMP) + INTERVAL 1 HOUR
  AND ts < CAST(o - CAST(dayofweek(o) AS INTEGER) AS TIMESTAMP) + INTERVAL 1 HOUR THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS here FROM edges)
SELECT flat.*, strftime(here, '%Y-%m-%d %H:%M') AS datetime, CAST(here AS DATE) AS date, CAST(hour(here) AS INTEGER) AS hour
FROM flat JOIN clock USING (event_id)""")
def t1_stream_json(spark, sf):
    """Both kinds of landed documents as streams, joined on coordinates and time, into the history."""
    kinds = _land(spark, sf)
    folders = work_path(spark, "weather"), work_path(spark, "air")
    store = stream.History(work_path(spark, "stream"), keys=("event_id",), seq=("nearest",))
    for k in range(_LANDINGS):  # each landing is as many files as its rows need, and the stream goes on with it
        for docs, folder in zip(kinds, folders):
            docs.where(F.col("slice") == k).select("value").write.text(f"{folder}/slice={k}")
        landed = stream.ingest_documents(
            spark, *[f"{f}/*" for f in folders], extra=(T.StructField("event_id", T.LongType()),), files_per_batch=_FILES)
        stream.upsert_stream(landed.withColumn("nearest", -F.col("air_gap")), store).awaitTermination()
    return rounded(stream.readings(spark, store).select(*_DOC_COLUMNS, "datetime", "date", "hour"))


@query("j2_site_join", """SELECT CAST(o_custkey % 25 AS INTEGER) AS nation_key, n_name AS site_name, r_name AS region_name,
  CAST(count(*) AS BIGINT) AS n_readings, round(avg(o_totalprice), 4) AS mean_value
FROM orders JOIN nation ON o_custkey % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""")
def j2_site_join(spark, sf):
    # readings collapse to one row per site before they meet the site dimension
    counts = B.table(spark, sf, "orders").groupBy((F.col("o_custkey") % 25).cast("int").alias("nation_key")).agg(
        F.count(F.lit(1)).alias("n_readings"), F.avg("o_totalprice").alias("mean_value"))
    places = B.table(spark, sf, "nation").join(
        B.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return counts.join(places, F.col("nation_key") == F.col("n_nationkey")).select(
        "nation_key", F.col("n_name").alias("site_name"), F.col("r_name").alias("region_name"), "n_readings",
        F.round("mean_value", 4).alias("mean_value"))


_PAYLOAD_SQL = f"""SELECT event_id, city, strftime(date, '%Y-%m-%d') AS date, hour, round(temperature, 6) AS temp_c, pressure,
  wind_speed, wind_dir, {dec('wind_dx', 3)} AS wind_dx, {dec('wind_dy', 3)} AS wind_dy, pm2_5 AS pm25, humidity, clouds,
  {dec('temperature_norm', 3)} AS temp_norm, {dec('density', 3)} AS pressure_norm, {dec('wind_energy', 3)} AS wind_energy,
  {dec('fragmentation', 3)} AS pm_norm, {dec('veil_opacity / 80e0', 3)} AS humidity_norm,
  {dec('clouds / 100e0', 3)} AS cloud_norm, {dec('rain_1h', 2)} AS rain_1h, {dec('rn', 3)} AS rain_norm, is_raining,
  weather_id, weather_group, dominant, {dec('dominant_strength', 3)} AS dominant_strength, dominant2,
  {dec('second_strength', 3)} AS dominant2_strength, {dec('risk_score', 3)} AS risk_score, event_type, ml_ready FROM dominant"""


@query("s9_payload_json", f"WITH {B.DOMINANT} {_PAYLOAD_SQL}")
def s9_payload_json(spark, sf):
    """Written as JSON text and parsed again, so both directions are checked."""
    texts = payload.payload_json(flows.encoded(B.obs(spark, sf)), keep=("event_id",))
    fields = list(payload.payload_columns())
    return rounded(payload.read_payload(texts).select("event_id", *fields))


@query("s13_page_payload", """SELECT page_id, regexp_extract(html, '<html[^>]*lang="([a-zA-Z-]+)"', 1) AS lang,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  CAST(nullif(regexp_extract(html, 'track\\((\\d+)\\)', 1), '') AS BIGINT) AS track FROM pages""")
def s13_page_payload(spark, sf):
    return payload.page_facts(B.table(spark, sf, "pages"))


@query("s13_recover_payload", f"WITH {B.DOMINANT}, shown AS ({_PAYLOAD_SQL}) SELECT s.* FROM shown s JOIN pages p ON p.page_id = s.event_id")
def s13_recover_payload(spark, sf):
    """Every page with its reading's payload embedded, as either version names it, and recovered from the text."""
    texts = payload.payload_json(flows.encoded(B.obs(spark, sf)), keep=("event_id",))
    name = F.when(F.col("event_id") % 2 == 0, "C").otherwise("CLIMATE")
    pages = B.table(spark, sf, "pages").join(texts, F.col("page_id") == F.col("event_id")).select("event_id", F.concat(
        "html", F.lit("<script>\nconst "), name, F.lit(" = "), "payload", F.lit(";\nconst after = {};</script>")).alias("html"))
    return rounded(payload.extract_payloads(pages).select("event_id", *payload.payload_columns()))


# ---------------------------------------------------------------- dates, labels
@query("x1_season", f"""WITH {B.OBS} SELECT event_id,
  round(sin(2 * pi() * dayofyear(date) / 365e0), 6) + 0e0 AS sin_doy, round(cos(2 * pi() * dayofyear(date) / 365e0), 6) + 0e0 AS cos_doy,
  round(sin(2 * pi() * dayofyear(date) / 365.25e0), 6) + 0e0 AS season_sin, round(cos(2 * pi() * dayofyear(date) / 365.25e0), 6) + 0e0 AS season_cos FROM obs""")
def x1_season(spark, sf):
    a, b = season("date", 365), season("date", 365.25)
    return rounded(B.obs(spark, sf).select(
        "event_id", a[0].alias("sin_doy"), a[1].alias("cos_doy"), b[0].alias("season_sin"), b[1].alias("season_cos")))


# the zone rule spelled out: summer time from the last Sunday of March to that of October (September up to 1995), 01:00 UTC
_LOCAL = """local AS (SELECT o_orderkey, o_orderdate + CAST(o_orderkey % 1440 AS INTEGER) * INTERVAL 1 MINUTE AS utc FROM orders),
edges AS (SELECT *, make_date(year(utc), 3, 31) AS m, CASE WHEN year(utc) <= 1995 THEN make_date(year(utc), 9, 30) ELSE make_date(year(utc), 10, 31) END AS o FROM local),
turns AS (SELECT *, CAST(m - CAST(dayofweek(m) AS INTEGER) AS TIMESTAMP) + INTERVAL 1 HOUR AS summer,
  CAST(o - CAST(dayofweek(o) AS INTEGER) AS TIMESTAMP) + INTERVAL 1 HOUR AS winter FROM edges),
clock AS (SELECT *, utc + CASE WHEN utc >= summer AND utc < winter THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS here FROM turns)"""


@query("x2_local_time", f"""WITH {_LOCAL} SELECT o_orderkey, strftime(here, '%Y-%m-%d %H:%M') AS datetime,
  CAST(here AS DATE) AS date, CAST(hour(here) AS INTEGER) AS hour FROM clock""")
def x2_local_time(spark, sf):
    orders = B.table(spark, sf, "orders")
    minute = F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    return local_time(orders.withColumn("ts", F.col("o_orderdate") + minute)).select(
        "o_orderkey", "datetime", "date", "hour")


@query("x3_asset_path", """SELECT event_id, 'output/sky_' || replace('site ' || user_id, ' ', '_') || '_' || strftime(ts, '%Y-%m-%d') || '_'
  || lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || 'h.png' AS path FROM events""")
def x3_asset_path(spark, sf):
    named = B.obs(spark, sf).withColumn("city", F.translate("city", "_", " "))
    return named.select("event_id", asset_path("city", "date", "hour", "sky").alias("path"))


@query("x4_compass", f"WITH {B.VISUAL} SELECT event_id, wind_deg, wind_dir FROM visual")
def x4_compass(spark, sf):
    return B.obs(spark, sf).select("event_id", "wind_deg", V.compass("wind_deg").alias("wind_dir"))


@query("x5_weather_group", f"WITH {B.VISUAL} SELECT event_id, weather_id, weather_group FROM visual")
def x5_weather_group(spark, sf):
    return B.obs(spark, sf).select("event_id", "weather_id", V.weather_group("weather_id").alias("weather_group"))


@query("x9_event_type", f"""WITH {B.OBS} SELECT event_id, CASE WHEN temperature + 3 >= 38 THEN 'heat' WHEN temperature - 5 <= 8 THEN 'cold'
  WHEN wind_speed * 1.5e0 >= 10 THEN 'wind' WHEN clouds > 70 AND humidity > 80 THEN 'rain' ELSE 'none' END AS event_type FROM obs""")
def x9_event_type(spark, sf):
    return B.obs(spark, sf).select("event_id", labels.event_type("reading").alias("event_type"))


@query("x10_event_type_hist", f"""WITH {B.DAILY_LIVE} SELECT site_id, date, CASE WHEN temp_c_max >= 38 THEN 'heat' WHEN temp_c_min <= 8 THEN 'cold'
  WHEN wind_speed_max >= 8 THEN 'wind' WHEN cloud_cover_mean * 100 > 70 AND humidity_mean > 80 THEN 'rain' ELSE 'none' END AS event_type FROM daily""")
def x10_event_type_hist(spark, sf):
    from skyloom.operators.daily import daily_live

    return daily_live(B.obs(spark, sf)).select("site_id", "date", labels.event_type("history").alias("event_type"))


@query("x11_decision", f"""WITH {B.SCORED} SELECT event_id, {dec('prob', 4)} AS prob, CASE WHEN prob >= 0.38e0 THEN 1 ELSE 0 END AS prediction,
  0.38e0 AS threshold, CASE WHEN prob >= 0.38e0 THEN 'EXTREMO ⚠' ELSE 'Normal ✓' END AS label_text FROM scored""")
def x11_decision(spark, sf):
    return labels.decision(B.scored(spark, sf), 0.38).select("event_id", "prob", "prediction", "threshold", "label_text")


# ---------------------------------------------------------------- dominance
@query("k4_dominant", f"""WITH {B.DOMINANT} SELECT event_id, dominant, {r6('dominant_strength')}, second, {r6('second_strength')} FROM dominant""")
def k4_dominant(spark, sf):
    return rounded(flows.encoded(B.obs(spark, sf)).select(
        "event_id", "dominant", "dominant_strength", "second", "second_strength"))


@query("k5_codominant", f"""WITH {B.DOMINANT} SELECT event_id, dominant2,
  round(CASE WHEN dominant2 IS NULL THEN 0e0 ELSE least(1e0, second_strength * 1.4e0) END, 6) AS boost FROM dominant""")
def k5_codominant(spark, sf):
    df = flows.encoded(B.obs(spark, sf))
    boost = F.when(F.col("dominant2").isNull(), F.lit(0.0)).otherwise(V.codominant_boost("second_strength"))
    return rounded(df.select("event_id", "dominant2", boost.alias("boost")))


@query("x28_scores_long", f"""WITH {B.DOMINANT}, shown AS (
  SELECT s.event_id, s.name, {dec('s.score', 3)} AS score, d.dominant, d.dominant2 FROM score_rows s JOIN dominant d USING (event_id))
SELECT event_id, name, score, CAST(floor(score * 100e0 + 0.5e0) AS INTEGER) AS percent, name = dominant AS is_dom,
  coalesce(name = dominant2, false) AS is_codom FROM shown""")
def x28_scores_long(spark, sf):
    return encode.scores_long(flows.encoded(B.obs(spark, sf)), ["event_id"])


# ---------------------------------------------------------------- colours
# Ground colour by temperature (up to this value: hue, saturation, lightness).
_TEMP_BAND = """WITH {obs}, bands(above, upto, h, s, l) AS (VALUES
  (-1e9, 5e0, 225e0, 70e0, 35e0), (5e0, 12e0, 200e0, 65e0, 38e0), (12e0, 18e0, 145e0, 60e0, 42e0),
  (18e0, 24e0, 55e0, 75e0, 52e0), (24e0, 30e0, 28e0, 80e0, 52e0), (30e0, 1e9, 5e0, 78e0, 48e0))
SELECT event_id, h, s, l FROM obs JOIN bands ON temperature > above AND temperature <= upto"""


@query("x12_temp_band", _TEMP_BAND.format(obs=B.OBS))
def x12_temp_band(spark, sf):
    return B.obs(spark, sf).select("event_id", V.temperature_hsl("temperature").alias("c")).select("event_id", "c.*")


# Ground colour by hour (from, before, hue, saturation, lightness) and place of the light by hour.
_HOUR = """hour_colours(from_hour, to_hour, gh, gs, gl) AS (VALUES
  (0, 5, 220e0, 18e0, 12e0), (5, 8, 28e0, 30e0, 72e0), (8, 12, 42e0, 18e0, 88e0),
  (12, 16, 200e0, 14e0, 90e0), (16, 20, 25e0, 28e0, 78e0), (20, 24, 230e0, 20e0, 18e0)),
hour_lights(from_light, to_light, lx, ly) AS (VALUES
  (0, 6, 0.5e0, 1.1e0), (6, 10, 0.1e0, 0.8e0), (10, 13, 0.55e0, -0.1e0),
  (13, 17, 0.9e0, 0.15e0), (17, 20, 0.85e0, 0.6e0), (20, 24, 0.4e0, 1.15e0)),
ground AS (SELECT * FROM {source}
  JOIN hour_colours ON hour >= from_hour AND hour < to_hour JOIN hour_lights ON hour >= from_light AND hour < to_light)"""


@query("x13_hour_band", f"""WITH {B.DOMINANT}, {_HOUR.format(source='dominant')} SELECT event_id, gh AS h, gs AS s, gl AS l, lx AS light_x, ly AS light_y,
  round(CASE WHEN dominant = 'viento' THEN 0.5e0 + cos(atan2(wind_dy, wind_dx)) * 0.4e0 ELSE lx END, 6) + 0e0 AS wind_x,
  round(CASE WHEN dominant = 'viento' THEN 0.5e0 + sin(atan2(wind_dy, wind_dx)) * 0.4e0 ELSE ly END, 6) + 0e0 AS wind_y FROM ground""")
def x13_hour_band(spark, sf):
    df = flows.encoded(B.obs(spark, sf)).withColumns({
        "c": V.hour_hsl("hour"), "p": V.light_position("hour"),
        "w": V.light_position("hour", "dominant", "wind_dx", "wind_dy")})
    return rounded(df.select("event_id", "c.h", "c.s", "c.l", F.col("p.x").alias("light_x"), F.col("p.y").alias("light_y"),
                             F.col("w.x").alias("wind_x"), F.col("w.y").alias("wind_y")))


# Tint of each dominant variable (hue, saturation, lightness).
_PALETTE = f"""{B.DOMINANT}, {_HOUR.format(source='dominant')},
tints(tint, th, ts_, tl) AS (VALUES
  ('temperatura', 28e0, 70e0, 52e0), ('viento', 215e0, 60e0, 48e0), ('humedad', 148e0, 55e0, 44e0),
  ('presion', 40e0, 50e0, 48e0), ('nubes', 210e0, 22e0, 60e0), ('pm25', 285e0, 45e0, 40e0)),
tinted AS (SELECT *, dominant_strength * 0.35e0 AS mix FROM ground JOIN tints ON dominant = tint),
palette AS (SELECT *, gh * (1 - mix) + th * mix AS h, gs * (1 - mix) + ts_ * mix * 0.3e0 AS s,
  gl * (1 - mix) + tl * mix * 0.2e0 AS l FROM tinted)"""


@query("x14_palette", f"WITH {_PALETTE} SELECT event_id, round(h, 9) AS h, round(s, 9) AS s, round(l, 9) AS l FROM palette")
def x14_palette(spark, sf):
    df = flows.encoded(B.obs(spark, sf)).withColumn("c", V.palette("hour", "dominant", "dominant_strength"))
    return rounded(df.select("event_id", "c.*"), 9)


@query("x15_variable_colours", f"""WITH {_PALETTE}, shown AS (SELECT event_id, l,
    veil_opacity / 80e0 AS hum, density AS pres, clouds / 100e0 AS cld, fragmentation AS pm, rn, wind_energy AS we FROM palette)
SELECT event_id, round(35 + hum * 50, 6) AS humidity_s, round(55 - hum * 25, 6) AS humidity_l,
  round(38 + pres * 38, 6) AS pressure_s, round(58 - pres * 22, 6) AS pressure_l,
  round(18 + cld * 22, 6) AS cloud_s, round(65 - cld * 30, 6) AS cloud_l,
  round(30 + pm * 50, 6) AS pm_s, round(52 - pm * 28, 6) AS pm_l,
  round(55 + {dec('rn', 3)} * 30, 6) AS rain_s, round(45 - {dec('rn', 3)} * 15, 6) AS rain_l,
  round(CASE WHEN l > 65 THEN 70 + we * 25 ELSE 45 + we * 40 END, 6) AS wind_s,
  round(CASE WHEN l > 65 THEN greatest(18e0, 42 - we * 28) ELSE least(78e0, 62 - we * 28) END, 6) AS wind_l FROM shown""".replace(
    f"55 + {dec('rn', 3)} * 30", f"55 + ({dec('rn', 3)}) * 30").replace(f"45 - {dec('rn', 3)} * 15", f"45 - ({dec('rn', 3)}) * 15"))
def x15_variable_colours(spark, sf):
    df = flows.encoded(B.obs(spark, sf)).withColumn("ground", V.palette("hour", "dominant", "dominant_strength"))
    made = {
        "humidity": V.variable_colour("humidity", F.col("veil_opacity") / K.VEIL),
        "pressure": V.variable_colour("pressure", "density"),
        "cloud": V.variable_colour("cloud", F.col("clouds") / 100.0),
        "pm": V.variable_colour("pm", "fragmentation"), "rain": V.variable_colour("rain", "rain_norm"),
        "wind": V.wind_colour("wind_energy", "ground.l"),
    }
    return rounded(df.select("event_id", *[c[f].alias(f"{n}_{f}") for n, c in made.items() for f in ("s", "l")]))


@query("x16_modifiers", f"""WITH {B.DOMINANT} SELECT event_id,
  round(CASE WHEN dominant = 'viento' THEN atan2(wind_dy, wind_dx) * 0.7e0 ELSE 0e0 END, 6) + 0e0 AS angle,
  round(CASE dominant WHEN 'temperatura' THEN 0.85e0 + dominant_strength * 0.35e0 WHEN 'viento' THEN 0.9e0 + dominant_strength * 0.2e0 ELSE 1e0 END, 6) AS scale,
  round(CASE WHEN dominant = 'humedad' THEN dominant_strength * 4 ELSE 0e0 END, 6) AS blur,
  round(CASE WHEN dominant = 'pm25' THEN dominant_strength ELSE 0e0 END, 6) AS noise,
  round(CASE WHEN dominant = 'nubes' THEN 1 - dominant_strength * 0.3e0 ELSE 1e0 END, 6) AS squish,
  round(CASE WHEN dominant = 'presion' THEN dominant_strength ELSE 0e0 END, 6) AS rigid FROM dominant""")
def x16_modifiers(spark, sf):
    df = flows.encoded(B.obs(spark, sf)).withColumn("m", V.modifiers("dominant", "dominant_strength", "wind_dx", "wind_dy"))
    return rounded(df.select("event_id", "m.*"))


@query("x17_layer_order", f"""WITH {B.DOMINANT}, layers AS (
  SELECT event_id, dominant, dominant2, name, place FROM dominant CROSS JOIN
    (VALUES ('presion', 1), ('nubes', 2), ('viento', 3), ('humedad', 4), ('pm25', 5), ('temperatura', 6)) t(name, place)),
others AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY place) AS rk FROM layers WHERE name <> coalesce(dominant2, '')),
placed AS (
  SELECT event_id, name, CASE WHEN name = dominant THEN 100e0 ELSE rk END AS pos FROM others
  UNION ALL SELECT event_id, dominant2, 4.5e0 FROM dominant WHERE dominant2 IS NOT NULL)
SELECT event_id, string_agg(name, ',' ORDER BY pos) AS layers FROM placed GROUP BY event_id""")
def x17_layer_order(spark, sf):
    order = V.layer_order("dominant", "dominant2")
    return flows.encoded(B.obs(spark, sf)).select("event_id", F.array_join(order, ",").alias("layers"))


@query("x18_rain_band", f"""WITH {B.VISUAL} SELECT event_id,
  CASE WHEN NOT is_raining THEN 'none' WHEN rain_1h < 0.5 THEN 'drizzle' WHEN rain_1h < 2.5 THEN 'light' WHEN rain_1h < 7.5 THEN 'moderate' ELSE 'heavy' END AS band,
  CASE WHEN NOT is_raining THEN '○' WHEN rain_1h < 0.5 THEN '·' WHEN rain_1h < 2.5 THEN '⁚' WHEN rain_1h < 7.5 THEN '⁘' ELSE '⁙' END AS symbol FROM visual""")
def x18_rain_band(spark, sf):
    df = encode.visual_params(B.obs(spark, sf))
    return df.select("event_id", V.rain_band("rain_1h", "is_raining").alias("band"),
                     V.rain_symbol("rain_1h", "is_raining").alias("symbol"))


@query("x19_risk_level", f"""WITH {B.OBS} SELECT event_id, CASE WHEN risk_score < 0.06 THEN 'SIN PRESENCIA' WHEN risk_score < 0.2 THEN 'LATENTE'
  WHEN risk_score < 0.25 THEN 'TENSIÓN INICIAL' WHEN risk_score < 0.5 THEN 'INTRUSIÓN LEVE' WHEN risk_score < 0.75 THEN 'INTRUSIÓN ALTA'
  WHEN risk_score < 0.85 THEN 'ALERTA' ELSE 'CRÍTICO' END AS level FROM obs""")
def x19_risk_level(spark, sf):
    return B.obs(spark, sf).select("event_id", V.risk_level("risk_score").alias("level"))


@query("x20_alarm_layers", f"""WITH {B.OBS}, a AS (SELECT *, ml_ready AND risk_score >= 0.06 AS alarm FROM obs)
SELECT event_id, concat_ws(',', CASE WHEN alarm THEN 'edge' END, CASE WHEN alarm AND risk_score > 0.2 THEN 'tint' END,
  CASE WHEN alarm AND risk_score > 0.25 THEN 'fracture' END, CASE WHEN alarm AND risk_score > 0.6 THEN 'inner_edge' END,
  CASE WHEN alarm AND risk_score > 0.75 THEN 'border' END, CASE WHEN alarm AND risk_score > 0.85 THEN 'focal' END) AS layers,
  CAST(floor(risk_score * 22) AS BIGINT) AS edges, CAST(floor(risk_score * 14) AS BIGINT) AS fractures, round(risk_score * 90, 6) AS depth FROM a""")
def x20_alarm_layers(spark, sf):
    df = B.obs(spark, sf).withColumn("c", V.risk_counts("risk_score"))
    return rounded(df.select("event_id", F.array_join(V.alarm_layers("risk_score", "ml_ready"), ",").alias("layers"), "c.*"))


@query("f8_alarms", f"""WITH {B.OBS} SELECT event_id, site_id, round(risk_score, 6) AS risk_score FROM obs WHERE ml_ready AND risk_score >= 0.06e0""")
def f8_alarms(spark, sf):
    return rounded(B.obs(spark, sf).filter(V.is_alarm("risk_score", "ml_ready")).select("event_id", "site_id", "risk_score"))


@query("x21_event_colour", f"""WITH {B.OBS} SELECT event_id,
  CAST(CASE event_type WHEN 'heat' THEN 8 WHEN 'cold' THEN 215 WHEN 'rain' THEN 200 WHEN 'wind' THEN 155 ELSE 45 END AS DOUBLE) AS h,
  CAST(CASE event_type WHEN 'heat' THEN 85 WHEN 'cold' THEN 78 WHEN 'rain' THEN 72 WHEN 'wind' THEN 62 ELSE 70 END AS DOUBLE) AS s,
  CAST(CASE event_type WHEN 'heat' THEN 50 WHEN 'cold' THEN 42 WHEN 'rain' THEN 40 WHEN 'wind' THEN 38 ELSE 46 END AS DOUBLE) AS l FROM obs""")
def x21_event_colour(spark, sf):
    return B.obs(spark, sf).select("event_id", V.event_hsl("event_type").alias("c")).select("event_id", "c.*")


@query("x22_bands", f"""WITH {B.DOMINANT}, t AS (SELECT *, veil_opacity / 80e0 AS hum, clouds / 100e0 AS cld, coalesce(dominant2, '') AS d2 FROM dominant)
SELECT event_id,
  CASE WHEN dominant = 'humedad' THEN CASE WHEN hum > 0.5 THEN 'dominant_halo' ELSE 'dominant' END
    WHEN d2 = 'humedad' THEN CASE WHEN hum > 0.55 THEN 'codominant_halo' ELSE 'codominant' END
    WHEN hum < 0.35 THEN 'low' WHEN hum < 0.65 THEN 'medium' ELSE 'high' END AS humidity_band,
  CASE WHEN dominant = 'viento' THEN CASE WHEN wind_energy < 0.3 THEN 'dominant_short' WHEN wind_energy < 0.6 THEN 'dominant_medium' ELSE 'dominant_long' END
    WHEN d2 = 'viento' THEN 'codominant' WHEN wind_energy < 0.2 THEN 'calm' WHEN wind_energy < 0.5 THEN 'moderate' ELSE 'strong' END AS wind_band,
  CASE WHEN dominant = 'presion' THEN CASE WHEN density > 0.5 THEN 'dominant_bands' ELSE 'dominant_fragments' END
    WHEN density < 0.4 THEN 'low' WHEN density < 0.65 THEN 'normal' ELSE 'high' END AS pressure_band,
  CASE WHEN dominant = 'temperatura' THEN 'dominant' WHEN d2 = 'temperatura' THEN 'codominant' ELSE 'base' END AS temperature_band,
  CASE WHEN dominant = 'nubes' THEN 'dominant' WHEN d2 = 'nubes' THEN 'codominant' WHEN cld < 0.2 THEN 'few' WHEN cld < 0.55 THEN 'medium' ELSE 'many' END AS cloud_band,
  CASE WHEN dominant = 'pm25' THEN 'dominant' WHEN d2 = 'pm25' THEN 'codominant' WHEN fragmentation < 0.15 THEN 'clean' WHEN fragmentation < 0.4 THEN 'moderate' ELSE 'high' END AS pm_band,
  CASE WHEN hum < 0.35 AND dominant <> 'humedad' AND d2 <> 'humedad' THEN 'triangle' ELSE 'oval' END AS shape FROM t""")
def x22_bands(spark, sf):
    """Also X30 (``shape``)."""
    df = flows.encoded(B.obs(spark, sf))
    bands = V.behaviour_bands("dominant", "dominant2")
    shape = V.humidity_shape(F.col("veil_opacity") / K.VEIL, "dominant", "dominant2")
    return df.select("event_id", *[c.alias(n) for n, c in bands.items()], shape.alias("shape"))


# ---------------------------------------------------------------- seeds
_SEED = """keys AS (SELECT event_id, strftime(ts, '%Y%m%d') || CAST(hour(ts) AS VARCHAR) || 'site_' || user_id AS k FROM events),
hashed AS (SELECT event_id, list_reduce(list_prepend(CAST(0 AS BIGINT), [CAST(unicode(c) AS BIGINT) FOR c IN string_split(k, '')]),
  lambda a, c: ((a * 31 + c + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648) AS h FROM keys),
seeded AS (SELECT event_id, CAST(CASE WHEN h = 0 THEN 99991 ELSE abs(h) END AS BIGINT) AS seed FROM hashed)"""


@query("x23_seed", f"WITH {_SEED} SELECT event_id, seed FROM seeded")
def x23_seed(spark, sf):
    return B.obs(spark, sf).select("event_id", seeds.seed("date", "hour", "city").alias("seed"))


def _draw_sql(count: int) -> str:
    steps = ["d0 AS (SELECT event_id, seed AS s0 FROM seeded)"]
    for i in range(1, count + 1):
        kept = ", ".join(["event_id"] + [f"s{j}" for j in range(i)])
        steps.append(f"a{i} AS (SELECT {kept}, xor(s{i-1}, (s{i-1} * 8192) % 4294967296) AS a FROM d{i-1})")
        steps.append(f"b{i} AS (SELECT {kept}, xor(a, a >> 17) AS b FROM a{i})")
        steps.append(f"d{i} AS (SELECT {kept}, xor(b, (b * 32) % 4294967296) AS s{i} FROM b{i})")
    shown = ", ".join(f"round(s{i} / 4294967296e0, 9) AS draw{i}" for i in range(1, count + 1))
    return f"WITH {_SEED}, {', '.join(steps)} SELECT event_id, {shown} FROM d{count}"


@query("x24_draws", _draw_sql(5))
def x24_draws(spark, sf):
    df = B.obs(spark, sf).withColumn("d", seeds.draws(seeds.seed("date", "hour", "city"), 5))
    return df.select("event_id", *[F.round(F.col("d")[i], 9).alias(f"draw{i + 1}") for i in range(5)])


# ---------------------------------------------------------------- text
# exact quarters are the only ties at one decimal; they go away from zero
@query("x25_display_line", f"""WITH {B.OBS} SELECT event_id,
  printf('%.1f', CASE WHEN temperature * 4 = floor(temperature * 4) THEN temperature + sign(temperature) * 0.01e0 ELSE temperature END) || '°C · ' || pressure || ' hPa · ' || printf('%.1f', wind_speed) || 'm/s · PM'
    || CAST(CAST(floor(pm2_5 + 0.5e0) AS BIGINT) AS VARCHAR) || ' · HR' || humidity || '%' AS line,
  strftime(date, '%Y-%m-%d') || ' · ' || hour || 'h · ' || upper(city) AS edition FROM obs""")
def x25_display_line(spark, sf):
    return B.obs(spark, sf).select("event_id", V.display_line().alias("line"),
                                   V.edition_line("city", "date", "hour").alias("edition"))


@query("x26_template", f"""WITH {B.OBS} SELECT event_id, '<title>' || city || '</title><h1>' || upper(city) || '</h1>' AS page FROM obs""")
def x26_template(spark, sf):
    text = F.lit("<title>__CITY__</title><h1>__CITY_UPPER__</h1>")
    return B.obs(spark, sf).select("event_id", V.fill_template(text, {"CITY": F.col("city"), "CITY_UPPER": F.upper("city")}).alias("page"))


@query("x27_json_default", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  coalesce(CAST(json_extract_string(props, '$.gust') AS DOUBLE), value) AS gust FROM events""")
def x27_json_default(spark, sf):
    parsed = F.from_json("props", "k int, gust double")
    return B.table(spark, sf, "events").withColumn("p", parsed).select(
        "event_id", "p.k", F.coalesce("p.gust", "value").alias("gust"))


@query("x29_lookups", f"""WITH {B.DOMINANT} SELECT event_id,
  CASE dominant WHEN 'temperatura' THEN 'TEMPERATURA DOMINA' WHEN 'viento' THEN 'VIENTO DOMINA' WHEN 'humedad' THEN 'HUMEDAD DOMINA'
    WHEN 'presion' THEN 'PRESIÓN DOMINA' WHEN 'nubes' THEN 'NUBES DOMINAN' ELSE 'CONTAMINACIÓN DOMINA' END
    || CASE WHEN dominant2 IS NULL THEN '' ELSE ' + ' || upper(dominant2) END AS header,
  CASE dominant WHEN 'temperatura' THEN '#e06020' WHEN 'viento' THEN '#3a80c0' WHEN 'humedad' THEN '#3a9060' WHEN 'presion' THEN '#c09040'
    WHEN 'nubes' THEN '#7090a0' ELSE '#9060a0' END AS colour,
  CASE event_type WHEN 'heat' THEN 'CALOR EXTREMO' WHEN 'cold' THEN 'FRÍO INTENSO' WHEN 'rain' THEN 'LLUVIA INTENSA' WHEN 'wind' THEN 'VIENTO FUERTE' ELSE 'EVENTO GENÉRICO' END AS event_name,
  CASE event_type WHEN 'heat' THEN '#d05020' WHEN 'cold' THEN '#3060b0' WHEN 'rain' THEN '#3070a0' WHEN 'wind' THEN '#309060' ELSE '#a08030' END AS event_colour,
  CASE weather_group WHEN 'storm' THEN 'tormenta eléctrica' WHEN 'drizzle' THEN 'llovizna' WHEN 'rain' THEN 'lluvia' WHEN 'snow' THEN 'nieve'
    WHEN 'atmosphere' THEN 'niebla / calima' WHEN 'clear' THEN 'despejado' WHEN 'clouds' THEN 'nublado' ELSE weather_group END AS weather_name,
  CASE dominant WHEN 'temperatura' THEN 'arcos incompletos' WHEN 'viento' THEN 'trazos curvos fragmentados' WHEN 'humedad' THEN 'óvalos con contorno discontinuo'
    WHEN 'presion' THEN 'rectángulos muy delgados' WHEN 'nubes' THEN 'rombos pequeños descentrados' ELSE 'puntos-fractura dispersos' END AS fracture FROM dominant""")
def x29_lookups(spark, sf):
    df = flows.encoded(B.obs(spark, sf))
    return df.select(
        "event_id", V.dominance_header("dominant", "dominant2").alias("header"),
        V.lookup("dominant", K.DOMINANT_COLOURS).alias("colour"),
        V.lookup("event_type", K.EVENT_NAMES, K.EVENT_NAME_DEFAULT).alias("event_name"),
        V.lookup("event_type", K.EVENT_COLOURS, K.EVENT_COLOUR_DEFAULT).alias("event_colour"),
        F.coalesce(V.lookup("weather_group", K.WEATHER_NAMES), F.col("weather_group")).alias("weather_name"),
        V.lookup("dominant", K.FRACTURE_SHAPES, K.FRACTURE_SHAPE_DEFAULT).alias("fracture"))
