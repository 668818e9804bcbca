"""Queries over series per site: daily tables, windows, features, history, streaming twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom import schemas
from skyloom.ml.split import apply_scaler, fit_scaler
from skyloom.operators import daily, evaluate, features, history, labels, series, windows
from skyloom.plans import bridge as B
from skyloom.plans import flows
from skyloom.plans.registry import query, r6, rounded
from skyloom.session import work_path
from skyloom.sources import tables
from skyloom.streaming import history as stream

# ---------------------------------------------------------------- grid
_INSTANT = ["t2m", "sp", "u10", "tcc"]


@query("j1_merge_inner", f"WITH {B.GRID} SELECT valid_time, latitude, longitude, {r6('t2m', 'sp', 'u10', 'tcc', 'tp')} FROM grid")
def j1_merge_inner(spark, sf):
    cells = B.grid(spark, sf)
    keys = ["valid_time", "latitude", "longitude"]
    return rounded(series.merge_grid(cells.select(*keys, *_INSTANT), cells.select(*keys, "tp")))


_BOXES = [(1, 4.0, 0.0, 1.0, 2.0), (2, 7.0, 2.0, 3.0, 4.0)]


@query("a1_grid_mean", f"""WITH {B.GRID}, boxed AS (
  SELECT 1 AS site_id, * FROM grid WHERE latitude BETWEEN 1 AND 4 AND longitude BETWEEN 0 AND 2
  UNION ALL SELECT 2 AS site_id, * FROM grid WHERE latitude BETWEEN 3 AND 7 AND longitude BETWEEN 2 AND 4)
SELECT site_id, valid_time, {', '.join(f'round(avg({c}), {9 if c == "tcc" else 6}) + 0e0 AS {c}' for c in ('t2m', 'sp', 'u10', 'tcc', 'tp'))}
FROM boxed GROUP BY 1, 2""")
def a1_grid_mean(spark, sf):
    return rounded(series.grid_mean(B.grid(spark, sf), _BOXES), tcc=9)


@query("p1_rename", f"""WITH {B.GRID} SELECT valid_time AS ts, CAST(count(*) AS BIGINT) AS cells, round(avg(t2m), 6) AS temp_k,
  round(avg(tp), 6) AS precip_m FROM grid GROUP BY 1""")
def p1_rename(spark, sf):
    named = series.drop_untimed(series.rename_grid(B.grid(spark, sf)))
    return rounded(named.groupBy("ts").agg(
        F.count(F.lit(1)).alias("cells"), F.avg("temp_k").alias("temp_k"), F.avg("precip_m").alias("precip_m")))


@query("u2_union_years", """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 4) AS amount
FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 1996 OR year(l_shipdate) BETWEEN 2000 AND 2001 GROUP BY 1""")
def u2_union_years(spark, sf):
    kept = tables.union_periods(B.table(spark, sf, "lineitem"), [(1995, 1996), (2000, 2001)], "l_shipdate")
    return kept.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("amount"))


@query("s6_grid_years", f"""WITH {B.GRID} SELECT CAST(year(valid_time) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS cells,
  round(avg(t2m), 6) AS t2m, round(avg(tp), 6) AS tp FROM grid WHERE year(valid_time) >= 2000 GROUP BY 1""")
def s6_grid_years(spark, sf):
    """Written partitioned by year, read back with only the directories of the wanted years."""
    path = work_path(spark, "grid")
    tables.write_grid(B.grid(spark, sf), path)
    recent = tables.read_grid(spark, path, years=range(2000, 2100))
    return rounded(recent.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("cells"), F.avg("t2m").alias("t2m"), F.avg("tp").alias("tp")))


# ---------------------------------------------------------------- daily tables
_FOREST_DAY = r6(*K.DAILY_MEASURES)


@query("a2_daily_rf", f"WITH {B.DAILY_FOREST} SELECT site_id, date, {_FOREST_DAY} FROM daily")
def a2_daily_rf(spark, sf):
    return rounded(flows.forest_daily(B.readings(spark, sf)))


_SEQ_DAY = ("temp_c", "dewpoint_c", "pressure_hpa", "wind_u", "wind_v", "precip_mm", "cloud_cover")


@query("a3_daily_seq", f"WITH {B.DAILY_SEQUENCE} SELECT site_id, date, {r6(*_SEQ_DAY)} FROM daily")
def a3_daily_seq(spark, sf):
    return rounded(flows.sequence_daily(B.readings(spark, sf)))


_LIVE = ("temp_c_max", "temp_c_min", "temp_c_mean", "pressure_hpa_mean", "wind_speed_max", "wind_speed_mean",
         "humidity_mean", "precip_mm_sum", "cloud_cover_mean", "pm2_5_mean")
_LIVE_SQL = f"SELECT site_id, date, n_readings, pressure_hpa_min, humidity_max, {r6(*_LIVE)} FROM daily"


@query("a4_daily_live", f"WITH {B.DAILY_LIVE} {_LIVE_SQL}")
def a4_daily_live(spark, sf):
    return rounded(daily.daily_live(B.obs(spark, sf)))


@query("j5_touched_days", f"""WITH {B.DAILY_LIVE}, touched AS (SELECT DISTINCT site_id, date FROM obs WHERE kind = 'purchase')
SELECT daily.site_id, daily.date, n_readings, {r6('temp_c_max', 'humidity_mean')} FROM daily JOIN touched USING (site_id, date)""")
def j5_touched_days(spark, sf):
    """A5 incrementally: only days with a purchase are aggregated again, from all their readings."""
    obs = B.obs(spark, sf)
    fresh = daily.daily_live(obs, touched=obs.filter(F.col("kind") == "purchase"))
    return rounded(fresh.select("site_id", "date", "n_readings", "temp_c_max", "humidity_mean"))


@query("a6_distinct_days", f"WITH {B.OBS} SELECT DISTINCT date FROM obs")
def a6_distinct_days(spark, sf):
    return daily.distinct_days(B.obs(spark, sf))


@query("f3_readings_on", f"WITH {B.OBS} SELECT event_id, site_id, hour FROM obs WHERE date = DATE '2024-01-15'")
def f3_readings_on(spark, sf):
    import datetime

    return daily.readings_on(B.obs(spark, sf), datetime.date(2024, 1, 15)).select("event_id", "site_id", "hour")


@query("a8_status", f"""WITH {B.OBS}, per_site AS (
  SELECT site_id, CAST(count(DISTINCT date) AS BIGINT) AS days,
    CAST(sum(CASE WHEN date = DATE '2024-01-30' THEN 1 ELSE 0 END) AS BIGINT) AS readings_today FROM obs GROUP BY 1)
SELECT *, CASE WHEN days = 0 THEN 'empty' WHEN days < 7 THEN 'partial_rolling' WHEN days < 14 THEN 'partial_lags' ELSE 'complete' END AS status,
  CAST(CASE WHEN days < 7 THEN 7 - days WHEN days < 14 THEN 14 - days ELSE 0 END AS BIGINT) AS days_missing,
  CASE WHEN days < 7 THEN days || ' días (' || readings_today || '/3 lecturas hoy) — faltan ' || (7 - days) || ' para rolling real'
    WHEN days < 14 THEN days || ' días (' || readings_today || '/3 lecturas hoy) — faltan ' || (14 - days) || ' para lags completos'
    ELSE days || ' días (' || readings_today || '/3 lecturas hoy) — predicción completa ✓' END AS text FROM per_site""")
def a8_status(spark, sf):
    import datetime

    status = daily.history_status(B.obs(spark, sf), datetime.date(2024, 1, 30))
    return status.withColumn("text", daily.status_text())


@query("a22_coverage", f"""WITH {B.OBS} SELECT site_id, date, CAST(count(*) AS BIGINT) AS n_readings,
  CAST(greatest(0, 3 - count(*)) AS BIGINT) AS missing FROM obs GROUP BY 1, 2""")
def a22_coverage(spark, sf):
    return daily.coverage(B.obs(spark, sf))


@query("f7_enough_history", f"""WITH {B.DAILY_LIVE} SELECT site_id, date, n_readings FROM daily
WHERE site_id IN (SELECT site_id FROM daily GROUP BY 1 HAVING count(*) >= 27)""")
def f7_enough_history(spark, sf):
    return daily.enough_history(daily.daily_live(B.obs(spark, sf)), 27).select("site_id", "date", "n_readings")


# ---------------------------------------------------------------- windows
def _roll(col: str, n: int, strict: bool) -> str:
    frame = f"OVER (PARTITION BY site_id ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    mean = f"avg({col}) {frame}"
    return f"CASE WHEN count({col}) {frame} >= {n} THEN {mean} END" if strict else mean


def _rolled(strict: bool) -> str:
    return ", ".join(f"round({_roll(c, n, strict)}, 6) + 0e0 AS {c}_ma{n}" for c in K.ROLLED for n in K.ROLL_SIZES)


@query("w1_roll_strict", f"WITH {B.DAILY_FOREST} SELECT site_id, date, {_rolled(True)} FROM daily")
def w1_roll_strict(spark, sf):
    df = windows.rolling_mean(flows.forest_daily(B.readings(spark, sf)), K.ROLLED, K.ROLL_SIZES)
    return rounded(df.select("site_id", "date", *[f"{c}_ma{n}" for c in K.ROLLED for n in K.ROLL_SIZES]))


@query("w2_roll_partial", f"WITH {B.DAILY_LIVE} SELECT site_id, date, {_rolled(False)} FROM daily")
def w2_roll_partial(spark, sf):
    df = windows.rolling_mean(daily.daily_live(B.obs(spark, sf)), K.ROLLED, K.ROLL_SIZES, min_periods=1)
    return rounded(df.select("site_id", "date", *[f"{c}_ma{n}" for c in K.ROLLED for n in K.ROLL_SIZES]))


def _lag(col: str, k: int) -> str:
    return f"lag({col}, {k}) OVER (PARTITION BY site_id ORDER BY date)"


@query("w3_lags", f"""WITH {B.SHIP_DAYS} SELECT site_id, date, {', '.join(f'{_lag(c, k)} AS {c}_lag{k}' for k in (1, 2, 3) for c in ('amount', 'peak'))} FROM ship_days""")
def w3_lags(spark, sf):
    df = windows.lags(B.ship_days(spark, sf), ["amount", "peak"], K.LAG_STEPS)
    return df.select("site_id", "date", *[f"{c}_lag{k}" for k in K.LAG_STEPS for c in ("amount", "peak")])


@query("w4_gradient", f"""WITH {B.SHIP_DAYS} SELECT site_id, date, amount - {_lag('amount', 1)} AS amount_grad,
  coalesce(amount - {_lag('amount', 1)}, 0e0) AS amount_grad0 FROM ship_days""")
def w4_gradient(spark, sf):
    """W4 and W5."""
    df = windows.gradient(B.ship_days(spark, sf), "amount", "amount_grad")
    return windows.gradient(df, "amount", "amount_grad0", fill=0.0).select("site_id", "date", "amount_grad", "amount_grad0")


@query("w6_deaccumulate", f"WITH {B.READINGS}, {B.PHYSICAL} SELECT event_id, site_id, {r6('precip_mm')} FROM physical")
def w6_deaccumulate(spark, sf):
    return rounded(series.deaccumulate(B.readings(spark, sf)).select("event_id", "site_id", "precip_mm"))


@query("w7_target", f"""WITH {B.SHIP_DAYS} SELECT site_id, date, lead(target, 1) OVER (PARTITION BY site_id ORDER BY date) AS next FROM ship_days""")
def w7_target(spark, sf):
    return windows.next_target(B.ship_days(spark, sf), "target", "next").select("site_id", "date", "next")


@query("w9_sequences", f"""WITH {B.SHIP_DAYS}, steps AS (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY date) AS rn,
    lag(amount, 14) OVER w AS first_amount, lag(amount, 1) OVER w AS last_amount,
    sum(amount) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS amount_sum,
    max(peak) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS peak_max FROM ship_days
  WINDOW w AS (PARTITION BY site_id ORDER BY date))
SELECT site_id, date, target, CAST(14 AS INTEGER) AS steps, first_amount, last_amount,
  round(amount_sum, 4) AS amount_sum, peak_max FROM steps WHERE rn > 14""")
def w9_sequences(spark, sf):
    """Every window, compared by its length, first and last step, sum and peak."""
    df = windows.sequences(B.ship_days(spark, sf), ["amount", "peak"], K.SEQUENCE_LENGTH)
    amounts = F.transform("seq", lambda v: v[0])
    return df.select(
        "site_id", "date", "target", F.size("seq").alias("steps"), F.col("seq")[0][0].alias("first_amount"),
        F.element_at("seq", -1)[0].alias("last_amount"),
        F.round(F.aggregate(amounts, F.lit(0.0), lambda a, x: a + x), 4).alias("amount_sum"),
        F.array_max(F.transform("seq", lambda v: v[1])).alias("peak_max"))


@query("w10_newest_sequence", f"""WITH {B.SHIP_DAYS}, steps AS (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY date DESC) AS back, count(*) OVER (PARTITION BY site_id) AS n,
    max(date) OVER (PARTITION BY site_id) AS newest FROM ship_days)
SELECT site_id, newest AS date, CAST(14 - back AS INTEGER) AS step, amount, peak FROM steps WHERE back <= 14 AND n >= 14""")
def w10_newest_sequence(spark, sf):
    df = windows.newest_sequence(B.ship_days(spark, sf), ["amount", "peak"], K.SEQUENCE_LENGTH)
    steps = df.select("site_id", "date", F.posexplode("seq").alias("step", "v"))
    return steps.select("site_id", "date", "step", F.col("v")[0].alias("amount"), F.col("v")[1].alias("peak"))


@query("w11_last_row", f"""WITH {B.SHIP_DAYS} SELECT * FROM ship_days
QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY date DESC) = 1""")
def w11_last_row(spark, sf):
    return windows.last_row(B.ship_days(spark, sf))


@query("w14_zscore", f"""WITH {B.SHIP_DAYS} SELECT site_id, date,
  round((amount - avg(amount) OVER s) / nullif(stddev_samp(amount) OVER s, 0), 6) + 0e0 AS by_site,
  round((amount - avg(amount) OVER ()) / stddev_samp(amount) OVER (), 6) + 0e0 AS by_table,
  round((peak - 1013e0) / 5e0, 6) AS by_constants FROM ship_days WINDOW s AS (PARTITION BY site_id)""")
def w14_zscore(spark, sf):
    df = features.zscore(B.ship_days(spark, sf), "amount", "by_site")
    df = features.zscore(df, "amount", "by_table", "all")
    df = features.zscore(df, "peak", "by_constants", (K.PRESSURE_NORM_MEAN, K.PRESSURE_NORM_STD))
    return rounded(df.select("site_id", "date", "by_site", "by_table", "by_constants"))


@query("w15_segments", f"""WITH {B.SHIP_DAYS}, gaps AS (
  SELECT *, CASE WHEN date - lag(date) OVER (PARTITION BY site_id ORDER BY date) > 7 THEN 1 ELSE 0 END AS brk FROM ship_days),
parts AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY site_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS INTEGER) AS segment FROM gaps)
SELECT site_id, date, segment, lag(amount) OVER (PARTITION BY site_id, segment ORDER BY date) AS amount_lag1 FROM parts""")
def w15_segments(spark, sf):
    df = windows.segments(B.ship_days(spark, sf), 7)
    return windows.lags(df, ["amount"], [1], site=["site_id", "segment"]).select(
        "site_id", "date", "segment", "amount_lag1")


# ---------------------------------------------------------------- feature tables
_FLAGS = """CASE WHEN {heat} >= 38 THEN 1 ELSE 0 END AS event_heat, CASE WHEN {heat} <= 10 THEN 1 ELSE 0 END AS event_cold,
  CASE WHEN {wind} >= 8 THEN 1 ELSE 0 END AS event_wind, CASE WHEN {rain} >= 1 THEN 1 ELSE 0 END AS event_rain"""


def _feature_sql(strict: bool) -> str:
    """Window and composite items of the forest features over a table ``daily``."""
    items = [f"{_roll(c, n, strict)} AS {c}_ma{n}" for c in K.ROLLED for n in K.ROLL_SIZES]
    items += [f"{_lag(c, k)} AS {c}_lag{k}" for k in K.LAG_STEPS for c in K.LAGGED]
    items += [f"temp_c_max - {_lag('temp_c_max', 1)} AS temp_grad",
              f"pressure_hpa_mean - {_lag('pressure_hpa_mean', 1)} AS pressure_grad",
              "sin(2 * pi() * dayofyear(date) / 365e0) AS sin_doy", "cos(2 * pi() * dayofyear(date) / 365e0) AS cos_doy",
              "temp_c_max - temp_c_min AS temp_range", "temp_c_max - temp_c_mean AS heat_intensity",
              "humidity_max - humidity_mean AS humidity_range", "wind_speed_max - wind_speed_mean AS wind_spike",
              "(temp_c_max - temp_c_min) * (100e0 - humidity_mean) AS dry_index"]
    return ", ".join(items)


_M11 = f"""WITH {B.DAILY_FOREST}, corrected AS (
  SELECT * REPLACE (temp_c_max + 2.5e0 AS temp_c_max, temp_c_min + 2.5e0 AS temp_c_min, temp_c_mean + 2.5e0 AS temp_c_mean) FROM daily),
windowed AS (SELECT *, {_feature_sql(True)} FROM corrected),
labelled AS (SELECT *, pressure_hpa_mean - pressure_hpa_mean_ma7 AS pressure_deficit,
  (pressure_hpa_mean - avg(pressure_hpa_mean) OVER p) / nullif(stddev_samp(pressure_hpa_mean) OVER p, 0) AS pressure_norm,
  {_FLAGS.format(heat='temp_c_max', wind='wind_speed_max', rain='precip_mm_sum')}
  FROM windowed WINDOW p AS (PARTITION BY site_id)),
extreme AS (SELECT *, greatest(event_heat, event_cold, event_wind, event_rain) AS event_extreme FROM labelled),
final AS (SELECT *, lead(event_extreme) OVER (PARTITION BY site_id ORDER BY date) AS target FROM extreme)"""
_M11_SELECT = f"""SELECT site_id, date, {r6(*K.FOREST_FEATURES)}, {', '.join(K.EVENT_FLAGS)}, target FROM final
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in (*K.FOREST_FEATURES, 'target'))}"""


@query("m11_features", f"{_M11} {_M11_SELECT}")
def m11_features(spark, sf):
    """Flagship: 39 features, five flags and the next-day target per site and day."""
    return rounded(flows.forest_features(B.readings(spark, sf)))


_M12 = f"""WITH {B.DAILY_SEQUENCE}, base AS (
  SELECT * REPLACE (temp_c + 2.5e0 AS temp_c), sqrt(wind_u * wind_u + wind_v * wind_v) AS wind_speed,
    sin(2 * pi() * dayofyear(date) / 365.25e0) AS season_sin, cos(2 * pi() * dayofyear(date) / 365.25e0) AS season_cos FROM daily),
windowed AS (SELECT *, {_roll('temp_c', 3, False)} AS temp_ma3, {_roll('temp_c', 7, False)} AS temp_ma7,
  {_roll('pressure_hpa', 3, False)} AS pressure_ma3, coalesce(pressure_hpa - {_lag('pressure_hpa', 1)}, 0e0) AS pressure_grad,
  {_roll('wind_speed', 3, False)} AS wind_ma3, {_roll('precip_mm', 3, False)} AS precip_ma3,
  greatest(0e0, (temp_c - (dewpoint_c + 2e0)) * (100e0 - 100e0 * greatest(0e0, least(100e0,
    exp((17.625e0 * dewpoint_c) / (243.04e0 + dewpoint_c) - (17.625e0 * temp_c) / (243.04e0 + temp_c)))))) AS dry_index,
  {_FLAGS.format(heat='temp_c', wind='wind_speed', rain='precip_mm')} FROM base),
extreme AS (SELECT *, greatest(event_heat, event_cold, event_wind, event_rain) AS event_extreme FROM windowed),
final AS (SELECT *, lead(event_extreme) OVER (PARTITION BY site_id ORDER BY date) AS target FROM extreme)
SELECT site_id, date, {r6(*K.SEQUENCE_FEATURES)}, {', '.join(K.EVENT_FLAGS)}, target FROM final WHERE target IS NOT NULL"""


@query("m12_seq_features", _M12)
def m12_seq_features(spark, sf):
    df = flows.sequence_features(B.readings(spark, sf))
    return rounded(df.select("site_id", "date", *K.SEQUENCE_FEATURES, *K.EVENT_FLAGS, "target"))


_M10 = f"""WITH {B.DAILY_LIVE}, windowed AS (SELECT *, {_feature_sql(False)} FROM daily),
final AS (SELECT *, pressure_hpa_mean - pressure_hpa_mean_ma7 AS pressure_deficit, (pressure_hpa_mean - 1013e0) / 5e0 AS pressure_norm
  FROM windowed QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY date DESC) = 1)"""


@query("m10_live_features", f"{_M10} SELECT site_id, date, {r6(*K.FOREST_FEATURES)} FROM final")
def m10_live_features(spark, sf):
    live = features.live_features(daily.daily_live(B.obs(spark, sf)))
    return rounded(live.select("site_id", "date", *[F.col(c).cast("double").alias(c) for c in K.FOREST_FEATURES]))


@query("f6_threshold_counts", f"""WITH {B.DAILY_FOREST} SELECT CAST(count_if(temp_c_max >= 35) AS BIGINT) AS hot35, CAST(count_if(temp_c_max >= 38) AS BIGINT) AS hot38,
  CAST(count_if(temp_c_max <= 8) AS BIGINT) AS cold8, CAST(count_if(temp_c_max <= 12) AS BIGINT) AS cold12,
  CAST(count_if(precip_mm_sum >= 10) AS BIGINT) AS rain10, CAST(count_if(precip_mm_sum >= 20) AS BIGINT) AS rain20,
  CAST(count_if(wind_speed_max >= 8) AS BIGINT) AS wind8, CAST(count_if(wind_speed_max >= 10) AS BIGINT) AS wind10 FROM daily""")
def f6_threshold_counts(spark, sf):
    return labels.threshold_counts(flows.forest_daily(B.readings(spark, sf)), {
        "hot35": ("temp_c_max", ">=", 35.0), "hot38": ("temp_c_max", ">=", 38.0), "cold8": ("temp_c_max", "<=", 8.0),
        "cold12": ("temp_c_max", "<=", 12.0), "rain10": ("precip_mm_sum", ">=", 10.0),
        "rain20": ("precip_mm_sum", ">=", 20.0), "wind8": ("wind_speed_max", ">=", 8.0),
        "wind10": ("wind_speed_max", ">=", 10.0)})


@query("a9_class_share", f"{_M11}, kept AS ({_M11_SELECT}) SELECT target, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM kept GROUP BY 1")
def a9_class_share(spark, sf):
    return rounded(evaluate.class_share(flows.forest_features(B.readings(spark, sf))))


@query("a10_event_rate", f"""{_M11}, kept AS ({_M11_SELECT}) SELECT CAST(count(*) AS BIGINT) AS days,
  {', '.join(f'CAST(sum({f}) AS BIGINT) AS n_{f}' for f in K.EVENT_FLAGS)}, round(avg(event_extreme), 6) AS event_rate FROM kept""")
def a10_event_rate(spark, sf):
    return rounded(evaluate.event_rate(flows.forest_features(B.readings(spark, sf))))


@query("a13_scale_train", f"""WITH {B.SHIP_DAYS}, stats AS (SELECT avg(amount) AS am, stddev_pop(amount) AS asd, avg(peak) AS pm, stddev_pop(peak) AS psd
  FROM ship_days WHERE date < DATE '2000-01-01')
SELECT site_id, date, round((amount - am) / asd, 6) + 0e0 AS amount, round((peak - pm) / psd, 6) + 0e0 AS peak FROM ship_days, stats""")
def a13_scale_train(spark, sf):
    days, cols = B.ship_days(spark, sf), ["amount", "peak"]
    stats = fit_scaler(days.filter(F.col("date") < "2000-01-01"), cols)
    return rounded(apply_scaler(days, stats, cols).select("site_id", "date", *cols))


# ---------------------------------------------------------------- history
_OLD_NEW = f"""{B.OBS}, old AS (SELECT event_id, site_id, date, hour, ts, temperature FROM obs WHERE kind <> 'view'),
fresh AS (SELECT event_id, site_id, date, hour, ts, temperature FROM obs WHERE kind = 'view')"""


def _old_new(spark, sf):
    obs = B.obs(spark, sf)
    cols = ["event_id", "site_id", "date", "hour", "ts", "temperature"]
    is_new = F.col("kind") == "view"
    return obs.filter(~is_new).select(*cols), obs.filter(is_new).select(*cols)


@query("j3_anti_append", f"""WITH {_OLD_NEW}
SELECT event_id, site_id, date, hour FROM old o WHERE NOT EXISTS
  (SELECT 1 FROM fresh f WHERE f.site_id = o.site_id AND f.date = o.date AND f.hour = o.hour)
UNION ALL SELECT event_id, site_id, date, hour FROM fresh""")
def j3_anti_append(spark, sf):
    old, new = _old_new(spark, sf)
    return history.append_new(old, new, ["site_id", "date", "hour"]).select("event_id", "site_id", "date", "hour")


@query("j4_upsert", f"""WITH {_OLD_NEW}, both_sides AS (SELECT 0 AS side, * FROM old UNION ALL SELECT 1, * FROM fresh)
SELECT event_id, site_id, date, hour, round(temperature, 6) AS temperature FROM both_sides
QUALIFY row_number() OVER (PARTITION BY site_id, date, hour ORDER BY side DESC, ts DESC, event_id DESC) = 1""")
def j4_upsert(spark, sf):
    old, new = _old_new(spark, sf)
    merged = history.upsert(old, new, ["site_id", "date", "hour"], ["ts", "event_id"])
    return rounded(merged.select("event_id", "site_id", "date", "hour", "temperature"))


@query("k2_newest_first", f"""WITH {B.OBS} SELECT event_id, city, date, hour FROM obs
QUALIFY row_number() OVER (PARTITION BY site_id, date, hour ORDER BY ts DESC, event_id DESC) = 1""")
def k2_newest_first(spark, sf):
    entries = history.latest(B.obs(spark, sf).select("event_id", "site_id", "city", "date", "hour", "ts"),
                             ["site_id", "date", "hour"], ["ts", "event_id"])
    return history.newest_first(entries).select("event_id", "city", "date", "hour")


@query("k8_tail", f"{_M11}, kept AS ({_M11_SELECT}) SELECT site_id, date, temp_c_max, target FROM kept ORDER BY date DESC, site_id DESC LIMIT 5")
def k8_tail(spark, sf):
    df = flows.forest_features(B.readings(spark, sf))
    return rounded(history.tail(df, 5, "date", "site_id").select("site_id", "date", "temp_c_max", "target"))


@query("s2_raw_history", f"""WITH {B.OBS} SELECT site_id, strftime(ts, '%Y-%m-%d %H:%M') AS datetime, date, hour, round(temperature, 6) AS temperature, pressure, wind_speed,
  humidity, clouds, pm2_5, round(rain_1h, 6) AS rain_1h FROM obs""")
def s2_raw_history(spark, sf):
    """Written as date-partitioned history and scanned back."""
    path = work_path(spark, "raw")
    raw = B.obs(spark, sf).select(
        "site_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("datetime"), "date", "hour", "temperature", "pressure",
        "wind_speed", "humidity", "clouds", "pm2_5", "rain_1h")
    tables.write_partitioned(raw, path, "date", sort=["hour"])
    return rounded(tables.read_partitioned(spark, path)).select(*raw.columns)


@query("s4_daily_history", f"WITH {B.DAILY_LIVE} {_LIVE_SQL}")
def s4_daily_history(spark, sf):
    """The daily table as CSV, some of its dates incomplete, then those dates again, and scanned back."""
    path = work_path(spark, "daily")
    fields = [f.name for f in schemas.DAILY_HISTORY.fields]
    obs, affected = B.obs(spark, sf), F.dayofmonth("date") % 4 == 0
    for part in (obs.where(~affected | (F.col("event_id") % 2 == 0)), obs.where(affected)):
        tables.write_daily_csv(daily.daily_live(part).select("site_id", *fields), path)
    return rounded(tables.read_daily_csv(spark, path, extra="site_id bigint").select("site_id", *fields))


@query("s7_features_store", f"{_M11}, kept AS ({_M11_SELECT}) SELECT site_id, date, temp_c_max, dry_index, target FROM kept")
def s7_features_store(spark, sf):
    path = work_path(spark, "features")
    tables.write_features(flows.forest_features(B.readings(spark, sf)), path)
    return rounded(tables.read_features(spark, path).select("site_id", "date", "temp_c_max", "dry_index", "target"))


@query("s8_archive_store", f"""WITH {B.DOMINANT} SELECT event_id, date, hour, city, dominant, dominant2, round(risk_score, 3) AS risk_score, event_type, ml_ready
FROM dominant QUALIFY row_number() OVER (PARTITION BY site_id, date, hour ORDER BY ts DESC, event_id DESC) = 1""")
def s8_archive_store(spark, sf):
    """One entry per site, day and hour, written as JSON newest first and scanned back."""
    from skyloom.functions.calendar import asset_path

    path = work_path(spark, "archive")
    last = history.latest(B.obs(spark, sf), ["site_id", "date", "hour"], ["ts", "event_id"])
    shown = flows.encoded(last).withColumn("image_path", asset_path("city", "date", "hour", "sky"))
    tables.write_archive(history.archive_entries(shown, ["event_id"]), path)
    kept = tables.read_archive(spark, path, extra="event_id bigint")
    return kept.select("event_id", "date", "hour", "city", "dominant", "dominant2", "risk_score", "event_type", "ml_ready")


# ---------------------------------------------------------------- streaming
_CURRENT = f"""WITH {B.OBS}, latest AS (SELECT * FROM obs
  QUALIFY row_number() OVER (PARTITION BY site_id, date, hour ORDER BY ts DESC, event_id DESC) = 1)"""


def _landed(spark, sf):
    # a glob, so that the table may be one file or a folder of files
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    raw = stream.ingest(spark, f"{sf}/event[s].parquet", schema)
    return B.as_obs(raw)


@query("t2_stream_upsert", f"{_CURRENT} SELECT event_id, site_id, date, hour, round(temperature, 6) AS temperature FROM latest")
def t2_stream_upsert(spark, sf):
    store = stream.History(work_path(spark, "stream"))
    stream.upsert_stream(_landed(spark, sf), store).awaitTermination()
    return rounded(stream.readings(spark, store).select("event_id", "site_id", "date", "hour", "temperature"))


@query("t3_stream_daily", f"""{_CURRENT} SELECT site_id, date, CAST(count(*) AS BIGINT) AS n_readings, round(max(temperature), 6) AS temp_c_max,
  round(avg(humidity), 6) AS humidity_mean, round(sum(rain_1h), 6) AS precip_mm_sum FROM latest GROUP BY 1, 2""")
def t3_stream_daily(spark, sf):
    store = stream.History(work_path(spark, "stream"))
    stream.daily_stream(_landed(spark, sf), store).awaitTermination()
    return rounded(stream.days(spark, store).select(
        "site_id", "date", "n_readings", "temp_c_max", "humidity_mean", "precip_mm_sum"))


_HELD_BACK = 7  # every seventh event lands last


@query("t6_stream_drop_late", f"""WITH {B.OBS}, cut AS (SELECT max(ts) - INTERVAL 1 DAY AS edge FROM obs WHERE event_id % {_HELD_BACK} <> 0),
latest AS (SELECT obs.* FROM obs, cut WHERE event_id % {_HELD_BACK} <> 0 OR ts >= edge
  QUALIFY row_number() OVER (PARTITION BY site_id, date, hour ORDER BY ts DESC, event_id DESC) = 1)
SELECT site_id, date, CAST(count(*) AS BIGINT) AS n_readings, round(max(temperature), 6) AS temp_c_max,
  round(avg(humidity), 6) AS humidity_mean FROM latest GROUP BY 1, 2""")
def t6_stream_drop_late(spark, sf):
    """Events land in three batches: the older half, the newer half, and those held back, most of them late by then."""
    events, path = B.table(spark, sf, "events"), work_path(spark, "landed")
    span = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("a"),
                      F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("b")).first()
    middle = F.timestamp_micros(F.lit((span["a"] + span["b"]) // 2))
    late, older = F.col("event_id") % _HELD_BACK == 0, F.col("ts").cast("timestamp") < middle
    for k, part in enumerate((~late & older, ~late & ~older, late)):
        events.where(part).coalesce(1).write.parquet(f"{path}/part={k}")
    source = stream.ingest(spark, f"{path}/*", events.schema, files_per_batch=1)
    store = stream.History(work_path(spark, "stream"))
    stream.daily_stream(B.as_obs(source), store, late="drop").awaitTermination()
    return rounded(stream.days(spark, store).select("site_id", "date", "n_readings", "temp_c_max", "humidity_mean"))


#: Daily rows and partial features of the last reading per site, date and hour.
LIVE_HISTORY = B.DAILY_LIVE.replace(B.OBS, f"""{B.OBS}, latest AS (SELECT * FROM obs
  QUALIFY row_number() OVER (PARTITION BY site_id, date, hour ORDER BY ts DESC, event_id DESC) = 1)""").replace(
    "FROM obs GROUP BY", "FROM latest GROUP BY") + f""", windowed AS (SELECT *, {_feature_sql(False)} FROM daily),
featured AS (SELECT *, pressure_hpa_mean - pressure_hpa_mean_ma7 AS pressure_deficit, (pressure_hpa_mean - 1013e0) / 5e0 AS pressure_norm
  FROM windowed)"""


@query("t4_stream_status", f"""WITH {LIVE_HISTORY}, counted AS (SELECT site_id, CAST(count(*) AS BIGINT) AS days FROM daily GROUP BY 1)
SELECT site_id, date, days, CASE WHEN days < 7 THEN 'partial_rolling' WHEN days < 14 THEN 'partial_lags' ELSE 'complete' END AS status,
  {r6(*K.FOREST_FEATURES)} FROM featured JOIN counted USING (site_id) QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY date DESC) = 1""")
def t4_stream_status(spark, sf):
    store = stream.History(work_path(spark, "stream"))
    stream.status_stream(_landed(spark, sf), store).awaitTermination()
    live = stream.table(spark, store, "live", ["site_id"])
    return rounded(live.select("site_id", "date", "days", "status", *[F.col(c).cast("double").alias(c) for c in K.FOREST_FEATURES]))
