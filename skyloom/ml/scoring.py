"""Point estimates (P18) and scoring with fallback (M9)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.calendar import season
from skyloom.functions.numbers import round_exact
from skyloom.ml.forest import fill_missing, score
from skyloom.ml.split import align_columns
from skyloom.operators import labels


def point_estimate(df: DataFrame, date: str = "date", keep: tuple[str, ...] = ("site_id", "date")) -> DataFrame:
    """The 39 features guessed from one flat reading without history."""
    given = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(d)) if c in df.columns else F.lit(d)
        for c, d in K.POINT_DEFAULTS.items()
    }
    temp, pres, wind = given["temperature"], given["pressure"], given["wind_speed"]
    hum, clouds = given["humidity"], given["clouds"]
    sin, cos = season(date, K.YEAR_DAYS_FOREST)
    daily = {
        "temp_c_max": temp + K.POINT_TEMP_ABOVE, "temp_c_min": temp - K.POINT_TEMP_BELOW, "temp_c_mean": temp,
        "pressure_hpa_mean": pres, "pressure_hpa_min": pres - K.POINT_PRESSURE_BELOW,
        "wind_speed_max": wind * K.POINT_WIND_GUST, "wind_speed_mean": wind,
        "humidity_max": F.least(F.lit(100.0), hum + K.POINT_HUMIDITY_ABOVE), "humidity_mean": hum,
        "precip_mm_sum": F.when(clouds > K.RULE_CLOUD_PCT, F.lit(K.POINT_RAIN_MM)).otherwise(F.lit(0.0)),
        "cloud_cover_mean": clouds / 100.0,
    }
    made = dict(daily)
    made |= {f"{c}_ma{n}": daily[c] for c in K.ROLLED for n in K.ROLL_SIZES}
    made |= {
        f"{c}_lag{k}": F.lit(0.0) if c == "precip_mm_sum" else daily[c] for k in K.LAG_STEPS for c in K.LAGGED}
    span = daily["temp_c_max"] - daily["temp_c_min"]
    made |= {
        "temp_grad": F.lit(0.0), "pressure_grad": F.lit(0.0), "sin_doy": sin, "cos_doy": cos,
        "temp_range": span, "heat_intensity": daily["temp_c_max"] - temp,
        "pressure_deficit": F.lit(0.0), "humidity_range": daily["humidity_max"] - hum,
        "wind_spike": daily["wind_speed_max"] - wind, "dry_index": span * (F.lit(100.0) - hum),
        "pressure_norm": (pres - K.PRESSURE_NORM_MEAN) / K.PRESSURE_NORM_STD,
    }
    return df.select(*keep, *[made[c].alias(c) for c in K.FOREST_FEATURES])


RECENT_DAYS = K.MIN_DAYS_ROLLING
STORED_DAYS = K.MIN_DAYS_FULL


def evidence(days: DataFrame, stored: DataFrame, newest: Column, site: str = "site_id", date: str = "date") -> DataFrame:
    """M9: per site what its daily and stored rows are worth on the day ``newest``.

    ``recent_days``: days on record among the last ``RECENT_DAYS``; ``stored_age``: days since its newest stored row. A live
    row needs all recent days, a stored row may be ``STORED_DAYS`` old: ``has_history``, ``has_stored``.
    """
    recent = days.groupBy(site).agg(F.count_distinct(
        F.when(F.col(date) > F.date_sub(newest, RECENT_DAYS), F.col(date))).alias("recent_days"))
    aged = stored.groupBy(site).agg(F.min(F.datediff(newest, F.col(date))).alias("stored_age"))
    return recent.join(aged, site, "full").select(
        site, F.coalesce("recent_days", F.lit(0)).alias("recent_days"), "stored_age",
        (F.coalesce("recent_days", F.lit(0)) >= RECENT_DAYS).alias("has_history"),
        F.coalesce(F.col("stored_age") <= STORED_DAYS, F.lit(False)).alias("has_stored"))


def by_evidence(days: DataFrame, stored: DataFrame, live: DataFrame, newest: Column, site: str = "site_id",
                date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Live and stored rows of the sites whose evidence allows them, as ``choose_input`` takes them."""
    known = evidence(days, stored, newest, site, date)
    return (live.join(known.where("has_history").select(site), site, "left_semi"),
            stored.join(known.where("has_stored").select(site), site, "left_semi"))


def choose_input(
    sites: DataFrame, history: DataFrame, stored: DataFrame, readings: DataFrame, site: str = "site_id",
) -> DataFrame:
    """M9, first half: one model input per site and the ``source`` it came from.

    Order: live history row, stored feature row, point estimate. Each input has one row per site,
    so the joins are keyed on unique values.
    """
    features = list(K.FOREST_FEATURES)

    def packed(df, name, kind):
        return df.select(site, F.struct(*[F.col(c).cast("double").alias(c) for c in features], F.col("event_type")).alias(name))

    ranked = [
        ("history", packed(history.withColumn("event_type", labels.event_type("history")), "_history", "history")),
        ("stored", packed(stored.withColumn("event_type", labels.event_type("history")), "_stored", "stored")),
        ("reading", packed(
            point_estimate(readings, keep=(site, "date")).join(
                readings.select(site, labels.event_type("reading").alias("event_type")), site),
            "_reading", "reading")),
    ]
    joined = sites.select(site).distinct()
    for _, part in ranked:
        joined = joined.join(part, site, "left")
    source = F.when(F.col("_history").isNotNull(), "history").when(F.col("_stored").isNotNull(), "stored").when(
        F.col("_reading").isNotNull(), "reading")
    chosen = F.coalesce("_history", "_stored", "_reading")
    return joined.select(site, source.alias("source"), chosen.alias("_in")).select(site, "source", "_in.*")


def score_with_fallback(
    sites: DataFrame, history: DataFrame, stored: DataFrame, readings: DataFrame,
    model: PipelineModel | None, cols: list[str] | None = None, site: str = "site_id", fill: float = 0.0,
) -> DataFrame:
    """M9: risk, event type and readiness per site; without a model (0.0, 'unknown', false)."""
    if model is None:
        return sites.select(site).distinct().select(
            site, F.lit(None).cast("string").alias("source"), F.lit(0.0).alias("risk_score"),
            F.lit("unknown").alias("event_type"), F.lit(False).alias("ready"))
    cols = cols or list(K.FOREST_FEATURES)
    chosen = choose_input(sites, history, stored, readings, site).filter(F.col("source").isNotNull())
    aligned = align_columns(chosen, cols, keep=[site, "source", "event_type"])
    return score(model, fill_missing(aligned, cols, fill)).select(
        site, "source", round_exact("prob", 3).alias("risk_score"), "event_type", F.lit(True).alias("ready"))


def predict_daily(model: PipelineModel, rows: DataFrame, cols: list[str], keep: list[str], fill: float = 0.0) -> DataFrame:
    """M4 with X10: score daily feature rows and name the likely event."""
    typed = rows.withColumn("event_type", labels.event_type("history"))
    aligned = align_columns(typed, cols, keep=[*keep, "event_type"])
    return score(model, fill_missing(aligned, cols, fill)).select(
        *keep, round_exact("prob", 3).alias("risk_score"), "event_type", F.lit(True).alias("ml_ready"))
