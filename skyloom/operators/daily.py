"""Daily aggregates (A2-A8, A22, F3, F7) per site and local day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.physics import cloud_fraction


def bias_correct(df: DataFrame, cols, delta: float = K.TEMPERATURE_BIAS) -> DataFrame:
    """P9."""
    return df.withColumns({c: F.col(c) + F.lit(delta) for c in cols})


def daily_forest(df: DataFrame, site: str = "site_id", date: str = "date") -> DataFrame:
    """A2 and F2: eleven daily measures; days with a missing measure are dropped."""
    return (
        df.groupBy(site, date)
        .agg(
            F.max("temp_c").alias("temp_c_max"), F.min("temp_c").alias("temp_c_min"),
            F.avg("temp_c").alias("temp_c_mean"),
            F.avg("pressure_hpa").alias("pressure_hpa_mean"), F.min("pressure_hpa").alias("pressure_hpa_min"),
            F.max("wind_speed").alias("wind_speed_max"), F.avg("wind_speed").alias("wind_speed_mean"),
            F.max("humidity").alias("humidity_max"), F.avg("humidity").alias("humidity_mean"),
            F.coalesce(F.sum("precip_mm"), F.lit(0.0)).alias("precip_mm_sum"),
            F.avg("cloud_cover").alias("cloud_cover_mean"),
        )
        .na.drop("any")
    )


def daily_sequence(df: DataFrame, site: str = "site_id", date: str = "date") -> DataFrame:
    """A3: seven daily measures, only those whose source column exists."""
    measures = {
        "temp_c": F.max, "dewpoint_c": F.avg, "pressure_hpa": F.avg, "wind_u": F.avg,
        "wind_v": F.avg, "precip_mm": F.sum, "cloud_cover": F.avg,
    }
    aggregates = []
    for name, how in measures.items():
        if name in df.columns:
            value = how(name)
            aggregates.append((F.coalesce(value, F.lit(0.0)) if name == "precip_mm" else value).alias(name))
    return df.groupBy(site, date).agg(*aggregates).na.drop("any")


def daily_live(df: DataFrame, touched: DataFrame | None = None, site: str = "site_id", date: str = "date") -> DataFrame:
    """Thirteen measures per day in one pass over the readings.

    ``touched`` (distinct site and date) limits the work to the days that got new readings.
    """
    if touched is not None:
        df = df.join(touched.select(site, date).distinct(), [site, date], "left_semi")
    return df.groupBy(site, date).agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.max("temperature").alias("temp_c_max"), F.min("temperature").alias("temp_c_min"),
        F.avg("temperature").alias("temp_c_mean"),
        F.avg("pressure").alias("pressure_hpa_mean"), F.min("pressure").alias("pressure_hpa_min"),
        F.max("wind_speed").alias("wind_speed_max"), F.avg("wind_speed").alias("wind_speed_mean"),
        F.max("humidity").alias("humidity_max"), F.avg("humidity").alias("humidity_mean"),
        F.coalesce(F.sum("rain_1h"), F.lit(0.0)).alias("precip_mm_sum"),
        cloud_fraction(F.avg("clouds")).alias("cloud_cover_mean"),
        F.avg("pm2_5").alias("pm2_5_mean"),
    )


def readings_on(df: DataFrame, day, date: str = "date") -> DataFrame:
    """readings of one day; a pushed-down (or partition) filter."""
    return df.filter(F.col(date) == F.lit(day))


def distinct_days(df: DataFrame, date: str = "date") -> DataFrame:
    """A6 and U3."""
    return df.select(date).distinct()


def coverage(df: DataFrame, expected: int = K.READINGS_PER_DAY, site: str = "site_id", date: str = "date") -> DataFrame:
    """Readings per day against the expected number."""
    counted = df.groupBy(site, date).agg(F.count(F.lit(1)).alias("n_readings"))
    return counted.withColumn("missing", F.greatest(F.lit(0), F.lit(expected) - F.col("n_readings")))


def history_status(
    raw: DataFrame, today, site: str = "site_id", date: str = "date", sites: DataFrame | None = None,
) -> DataFrame:
    """Days on record, readings today, readiness and days still missing, per site.

    ``sites`` lists all sites: those without a reading are ``empty``. Without it only sites that have readings appear.

    Days are counted from a per-day partial aggregate, so a site with very many readings costs no
    more in the second step than one with few.
    """
    days = raw.groupBy(site, date).agg(F.count(F.lit(1)).alias("_n"))
    status = days.groupBy(site).agg(
        F.count(F.lit(1)).alias("days"),
        F.sum(F.when(F.col(date) == F.lit(today), F.col("_n")).otherwise(F.lit(0))).alias("readings_today"),
    )
    if sites is not None:
        status = sites.select(site).distinct().join(status, site, "left").fillna(0, ["days", "readings_today"])
    return status.withColumns(readiness("days"))


def readiness(days: str):
    """Readiness code and missing days from the number of days."""
    n = F.col(days)
    return {
        "status": F.when(n == 0, "empty").when(n < K.MIN_DAYS_ROLLING, "partial_rolling")
        .when(n < K.MIN_DAYS_FULL, "partial_lags").otherwise("complete"),
        "days_missing": F.when(n < K.MIN_DAYS_ROLLING, F.lit(K.MIN_DAYS_ROLLING) - n)
        .when(n < K.MIN_DAYS_FULL, F.lit(K.MIN_DAYS_FULL) - n).otherwise(F.lit(0).cast("long")),
    }


def status_text(days: str = "days", today: str = "readings_today"):
    """The readable status line."""
    n = F.col(days)

    def filled(template, limit=0):
        values = {"days": n, "today": F.col(today), "expected": F.lit(K.READINGS_PER_DAY), "missing": F.lit(limit) - n}
        text = F.lit(template)
        for name, value in values.items():
            text = F.replace(text, F.lit("{" + name + "}"), value.cast("string"))
        return text

    return (
        F.when(n == 0, filled(K.STATUS_EMPTY))
        .when(n < K.MIN_DAYS_ROLLING, filled(K.STATUS_ROLLING, K.MIN_DAYS_ROLLING))
        .when(n < K.MIN_DAYS_FULL, filled(K.STATUS_LAGS, K.MIN_DAYS_FULL))
        .otherwise(filled(K.STATUS_COMPLETE))
    )


def enough_history(df: DataFrame, need: int = K.SEQUENCE_LENGTH, strict: bool = False, site: str = "site_id") -> DataFrame:
    """keep sites with at least ``need`` rows; ``strict`` raises when any site has fewer."""
    counts = df.groupBy(site).agg(F.count(F.lit(1)).alias("_n"))
    if strict:
        short = counts.filter(F.col("_n") < need).limit(1).collect()
        if short:
            raise ValueError(f"at least {need} days are needed, site {short[0][site]} has {short[0]['_n']}")
    return df.join(counts.filter(F.col("_n") >= need).select(site), site, "left_semi")
