"""Feature tables (M10-M12) from daily tables: windows, composites, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions import physics
from skyloom.functions.calendar import season
from skyloom.functions.numbers import clip
from skyloom.operators import labels, windows
from skyloom.operators.daily import bias_correct


def composites(df: DataFrame) -> DataFrame:
    """X6 and W8; needs the seven-row pressure mean."""
    span = F.col("temp_c_max") - F.col("temp_c_min")
    return df.withColumns({
        "temp_range": span,
        "heat_intensity": F.col("temp_c_max") - F.col("temp_c_mean"),
        "pressure_deficit": F.col("pressure_hpa_mean") - F.col("pressure_hpa_mean_ma7"),
        "humidity_range": F.col("humidity_max") - F.col("humidity_mean"),
        "wind_spike": F.col("wind_speed_max") - F.col("wind_speed_mean"),
        "dry_index": span * (F.lit(100.0) - F.col("humidity_mean")),
    })


def zscore(df: DataFrame, col: str, name: str, stats="site", site: str = "site_id") -> DataFrame:
    """Standard score by site mean and sample deviation, by the whole table, or by constants."""
    if stats == "site":
        w = Window.partitionBy(site)
        mean, std = F.avg(col).over(w), F.stddev_samp(col).over(w)
    elif stats == "all":
        whole = df.agg(F.struct(F.avg(col).alias("m"), F.stddev_samp(col).alias("s")).alias("z")).scalar()
        mean, std = whole["m"], whole["s"]
    else:
        mean, std = F.lit(float(stats[0])), F.lit(float(stats[1]))
    return df.withColumn(name, (F.col(col) - mean) / F.nullif(std, F.lit(0.0)))


def dry_index_proxy(df: DataFrame) -> DataFrame:
    """Dryness from a minimum-temperature proxy; 0 where the inputs do not exist."""
    if not {"temp_c", "dewpoint_c"} <= set(df.columns):
        return df.withColumn("dry_index", F.lit(0.0))
    wet = physics.humidity("dewpoint_c", "temp_c", clip_on="ratio")
    span = F.col("temp_c") - (F.col("dewpoint_c") + F.lit(2.0))
    return df.withColumn("dry_index", clip(span * (F.lit(100.0) - wet), low=0.0))


def _history_windows(daily: DataFrame, min_periods: int | None, site, date) -> DataFrame:
    """W1/W2, W3, W4 in one projection: a single exchange and sort serve all frames."""
    w = windows.site_window(site, date)
    made = {f"{c}_ma{n}": windows.rolling_column(c, n, w, min_periods) for c in K.ROLLED for n in K.ROLL_SIZES}
    made |= {f"{c}_lag{k}": F.lag(c, k).over(w) for k in K.LAG_STEPS for c in K.LAGGED}
    made["temp_grad"] = F.col("temp_c_max") - F.lag("temp_c_max", 1).over(w)
    made["pressure_grad"] = F.col("pressure_hpa_mean") - F.lag("pressure_hpa_mean", 1).over(w)
    return daily.withColumns(made)


def add_features(
    daily: DataFrame, site: str = "site_id", date: str = "date", series=None, drop_incomplete: bool = True,
) -> DataFrame:
    """The 39 forest features, five event flags and the next-day target.

    ``series`` is the window key, by default the site; pass ``[site, "segment"]`` to stop windows
    at archive seams (W15).
    """
    key = series or site
    sin, cos = season(date, K.YEAR_DAYS_FOREST)
    corrected = bias_correct(daily, ["temp_c_max", "temp_c_mean", "temp_c_min"])
    featured = composites(
        _history_windows(corrected, None, key, date).withColumns({"sin_doy": sin, "cos_doy": cos})
    )
    scored = zscore(featured, "pressure_hpa_mean", "pressure_norm", "site", site)
    flagged = windows.next_target(labels.event_flags(scored), site=key, order=date)
    ordered = flagged.select(site, date, *K.FOREST_FEATURES, *K.EVENT_FLAGS, "target")
    return ordered.na.drop("any") if drop_incomplete else ordered


def live_history(daily: DataFrame, site: str = "site_id", date: str = "date") -> DataFrame:
    """Every day's features with partial history (the table behind ``live_features``)."""
    sin, cos = season(date, K.YEAR_DAYS_FOREST)
    featured = composites(
        _history_windows(daily, 1, site, date).withColumns({"sin_doy": sin, "cos_doy": cos})
    )
    return zscore(featured, "pressure_hpa_mean", "pressure_norm", (K.PRESSURE_NORM_MEAN, K.PRESSURE_NORM_STD))


def live_features(daily: DataFrame, site: str = "site_id", date: str = "date") -> DataFrame:
    """Features of each site's newest day."""
    return windows.last_row(live_history(daily, site, date), site, date)


def add_sequence_features(daily: DataFrame, site: str = "site_id", date: str = "date") -> DataFrame:
    """M12 before labels: bias, season, partial rolling means, gradient, wind length, dry index."""
    has = set(daily.columns)
    w = windows.site_window(site, date)
    sin, cos = season(date, K.YEAR_DAYS_SEQUENCE)
    df = bias_correct(daily, ["temp_c"]) if "temp_c" in has else daily
    made = {"season_sin": sin, "season_cos": cos}
    if {"wind_u", "wind_v"} <= has:
        df = df.withColumn("wind_speed", physics.wind_speed("wind_u", "wind_v"))
        made["wind_ma3"] = windows.rolling_column("wind_speed", 3, w, 1)
    if "temp_c" in has:
        made["temp_ma3"] = windows.rolling_column("temp_c", 3, w, 1)
        made["temp_ma7"] = windows.rolling_column("temp_c", 7, w, 1)
    if "pressure_hpa" in has:
        made["pressure_ma3"] = windows.rolling_column("pressure_hpa", 3, w, 1)
        made["pressure_grad"] = F.coalesce(
            F.col("pressure_hpa") - F.lag("pressure_hpa", 1).over(w), F.lit(0.0))
    if "precip_mm" in has:
        made["precip_ma3"] = windows.rolling_column("precip_mm", 3, w, 1)
    return dry_index_proxy(df.withColumns(made)).na.drop("any")


def sequence_table(daily: DataFrame, site: str = "site_id", date: str = "date") -> DataFrame:
    """Sequence features, flags and next-day target."""
    return sequence_targets(add_sequence_features(daily, site, date), site, date)


def sequence_targets(featured: DataFrame, site: str = "site_id", date: str = "date") -> DataFrame:
    """M12, second half: flags and next-day target on rows that have their features."""
    flagged = labels.event_flags(
        featured, heat="temp_c", cold="temp_c",
        wind="wind_speed" if "wind_speed" in featured.columns else None,
        rain="precip_mm" if "precip_mm" in featured.columns else None,
    )
    return windows.next_target(flagged, site=site, order=date).na.drop("any")
