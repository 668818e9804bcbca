"""Event labels and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.numbers import as_column, round_exact


def event_flags(
    df: DataFrame, heat: str = "temp_c_max", cold: str = "temp_c_max",
    wind: str | None = "wind_speed_max", rain: str | None = "precip_mm_sum",
) -> DataFrame:
    """0/1 flags per threshold and their OR. An absent source gives 0."""

    def flag(col, test):
        return F.lit(0) if col is None else F.coalesce(test(F.col(col)), F.lit(False)).cast("int")

    flags = {
        "event_heat": flag(heat, lambda c: c >= K.HEAT_MIN_C),
        "event_cold": flag(cold, lambda c: c <= K.COLD_MAX_C),
        "event_wind": flag(wind, lambda c: c >= K.WIND_MIN_MS),
        "event_rain": flag(rain, lambda c: c >= K.RAIN_MIN_MM),
    }
    return df.withColumns({**flags, "event_extreme": F.greatest(*flags.values())})


def _rules(tmax, tmin, wind, wind_limit, cloud, hum) -> Column:
    return (
        F.when(tmax >= K.RULE_HEAT_C, "heat")
        .when(tmin <= K.RULE_COLD_C, "cold")
        .when(wind >= wind_limit, "wind")
        .when((cloud > K.RULE_CLOUD_PCT) & (hum > K.RULE_HUMIDITY_PCT), "rain")
        .otherwise("none")
    )


def event_type(rules: str = "reading") -> Column:
    """X9 (``reading``: one flat reading) and X10 (``history``: a daily row)."""
    if rules == "reading":
        given = {c: F.coalesce(F.col(c).cast("double"), F.lit(d)) for c, d in K.POINT_DEFAULTS.items()}
        return _rules(
            given["temperature"] + K.POINT_TEMP_ABOVE, given["temperature"] - K.POINT_TEMP_BELOW,
            given["wind_speed"] * K.POINT_WIND_GUST, K.RULE_WIND_READING_MS, given["clouds"], given["humidity"],
        )
    if rules == "history":
        return _rules(
            F.col("temp_c_max"), F.col("temp_c_min"), F.col("wind_speed_max"), K.RULE_WIND_HISTORY_MS,
            F.col("cloud_cover_mean") * F.lit(100.0), F.col("humidity_mean"),
        )
    raise ValueError(f"rules must be 'reading' or 'history', not {rules!r}")


def decision(df: DataFrame, threshold, prob: str = "prob") -> DataFrame:
    """X11: rounded probability, 0/1 decision and its label."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    over = as_column(prob) >= limit
    return df.withColumns({
        "prob": round_exact(prob, 4),
        "prediction": over.cast("int"),
        "threshold": limit,
        "label_text": F.when(over, K.DECISION_LABELS[1]).otherwise(K.DECISION_LABELS[0]),
    })


def threshold_counts(df: DataFrame, tests: dict[str, tuple[str, str, float]]) -> DataFrame:
    """number of rows past each bound, ``{name: (column, '>=' or '<=', bound)}``, in one pass."""

    def passed(col, op, bound):
        return F.col(col) >= bound if op == ">=" else F.col(col) <= bound

    return df.agg(*[F.count_if(passed(*test)).alias(name) for name, test in tests.items()])
