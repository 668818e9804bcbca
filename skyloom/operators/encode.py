"""Encoded readings: visual parameters and dominance as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions import visual as V
from skyloom.functions.numbers import round_exact
from skyloom.operators.history import with_defaults

READING_DEFAULTS = {"rain_1h": 0.0, "weather_id": K.DEFAULT_WEATHER_ID, "clouds": K.DEFAULT_CLOUDS}


def visual_params(df: DataFrame) -> DataFrame:
    """Adds the encoding parameters, with optional inputs defaulted."""
    scaled = V.norms(prefix="_")
    # two projections: each norm is computed once and the generated code stays small enough to compile well
    return with_defaults(df, READING_DEFAULTS).withColumns(scaled).withColumns(V.visual_columns("_")).drop(*scaled)


def visual_record(df: DataFrame, raw: list[str] | None = None) -> DataFrame:
    """Encoded reading with its source columns nested under ``raw``."""
    raw = raw or df.columns
    return visual_params(df).withColumn("raw", F.struct(*[F.col(c) for c in raw]))


def dominance(df: DataFrame, rounded: bool = False) -> DataFrame:
    """K4, K5: dominant variable, its strength, the runner-up and the co-dominant variable."""
    ranked = df.withColumn("_rank", V.ranked_scores(rounded))
    first, second = F.element_at("_rank", 1), F.element_at("_rank", 2)
    return (
        ranked.withColumns({
            "dominant": first["name"],
            "dominant_strength": F.lit(0.0) - first["below"],
            "second": second["name"],
            "second_strength": F.lit(0.0) - second["below"],
        })
        .withColumn("dominant2", V.codominant("dominant", "second"))
        .drop("_rank")
    )


def scores_long(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per reading and variable, six rows per reading."""
    shown = V.score_map(rounded=True)
    return (
        df.select(*keep, "dominant", "dominant2", F.explode(shown).alias("name", "score"))
        .withColumns({
            "percent": round_exact(F.col("score") * F.lit(100.0), 0, ties="up").cast("int"),
            "is_dom": F.col("name") == F.col("dominant"),
            "is_codom": F.coalesce(F.col("name") == F.col("dominant2"), F.lit(False)),
        })
        .drop("dominant", "dominant2")
    )
