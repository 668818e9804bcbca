"""Composed flows: batch features and encodings (the operators end to end)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyloom.operators import daily, encode, features, series


def physical_series(readings: DataFrame, slots: int = series.SLOT_MINUTES, clip_on: str = "result") -> DataFrame:
    """Sub-daily readings with physical units and de-accumulated precipitation."""
    return series.deaccumulate(series.to_physical(readings, clip_on), slots=slots)


def forest_daily(readings: DataFrame, slots: int = series.SLOT_MINUTES) -> DataFrame:
    """Readings to the daily table of the forest features (A2)."""
    return daily.daily_forest(physical_series(readings, slots))


def forest_features(readings: DataFrame, slots: int = series.SLOT_MINUTES) -> DataFrame:
    """Readings to the labelled feature table (M11), the flagship flow."""
    return features.add_features(forest_daily(readings, slots))


def sequence_daily(readings: DataFrame, slots: int = series.SLOT_MINUTES) -> DataFrame:
    """Readings to the daily table of the sequence features (A3)."""
    return daily.daily_sequence(physical_series(readings, slots))


def sequence_features(readings: DataFrame, slots: int = series.SLOT_MINUTES) -> DataFrame:
    """Readings to the labelled sequence table."""
    return features.sequence_table(sequence_daily(readings, slots))


def encoded(obs: DataFrame) -> DataFrame:
    """Flat readings with visual parameters and dominance."""
    return encode.dominance(encode.visual_params(obs))

