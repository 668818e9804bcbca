"""Unit conversions and derived physical quantities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.numbers import as_column, clip


def celsius(kelvin) -> Column:
    """P2."""
    return as_column(kelvin) - F.lit(K.KELVIN_OFFSET)


def hectopascal(pascal) -> Column:
    """P3."""
    return as_column(pascal) / F.lit(K.PASCAL_PER_HPA)


def wind_speed(u, v) -> Column:
    """Length of the wind vector."""
    u, v = as_column(u), as_column(v)
    return F.sqrt(u * u + v * v)


def _magnus(celsius_value: Column) -> Column:
    return (F.lit(K.MAGNUS_A) * celsius_value) / (F.lit(K.MAGNUS_B) + celsius_value)


def humidity(dewpoint_c, temp_c, clip_on: str = "result") -> Column:
    """Relative humidity in percent.

    ``result`` bounds the percentage to [0, 100]. ``ratio`` bounds the ratio to [0, 100] before
    scaling, so the percentage may pass 100, as the sequence features expect.
    """
    ratio = F.exp(_magnus(as_column(dewpoint_c)) - _magnus(as_column(temp_c)))
    if clip_on == "result":
        return clip(F.lit(100.0) * ratio, 0.0, 100.0)
    if clip_on == "ratio":
        return F.lit(100.0) * clip(ratio, 0.0, 100.0)
    raise ValueError(f"clip_on must be 'result' or 'ratio', not {clip_on!r}")


def cloud_fraction(percent) -> Column:
    """P10."""
    return as_column(percent) / F.lit(100.0)
