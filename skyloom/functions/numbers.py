"""Numeric expressions shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = 134217729.0  # 2**27 + 1 halves a double's mantissa


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def clip(value, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; a missing value stays missing (greatest/least alone would skip it)."""
    value = as_column(value)
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def finite(value) -> Column:
    """Infinities and NaN become NULL."""
    value = as_column(value)
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def normalize(value, low: float, high: float) -> Column:
    """Position of a value in [low, high], clamped to [0, 1]."""
    value = as_column(value).cast("double")
    return clip((value - F.lit(float(low))) / F.lit(float(high) - float(low)), 0.0, 1.0)


def truncate(value) -> Column:
    """Toward-zero conversion to int."""
    return as_column(value).cast("int")


def zero_free(value) -> Column:
    """Replace negative zero by zero."""
    return as_column(value) + F.lit(0.0)


def round_exact(value, digits: int, ties: str = "even") -> Column:
    """Round the *binary* value of a double to ``digits`` decimals.

    ``round``/``bround`` work on the shortest decimal text of the double, so 0.1555 (stored just
    below the tie) goes up. Here the scaled value is split into two exactly representable products,
    so the comparison with one half is exact. ``ties``: ``even`` or ``up``.
    """
    value = as_column(value).cast("double")
    scale = F.lit(float(10**digits))
    spread = value * F.lit(_SPLITTER)
    high = spread - (spread - value)
    floor = F.floor(value * scale).cast("double")
    over_half = ((high * scale - floor) - F.lit(0.5)) + (value - high) * scale
    # -1, 0 or 1; a tie moves up when asked to, or when the lower neighbour is odd
    step = F.signum(over_half) + (F.lit(1.0) if ties == "up" else F.abs(floor) % F.lit(2.0))
    return (floor + (step > F.lit(0.0)).cast("double")) / scale


def exact_text(value, digits: int, ties: str = "even") -> Column:
    """Fixed-point text of the binary value of a double, sign always kept."""
    value = as_column(value).cast("double")
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, F.format_string(f"%.{digits}f", round_exact(F.abs(value), digits, ties)))
