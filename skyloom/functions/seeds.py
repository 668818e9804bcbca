"""Reproducible per-row random draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.numbers import as_column

_TWO_31 = 1 << 31
_TWO_32 = 1 << 32


def _wrap_int32(value: Column) -> Column:
    return F.pmod(value + F.lit(_TWO_31), F.lit(_TWO_32)) - F.lit(_TWO_31)


def _mix(total: Column, unit: Column) -> Column:
    return _wrap_int32(total * F.lit(31) + unit.cast("long"))


def _mix_character(total: Column, char: Column) -> Column:
    """Fold one character in as its UTF-16 code units: one, or a surrogate pair."""
    code = F.ascii(char)
    above = code - F.lit(0x10000)
    high, low = F.lit(0xD800) + F.shiftright(above, 10), F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF))
    return (
        F.when(char == F.lit(""), total)
        .when(code <= F.lit(0xFFFF), _mix(total, code))
        .otherwise(_mix(_mix(total, high), low))
    )


def _mix_digits(total: Column, number: Column, digits: int) -> Column:
    """Fold in the last ``digits`` decimal digits of a whole number, in one step of arithmetic.

    The hash is a polynomial in 31, so the digits and what stands before them add up with fixed weights.
    """
    value = total * F.lit(pow(31, digits, _TWO_32))
    for k in range(digits):
        digit = F.floor(number / F.lit(10 ** (digits - 1 - k))).cast("long") % 10
        value = value + (digit + F.lit(ord("0"))) * F.lit(31 ** (digits - 1 - k))
    return _wrap_int32(value)


def seed(date, hour, city) -> Column:
    """31-polynomial hash of date digits, hour and city, wrapped to 32 bits, absolute value.

    Dates have four-digit years and hours at most two digits; only the city is read by character.
    """
    day, at = as_column(date), as_column(hour).cast("long")
    number = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    dated = _mix_digits(F.lit(0).cast("long"), number, 8)
    start = F.when(at < 10, _mix_digits(dated, at, 1)).otherwise(_mix_digits(dated, at, 2))
    hashed = F.aggregate(F.split(as_column(city), ""), start, _mix_character)
    return F.when(hashed == 0, F.lit(K.DEFAULT_SEED).cast("long")).otherwise(F.abs(hashed))


def draws(seed_value, count: int) -> Column:
    """``count`` uniform draws in [0, 1) from a 32-bit shift-register generator."""
    start = F.struct(
        _wrap_int32(as_column(seed_value).cast("long")).cast("int").alias("state"),
        F.array().cast("array<double>").alias("out"),
    )

    def step(acc, _):
        a = acc["state"]
        b = a.bitwiseXOR(F.shiftleft(a, 13))
        c = b.bitwiseXOR(F.shiftrightunsigned(b, 17))
        d = c.bitwiseXOR(F.shiftleft(c, 5))
        unsigned = F.pmod(d.cast("long"), F.lit(_TWO_32))
        return F.struct(
            d.alias("state"), F.concat(acc["out"], F.array(unsigned / F.lit(float(_TWO_32)))).alias("out")
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(count)), start, step)["out"]
