"""Date and time expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import constants as K
from skyloom.functions.numbers import as_column


def season(date, period: float = K.YEAR_DAYS_FOREST) -> tuple[Column, Column]:
    """Sine and cosine of the day of the year."""
    angle = F.lit(2.0 * math.pi) * F.dayofyear(as_column(date)) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def local_clock(df: DataFrame, ts: str, zone: str = K.LOCAL_ZONE) -> Column:
    """The wall clock in ``zone`` for a UTC instant, as a zone-less timestamp."""
    if is_ntz(df, ts):
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts))
    here = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit(here), F.lit(zone), F.col(ts).cast("timestamp_ntz"))


def local_time(df: DataFrame, ts: str = "ts", zone: str = K.LOCAL_ZONE) -> DataFrame:
    """Local ``datetime`` text, ``date`` and ``hour`` of each reading."""
    clock = local_clock(df, ts, zone)
    return df.withColumns({
        "datetime": F.date_format(clock, "yyyy-MM-dd HH:mm"),
        "date": F.to_date(clock),
        "hour": F.hour(clock),
    })


def minute_bucket(df: DataFrame, ts: str, minutes: int) -> Column:
    """Ordinal of the ``minutes``-long slot a timestamp falls in, monotone in the timestamp."""
    kind = df.schema[ts].dataType
    if isinstance(kind, T.DateType):
        ordinal = F.unix_date(F.col(ts)).cast("long") * F.lit(1440)
    elif isinstance(kind, T.TimestampNTZType):
        ordinal = (
            F.unix_date(F.to_date(F.col(ts))).cast("long") * F.lit(1440)
            + F.hour(F.col(ts)) * F.lit(60) + F.minute(F.col(ts))
        )
    else:
        ordinal = F.floor(F.unix_seconds(F.col(ts)) / F.lit(60))
    return F.floor(ordinal / F.lit(minutes)).cast("long")


def asset_path(city, date, hour, prefix: str, extension: str = "png", folder: str | None = "output") -> Column:
    """``folder/prefix_city_date_HHh.ext`` with blanks in the city replaced."""
    name = F.concat(
        F.lit(prefix + "_"), F.translate(as_column(city), " ", "_"), F.lit("_"),
        F.date_format(as_column(date), "yyyy-MM-dd"), F.lit("_"),
        F.lpad(as_column(hour).cast("string"), 2, "0"), F.lit("h." + extension),
    )
    return F.concat(F.lit(folder + "/"), name) if folder else name
