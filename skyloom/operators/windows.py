"""Row-based windows over one daily series per site.

A daily table holds at most one row per site and calendar day, so a site's window is bounded by the
calendar (36,525 rows per century) however many readings the site sent. Sub-daily series have no
such bound; see ``series.previous_value`` for those.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

SITE, DATE = "site_id", "date"


def site_window(site: str | list[str] = SITE, order: str = DATE) -> WindowSpec:
    keys = [site] if isinstance(site, str) else list(site)
    return Window.partitionBy(*keys).orderBy(order)


def rolling_column(name: str, n: int, window: WindowSpec, min_periods: int | None = None) -> Column:
    """Mean of the last ``n`` rows; NULL with fewer than ``min_periods`` (default ``n``) values."""
    frame = window.rowsBetween(-(n - 1), 0)
    mean = F.avg(name).over(frame)
    need = n if min_periods is None else min_periods
    return mean if need <= 1 else F.when(F.count(name).over(frame) >= need, mean)


def rolling_mean(
    df: DataFrame, cols: Iterable[str], sizes: Iterable[int], min_periods: int | None = None,
    site=SITE, order=DATE,
) -> DataFrame:
    """W1 (strict) and W2 (``min_periods=1``): adds ``{col}_ma{n}``."""
    w = site_window(site, order)
    return df.withColumns({f"{c}_ma{n}": rolling_column(c, n, w, min_periods) for n in sizes for c in cols})


def lags(df: DataFrame, cols: Iterable[str], steps: Iterable[int], site=SITE, order=DATE) -> DataFrame:
    """Adds ``{col}_lag{k}``."""
    w = site_window(site, order)
    return df.withColumns({f"{c}_lag{k}": F.lag(c, k).over(w) for k in steps for c in cols})


def gradient(df: DataFrame, col: str, name: str, fill: float | None = None, site=SITE, order=DATE) -> DataFrame:
    """W4, and W5 with ``fill``: difference to the previous row."""
    change = F.col(col) - F.lag(col, 1).over(site_window(site, order))
    return df.withColumn(name, change if fill is None else F.coalesce(change, F.lit(fill)))


def next_target(df: DataFrame, event: str = "event_extreme", name: str = "target", site=SITE, order=DATE) -> DataFrame:
    """The flag of the next row."""
    return df.withColumn(name, F.lead(event, 1).over(site_window(site, order)))


def segments(df: DataFrame, max_gap_days: int, name: str = "segment", site=SITE, order=DATE) -> DataFrame:
    """Numbers the stretches of a series whose neighbouring days are at most a gap apart.

    Use ``[site, name]`` as the window key afterwards so that no window crosses a seam.
    """
    w = site_window(site, order)
    breaks = F.datediff(F.col(order), F.lag(order, 1).over(w)) > max_gap_days
    return (
        df.withColumn("_break", F.when(breaks, 1).otherwise(0))
        .withColumn(name, F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
        .drop("_break")
    )


def last_row(df: DataFrame, site=SITE, order=DATE) -> DataFrame:
    """Newest row per site, as a partial aggregate instead of a ranking window."""
    keys = [site] if isinstance(site, str) else list(site)
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def sequences(
    df: DataFrame, cols: list[str], length: int, include_current: bool = False, name: str = "seq",
    site=SITE, order=DATE,
) -> DataFrame:
    """The ``length`` rows before each row (or up to it), kept only where that many exist.

    Each window is an array of value arrays, at most ``length`` long.
    """
    w = site_window(site, order)
    frame = w.rowsBetween(-(length - 1), 0) if include_current else w.rowsBetween(-length, -1)
    steps = F.array(*[F.col(c).cast("double") for c in cols])
    return df.withColumn(name, F.collect_list(steps).over(frame)).filter(F.size(name) == length)


def newest_sequence(df: DataFrame, cols: list[str], length: int, site=SITE, order=DATE, name: str = "seq") -> DataFrame:
    """The newest ``length`` rows of each site; sites with fewer rows are dropped.

    Only the newest window per site is built: rows are ranked from the end first.
    """
    keys = [site] if isinstance(site, str) else list(site)
    back = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    steps = F.array(*[F.col(c).cast("double") for c in cols])
    newest = df.withColumn("_back", F.row_number().over(back)).filter(F.col("_back") <= length)
    return (
        newest.groupBy(*keys)
        .agg(F.max(order).alias(order), F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), steps.alias("v")))).alias("_s"))
        .filter(F.size("_s") == length)
        .withColumn(name, F.transform("_s", lambda s: s["v"]))
        .drop("_s")
    )
