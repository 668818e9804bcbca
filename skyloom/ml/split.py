"""Time-ordered folds and splits (W12, W13, J7), scaling (A13), class weights (M2), column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.operators.ranking import date_positions
from skyloom.session import durable


MOST_DATES = 100_000  # rows of a date table that is sent to every task: almost three centuries


def with_dates(df: DataFrame, dates: DataFrame, date: str = "date") -> DataFrame:
    """``df`` with the columns of a table that has one row per date.

    Such a table grows with the calendar, not with the data. It is counted, and broadcast up to ``MOST_DATES`` rows, so that the
    rows of ``df`` stay where they are.
    """
    dates = durable(dates, "dates")
    return df.join(F.broadcast(dates) if dates.count() <= MOST_DATES else dates, date)


def with_position(df: DataFrame, site: str | None = None, date: str = "date") -> DataFrame:
    """Zero-based place in time order, ``position``, and row count, ``total``.

    Per site the place is the row number in that site's series (one row per day at most). Without a
    site the whole table is ordered by date and rows of one date share the place of the first of
    them, so a cut never parts a date; for a single series both are the plain row number.
    """
    if site is not None:
        w = Window.partitionBy(site)
        return df.withColumns({
            "position": (F.row_number().over(w.orderBy(date)) - 1).cast("long"),
            "total": F.count(F.lit(1)).over(w),
        })
    return with_dates(df, date_positions(df, date), date)


def fold_column(k: int, position: str = "position", total: str = "total") -> Column:
    """Test fold 1..k of a row, 0 for the rows that only ever train."""
    size = F.floor(F.col(total) / F.lit(k + 1))
    first = F.col(total) - F.lit(k) * size
    fold = F.floor((F.col(position) - first) / F.nullif(size, F.lit(0))) + 1
    return F.when(F.col(position) < first, F.lit(0)).otherwise(fold).cast("int")


def ts_folds(df: DataFrame, k: int = K.FOLDS, site: str | None = None, date: str = "date") -> DataFrame:
    """Adds ``fold``. Fold ``i`` tests on its own rows and trains on every row of a lower fold."""
    return with_position(df, site, date).withColumn("fold", fold_column(k))


def fold_membership(folded: DataFrame, k: int = K.FOLDS) -> DataFrame:
    """One row per (row, fold) it takes part in, with its role.

    A row tests in its own fold and trains in all later ones, so the folds follow from arithmetic:
    a generator of at most ``k`` numbers per row instead of a join with the fold table.
    """
    first = F.greatest(F.col("fold"), F.lit(1))
    return folded.withColumn("in_fold", F.explode(F.sequence(first, F.lit(k)))).withColumn(
        "role", F.when(F.col("in_fold") == F.col("fold"), "test").otherwise("train"))


def temporal_split(
    df: DataFrame, train: float = K.TRAIN_FRACTION, val: float = K.VALIDATION_FRACTION, gap: int = K.SPLIT_GAP,
    site: str | None = None, date: str = "date",
) -> DataFrame:
    """Adds ``split``: train, gap, val, test. Only train and val are parted by a gap.

    The gap is counted in distinct dates, so a validation window of at most ``gap`` days holds no
    training day however many sites share a date; per site, or for one series, these are its rows.
    """
    train_end = F.floor(F.col("total") * F.lit(float(train)))
    val_end = F.floor(F.col("total") * F.lit(float(train) + float(val)))
    at = F.col("position")
    if site is None:
        every = Window.partitionBy(F.lit(0))  # one row per date
        dates = date_positions(df, date).withColumns({
            "_day": F.row_number().over(every.orderBy(date)) - 1,
            "_train_days": F.count(F.when(at < train_end, True)).over(every),
        })
        placed = with_dates(df, dates, date)
    else:
        placed = with_position(df, site, date).withColumns({"_day": at, "_train_days": train_end})
    return placed.withColumn(
        "split",
        F.when(at < train_end, "train").when(at >= val_end, "test")
        .when(F.col("_day") < F.col("_train_days") + F.lit(gap), "gap").otherwise("val"),
    ).drop("_day", "_train_days")


# ---------------------------------------------------------------- scaling
def fit_scaler(train: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row with the mean and population deviation per column (zero deviation becomes 1)."""
    stats = []
    for c in cols:
        std = F.stddev_pop(c)
        stats += [F.avg(c).alias(f"{c}_mean"), F.when(std == 0, F.lit(1.0)).otherwise(std).alias(f"{c}_std")]
    return train.agg(*stats)


def apply_scaler(df: DataFrame, stats: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Standardise with the fitted one-row statistics, read as a scalar subquery."""
    packed = stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias("s")).scalar()
    with_stats = df.withColumn("_s", packed)
    return with_stats.withColumns({
        c: (F.col(c) - F.col(f"_s.{c}_mean")) / F.col(f"_s.{c}_std") for c in cols
    }).drop("_s")


def class_weights(df: DataFrame, label: str = "target", name: str = "weight") -> DataFrame:
    """M2: balancing weight ``n / (2 n_class)`` per row, from two counts read as a scalar subquery."""
    counts = df.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")).alias("c")).scalar()
    members = F.when(F.col(label) == 1, F.col("_c.pos")).otherwise(F.col("_c.n") - F.col("_c.pos"))
    return df.withColumn("_c", counts).withColumn(
        name, F.col("_c.n") / (F.lit(2.0) * members)).drop("_c")


# ---------------------------------------------------------------- columns
def feature_columns(df: DataFrame, keys: Iterable[str] = ("site_id", "date")) -> list[str]:
    """Every column but keys, target and event flags."""
    skip = {*keys, "target", *K.EVENT_FLAGS}
    return [c for c in df.columns if c not in skip]


def align_columns(df: DataFrame, cols: Iterable[str], keep: Iterable[str] = (), fill: float = 0.0) -> DataFrame:
    """The ordered model input; an absent column is filled, a present one keeps its NULLs."""
    has = set(df.columns)
    return df.select(*keep, *[
        (F.col(c).cast("double") if c in has else F.lit(float(fill))).alias(c) for c in cols])


def require_columns(df: DataFrame, cols: Iterable[str], strict: bool = True) -> tuple[list[str], list[str]]:
    """Wanted columns that exist and those that do not; ``strict`` raises on the latter."""
    cols = list(cols)
    present = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise ValueError(f"missing columns: {missing}")
    return present, missing
