"""Sub-daily series per site: previous value and de-accumulation (W6), grid merge (J1, A1), cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions import physics
from skyloom.functions.calendar import minute_bucket
from skyloom.functions.numbers import clip, finite


def rename_grid(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename the columns that exist; either time name becomes ``ts``."""
    names = {"valid_time": "ts", "time": "ts", **(mapping or K.GRID_NAMES)}
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def merge_grid(instant: DataFrame, accum: DataFrame) -> DataFrame:
    """Inner merge of instant and accumulated variables on time and cell.

    Both sides are unique on the key, so no key is hot; Spark picks the join by size.
    """
    return instant.join(accum, ["valid_time", "latitude", "longitude"], "inner")


def boxed(df: DataFrame, boxes: DataFrame | list[tuple], tile: float = 1.0) -> DataFrame:
    """Rows of ``df`` with the ``site_id`` of every box (``site_id, north, west, south, east``) that holds their cell.

    A spatial index: each box lists the tiles of ``tile`` degrees that it touches, rows meet boxes on the tile and are
    tested exactly there. So a row is compared with the boxes of its tile only, and the plan does not grow with the number of
    sites. A row in several boxes belongs to each of them; one in none is left out. Spark broadcasts the boxes if they are few.
    """
    if isinstance(boxes, list):
        kind = "string" if isinstance(boxes[0][0], str) else "int"
        boxes = df.sparkSession.createDataFrame(
            [(s, *map(float, edges)) for s, *edges in boxes],
            f"site_id {kind}, north double, west double, south double, east double")

    def tiles(low, high):
        return F.explode(F.sequence(F.floor(F.col(low) / tile), F.floor(F.col(high) / tile)))

    listed = boxes.where("south <= north AND west <= east").withColumn("_ty", tiles("south", "north")).withColumn(
        "_tx", tiles("west", "east"))
    placed = df.withColumns({"_ty": F.floor(F.col("latitude") / tile), "_tx": F.floor(F.col("longitude") / tile)})
    inside = F.col("latitude").between(F.col("south"), F.col("north")) & F.col("longitude").between(F.col("west"), F.col("east"))
    return placed.join(listed, ["_ty", "_tx"]).where(inside).drop("_ty", "_tx", "north", "west", "south", "east")


def box_cells(cells: DataFrame, sites: DataFrame | list[tuple], tile: float = 1.0) -> DataFrame:
    """``site_id, latitude, longitude`` of the grid cells in each box."""
    return boxed(cells.select("latitude", "longitude").distinct(), sites, tile).select("site_id", "latitude", "longitude")


def grid_mean(
    df: DataFrame, sites: DataFrame | list[tuple] | None = None, cells: DataFrame | None = None, time: str = "valid_time",
    tile: float = 1.0,
) -> DataFrame:
    """A1: spatial mean per time step, optionally per site.

    ``sites`` are boxes, as a table or a list; ``cells`` instead says which cells make up a site. Partial aggregation runs
    before the shuffle, so a site with many cells is no hot key.
    """
    means = [F.avg(c).alias(c) for c in df.columns if c not in (time, "latitude", "longitude")]
    if cells is None and sites is None:
        return df.groupBy(time).agg(*means)
    joined = boxed(df, sites, tile) if cells is None else df.join(cells, ["latitude", "longitude"])
    return joined.groupBy("site_id", time).agg(*means)


def drop_untimed(df: DataFrame, ts: str = "ts") -> DataFrame:
    """F1."""
    return df.dropna(subset=[ts])


def to_physical(df: DataFrame, clip_on: str = "result") -> DataFrame:
    """P2-P5, P8 over whichever source columns exist."""
    has = set(df.columns)
    made = {}
    if "temp_k" in has:
        made["temp_c"] = physics.celsius("temp_k")
    if "dewpoint_k" in has:
        made["dewpoint_c"] = physics.celsius("dewpoint_k")
    if "pressure_pa" in has:
        made["pressure_hpa"] = physics.hectopascal("pressure_pa")
    if {"wind_u", "wind_v"} <= has:
        made["wind_speed"] = physics.wind_speed("wind_u", "wind_v")
    if {"temp_k", "dewpoint_k"} <= has:
        made["humidity"] = physics.humidity(made["dewpoint_c"], made["temp_c"], clip_on)
    cleaned = {name: finite(value) for name, value in made.items()}
    if "cloud_cover" in has:
        cleaned["cloud_cover"] = finite(F.col("cloud_cover").cast("double"))
    return df.withColumns(cleaned)


SLOT_MINUTES = 60


def previous_value(
    df: DataFrame, value: str, name: str, site: str = "site_id", ts: str = "ts",
    tie: str | None = "event_id", slots: int = SLOT_MINUTES,
) -> DataFrame:
    """The value one row earlier in the site's series, safe for a site with a third of all rows.

    A plain ``lag`` over the site would sort a hot site's whole history in one task. The series is
    cut into time slots of ``slots`` minutes instead, the same for every input: ``lag`` runs inside
    (site, slot), and the last value of each slot is carried to the first row of the site's next
    one. A slot has as many rows as a site reports in it, and a site as many slots as the calendar
    (8,760 a year), so both windows stay small whatever the table holds; only a site that reports
    everything within one slot would need a shorter one.
    """
    order = [ts] + ([tie] if tie else [])
    cut = df.withColumn("_cut", minute_bucket(df, ts, slots))
    inside = Window.partitionBy(site, "_cut").orderBy(*order)
    local = cut.withColumn("_lag", F.lag(F.struct(F.col(value).alias("v")), 1).over(inside))
    ends = cut.groupBy(site, "_cut").agg(F.max_by(F.col(value), F.struct(*order)).alias("_end"))
    carried = ends.select(
        site, "_cut", F.lag("_end", 1).over(Window.partitionBy(site).orderBy("_cut")).alias("_carry"))
    return local.join(carried, [site, "_cut"], "left").withColumn(
        name, F.when(F.col("_lag").isNotNull(), F.col("_lag.v")).otherwise(F.col("_carry"))
    ).drop("_cut", "_lag", "_carry")


def deaccumulate(
    df: DataFrame, col: str = "precip_m", name: str = "precip_mm", scale: float = K.MM_PER_METRE,
    site: str = "site_id", ts: str = "ts", tie: str | None = "event_id", slots: int = SLOT_MINUTES,
) -> DataFrame:
    """Positive part of the step of an accumulated series; the first row of a site is NULL."""
    stepped = previous_value(df, col, "_before", site, ts, tie, slots)
    return stepped.withColumn(
        name, finite(clip(F.col(col) - F.col("_before"), low=0.0) * F.lit(scale))
    ).drop("_before")
