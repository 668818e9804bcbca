"""Streaming history.

Every micro-batch writes its own partitions and never touches those of another batch. Replaying a
batch after a failure overwrites exactly what it wrote before, so nothing is lost or doubled. Readers
take the last write per key, which makes arrival order irrelevant.

Readings and archive lie under ``date=…/batch_id=…``, because a batch is refreshed by the days it
touches; daily and live rows under ``bucket=…/batch_id=…`` (a hash of the site), because features are
refreshed by site.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyloom import constants as K
from skyloom import schemas
from skyloom.functions.calendar import local_time
from skyloom.ml.scoring import predict_daily
from skyloom.operators import daily, features, history
from skyloom.session import durable, path_exists
from skyloom.sources import readings as landed

KEYS = ["site_id", "date", "hour"]
SEQ = ["ts", "event_id"]


@dataclass(frozen=True)
class History:
    """Folders of a history and the keys of its readings."""

    root: str
    keys: tuple[str, ...] = tuple(KEYS)
    seq: tuple[str, ...] = tuple(SEQ)
    buckets: int = 64

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"


def ingest(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int = 1000,
) -> DataFrame:
    """Landed files as a stream with an explicit schema."""
    return (
        spark.readStream.format(fmt).schema(schema)
        .option("maxFilesPerTrigger", files_per_batch).load(path)
    )


def ingest_documents(
    spark: SparkSession, weather: str, air: str, extra: tuple[T.StructField, ...] = (), near: str = "1 hour",
    delay: str = "1 day", zone: str = K.LOCAL_ZONE, files_per_batch: int = 1000,
) -> DataFrame:
    """Landed JSON documents of both kinds as one stream of flat readings with local-zone keys.

    Both kinds are streams. A weather document meets the air documents of its coordinates that are at most ``near`` older;
    the watermarks (``delay``) and this bound let Spark drop documents from the join's state that no later one can
    meet. Where several air documents match, every match is a row, and ``air_gap`` (seconds between the two) lets a
    history keep the closest: put ``-air_gap`` last into its order. Documents without coordinates or time match nothing.
    ``extra`` names further fields of the weather documents to keep.
    """
    options = {"maxFilesPerTrigger": files_per_batch}
    fields = T.StructType([*schemas.LANDED_WEATHER.fields, *extra])
    documents = spark.readStream.schema(fields).options(**options).json(weather)
    kept = [f.name for f in extra]
    readings_ = documents.select(
        F.timestamp_seconds("dt").alias("ts"), *kept, F.struct(*schemas.WEATHER.fieldNames()).alias("weather_doc")
    ).select("ts", *kept, *[c.alias(n) for n, c in landed.weather_columns().items()]).withWatermark("ts", delay)
    quality = spark.readStream.schema(schemas.LANDED_AIR).options(**options).json(air).select(
        F.struct("coord", "list").alias("air_doc")
    ).select(
        F.timestamp_seconds(F.get("air_doc.list", 0)["dt"]).alias("air_ts"), F.col("air_doc.coord.lat").alias("air_lat"),
        F.col("air_doc.coord.lon").alias("air_lon"), *[c.alias(n) for n, c in landed.air_columns().items()]
    ).withWatermark("air_ts", delay)
    bound = F.expr(f"INTERVAL {near}")
    met = readings_.join(
        quality, (F.col("lat") == F.col("air_lat")) & (F.col("lon") == F.col("air_lon"))
        & (F.col("air_ts") <= F.col("ts")) & (F.col("air_ts") > F.col("ts") - bound))
    gap = F.unix_seconds("ts") - F.unix_seconds("air_ts")
    return local_time(met.withColumn("air_gap", gap).drop("air_ts", "air_lat", "air_lon"), "ts", zone)


def _write(df: DataFrame, batch_id: int, path: str, by: str = "date") -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long")).hint("rebalance", by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(by, "batch_id").parquet(path)
    )


def _bucket(store: History):
    return F.pmod(F.hash("site_id"), F.lit(store.buckets)).cast("int")


def _write_sites(df: DataFrame, batch_id: int, store: History, table: str) -> None:
    _write(df.withColumn("bucket", _bucket(store)), batch_id, store.folder(table), "bucket")


def _pruned(df: DataFrame, partition: str, values: list | None) -> DataFrame:
    return df if values is None else df.filter(F.col(partition).isin(values))


def readings(
    spark: SparkSession, store: History, dates: list | None = None, touched: DataFrame | None = None,
) -> DataFrame:
    """Current readings: the last write per key; ``dates`` prunes to those partitions.

    ``touched`` (site_id, date) keeps the rows of these days only, before writes are compared.
    """
    log = _pruned(spark.read.parquet(store.folder("raw")), "date", dates)
    if touched is not None:
        log = log.join(touched, ["site_id", "date"], "left_semi")
    return history.latest(log, list(store.keys), list(store.seq)).drop("batch_id")


def days(
    spark: SparkSession, store: History, buckets: list | None = None, sites: DataFrame | None = None,
) -> DataFrame:
    """Current daily rows: the newest batch's row per site and date; ``buckets`` prunes partitions.

    ``sites`` (site_id) keeps the rows of these sites only, before writes are compared.
    """
    log = _pruned(spark.read.parquet(store.folder("daily")), "bucket", buckets)
    if sites is not None:
        log = log.join(sites, "site_id", "left_semi")
    return history.latest(log, ["site_id", "date"], ["batch_id"]).drop("batch_id", "bucket")


def table(spark: SparkSession, store: History, name: str, keys: list[str]) -> DataFrame:
    """Current rows of any other table of the history."""
    log = spark.read.parquet(store.folder(name))
    return history.latest(log, keys, ["batch_id"]).drop("batch_id", "bucket")


def touched_dates(batch: DataFrame) -> list:
    """Dates a batch writes to; their number is bounded by the calendar."""
    return [row["date"] for row in batch.select("date").distinct().collect()]


def touched_buckets(batch: DataFrame, store: History) -> list:
    """Site buckets a batch writes to, at most ``store.buckets``."""
    return [row["bucket"] for row in batch.select(_bucket(store).alias("bucket")).distinct().collect()]


def upsert_batch(batch: DataFrame, batch_id: int, store: History) -> None:
    """The batch's last write per key goes to the batch's own partitions."""
    _write(history.latest(batch, list(store.keys), list(store.seq)), batch_id, store.folder("raw"))


def refresh_days(batch: DataFrame, batch_id: int, store: History) -> None:
    """Recompute the (site, date) pairs the batch touched, whatever their age (T6 ``recompute``)."""
    spark = batch.sparkSession
    touched = batch.select("site_id", "date").distinct()
    current = readings(spark, store, touched_dates(batch), touched)
    _write_sites(daily.daily_live(current, touched=batch), batch_id, store, "daily")


def refresh_status(batch: DataFrame, batch_id: int, store: History) -> None:
    """T4: live features and readiness of the sites the batch touched."""
    spark = batch.sparkSession
    known = days(spark, store, touched_buckets(batch, store), batch.select("site_id").distinct())
    counts = known.groupBy("site_id").agg(F.count(F.lit(1)).alias("days"))
    live = features.live_features(known).join(counts.withColumns(daily.readiness("days")), "site_id")
    _write_sites(live, batch_id, store, "live")


#: A day enters the features of its site's next rows: the longest mean covers this many rows after it, the longest lag fewer.
REACH = max(max(K.ROLL_SIZES) - 1, *K.LAG_STEPS)


def depending_days(known: DataFrame, touched: DataFrame, site: str = "site_id", date: str = "date") -> DataFrame:
    """Features of the touched days and of all later rows that depend on one of them.

    ``known`` holds all days of the touched sites, the touched ones (``site``, ``date``) among them.
    """
    behind = Window.partitionBy(site).orderBy(date).rowsBetween(-REACH, Window.currentRow)
    marked = features.live_history(known, site, date).join(
        touched.select(site, date, F.lit(True).alias("_touched")), [site, date], "left")
    return marked.withColumn("_reached", F.max("_touched").over(behind)).where("_reached").drop("_touched", "_reached")


def score_batch(
    batch: DataFrame, batch_id: int, store: History, model: PipelineModel, cols: list[str],
    entries: Callable[[DataFrame, DataFrame], DataFrame], shown: tuple[str, ...] = (),
) -> None:
    """T5: write the archive entries of every day whose risk this batch changes.

    A late reading changes the features of its own day and of up to ``REACH`` later rows of its site. All readings of
    these days, also those of earlier batches, get their entries again from the features as they are now; readers take
    the newest. So the archive does not depend on how readings fall into batches. ``entries(readings, risk)`` turns
    readings and the risk per site and date (with the feature columns ``shown``) into archive rows.
    """
    spark = batch.sparkSession
    known = days(spark, store, touched_buckets(batch, store), batch.select("site_id").distinct())
    as_of = durable(depending_days(known, batch.select("site_id", "date").distinct()), "as-of")
    keys = ["site_id", "date"]
    risk = predict_daily(model, as_of, cols, keys).join(as_of.select(*keys, *shown), keys)
    current = readings(spark, store, touched_dates(as_of), as_of.select(*keys))
    _write(entries(current, risk), batch_id, store.folder("archive"))


def run(stream: DataFrame, store: History, *steps: Callable[[DataFrame, int, History], None]) -> StreamingQuery:
    """Start the stream with the given per-batch steps; it stops when all landed files are read.

    The batch is cached while its steps run because each of them scans it.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for step in steps:
                step(batch, batch_id, store)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(each).trigger(availableNow=True)
        .option("checkpointLocation", store.folder("_progress")).start()
    )


def upsert_stream(stream: DataFrame, store: History) -> StreamingQuery:
    """T2."""
    return run(stream, store, upsert_batch)


def on_time(batch: DataFrame, batch_id: int, store: History, delay: str, ts: str = "ts") -> DataFrame:
    """The readings that are not older than the newest of all earlier batches less ``delay``.

    The newest time of every batch stands beside the log under its number, so the limit survives a restart, and a batch
    that is replayed sees the limit it saw before.
    """
    spark = batch.sparkSession
    folder = store.folder("newest")
    limit = None
    if path_exists(spark, folder):
        before = spark.read.schema("newest long, batch_id long").parquet(folder).where(F.col("batch_id") < batch_id)
        limit = before.agg(F.max("newest").alias("newest")).first()["newest"]
    at = F.col(ts).cast("timestamp")
    batch.agg(F.max(F.unix_micros(at)).alias("newest"), F.lit(batch_id).cast("long").alias("batch_id")).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(folder)
    if limit is None:
        return batch
    return batch.where(at >= F.timestamp_micros(F.lit(limit)) - F.expr(f"INTERVAL {delay}"))


def daily_stream(stream: DataFrame, store: History, late: str = "recompute", delay: str = "1 day") -> StreamingQuery:
    """Daily rows as readings arrive, from the last write per key.

    ``recompute`` accepts any lateness: touched days are aggregated again from the history.
    ``drop`` ignores readings older than the newest of earlier batches less ``delay``; where none is, both agree.
    """
    if late == "recompute":
        return run(stream, store, upsert_batch, refresh_days)
    if late != "drop":
        raise ValueError(f"late must be 'recompute' or 'drop', not {late!r}")

    def kept(batch: DataFrame, batch_id: int, target: History) -> None:
        timely = on_time(batch, batch_id, target, delay)
        upsert_batch(timely, batch_id, target)
        refresh_days(timely, batch_id, target)

    return run(stream, store, kept)


def status_stream(stream: DataFrame, store: History) -> StreamingQuery:
    """T4: readings, days and live rows in one job."""
    return run(stream, store, upsert_batch, refresh_days, refresh_status)


def score_stream(
    stream: DataFrame, store: History, model: PipelineModel, cols: list[str],
    entries: Callable[[DataFrame, DataFrame], DataFrame], shown: tuple[str, ...] = (),
) -> StreamingQuery:
    """T5: the whole live path per micro-batch."""

    def scored(batch: DataFrame, batch_id: int, target: History) -> None:
        score_batch(batch, batch_id, target, model, cols, entries, shown)

    return run(stream, store, upsert_batch, refresh_days, refresh_status, scored)


COMPACTED = -1  # no stream numbers a batch like this, so later batches never overwrite compacted rows


def compact(spark: SparkSession, store: History, target: History) -> None:
    """Copy the current rows of every table to a fresh history when small files have piled up.

    Stop the stream first and start it on ``target``: its batches count from 0 again and come on top of
    the compacted rows, also those that arrive twice, because readers take the last write per key.
    """
    _write(readings(spark, store), COMPACTED, target.folder("raw"))
    if path_exists(spark, store.folder("daily")):
        _write_sites(days(spark, store), COMPACTED, target, "daily")
    if path_exists(spark, store.folder("live")):
        _write_sites(table(spark, store, "live", ["site_id"]), COMPACTED, target, "live")
    if path_exists(spark, store.folder("archive")):
        _write(table(spark, store, "archive", list(store.keys)), COMPACTED, target.folder("archive"))
