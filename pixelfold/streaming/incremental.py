"""Incremental versions of zonal statistics and first-valid pixels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.grid import Grid, crop_to_extent, zone_cells, zone_extent, zones_on_grid
from ..plans.sizing import BROADCAST_CELLS, sized_cells, small_side


BATCH = "_batch"
LATE_COLUMNS = f"rows long, late long, newest timestamp, {BATCH} long"


def read_pixel_stream(
    spark: SparkSession, path: str, schema, pattern: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream; a ``time`` column becomes a TIMESTAMP."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(path)
    return df.withColumn("time", F.col("time").cast("timestamp")) if "time" in df.columns else df


def zonal_mean_stream(
    pixels: DataFrame,
    zones: DataFrame,
    grid: Grid,
    key: str,
    bands: Sequence[str],
    window: str = "1 day",
    delay: str = "30 days",
) -> DataFrame:
    """key, window_start, <band>_mean per tumbling window of arriving pixels.

    Stream-static equi-join with the zone cells, then a windowed aggregate: state
    holds one buffer per zone and open window. In append mode (``run_available``) a window
    comes out once, when the watermark passes it; in update mode (``run_available_updates``)
    it comes out with every change, so the newest windows are there as well. Rows behind
    the watermark are dropped; ``count_late_rows`` counts them.
    """
    zones = zones_on_grid(zones.where(F.col(key).isNotNull()), grid)
    ext = zone_extent(zones, grid)
    cells = sized_cells(zone_cells(zones, grid, [key], spread=True), ext.max_cells)
    return _window_means(crop_to_extent(pixels, ext), cells, key, bands, window, delay)


def zonal_mean_stream_of_labels(
    pixels: DataFrame, labels: DataFrame, key: str, bands: Sequence[str], window: str = "1 day", delay: str = "30 days"
) -> DataFrame:
    """``zonal_mean_stream`` against a stored label table (row, col, key), so that no batch fills polygons anew."""
    cells = small_side(labels.where(F.col(key).isNotNull()).select("row", "col", key), BROADCAST_CELLS)
    return _window_means(pixels, cells, key, bands, window, delay)


def _window_means(pixels: DataFrame, cells: DataFrame, key: str, bands: Sequence[str], window: str, delay: str) -> DataFrame:
    joined = pixels.withWatermark("time", delay).join(cells, ["row", "col"])
    return (
        joined.groupBy(F.window("time", window), key)
        .agg(*[F.avg(b).alias(f"{b}_mean") for b in bands])
        .select(key, F.col("window.start").alias("window_start"), *[f"{b}_mean" for b in bands])
    )


def first_valid_stream(pixels: DataFrame, band: str, mask=None) -> DataFrame:
    """row, col, value, since: earliest unmasked value per cell, for update mode.
    The state is one value per cell of the area of interest."""
    ok = F.col(band).isNotNull() if mask is None else F.col(band).isNotNull() & ~mask
    return pixels.where(ok).groupBy("row", "col").agg(
        F.min_by(band, F.struct("time", band)).alias("value"), F.min("time").alias("since")
    )


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append", sink: str = "parquet"):
    """Process everything that is there and stop; a later run continues from the checkpoint."""
    return (
        df.writeStream.format(sink)
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_available_updates(df: DataFrame, path: str, checkpoint: str):
    """Process what is there in update mode: each batch writes only its changed rows.

    A batch has a folder of its own, which a repeated batch overwrites, so a restart neither
    loses nor doubles rows. ``latest_updates`` reads the newest row of each key.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return (
        df.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key among all batches; combined map-side."""
    stored = spark.read.parquet(path)
    rest = [c for c in stored.columns if c not in (*keys, BATCH)]
    newest = stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def count_late_rows(pixels: DataFrame, path: str, checkpoint: str, window: str = "1 day", delay: str = "30 days"):
    """Counts, batch by batch, the arriving rows and those that came too late.

    A row is late when its window had ended at the batch's watermark: the newest time of all
    earlier batches less ``delay``. One row per batch (rows, late, newest) is stored under its number, so a
    repeated batch counts again from the same watermark, and no count depends on kept progress.
    """

    def store(batch: DataFrame, number: int) -> None:
        ends = F.window("time", window)["end"]
        late = F.lit(False)
        if number:
            earlier = batch.sparkSession.read.schema(LATE_COLUMNS).parquet(path).where(F.col(BATCH) < number)
            newest = earlier.agg(F.max(F.unix_micros("newest")).alias("n")).first()["n"]
            watermark = F.timestamp_micros(F.lit(newest).cast("long")) - F.expr(f"INTERVAL {delay}")
            late = F.coalesce(ends <= watermark, F.lit(False))
        counted = batch.where(F.col("time").isNotNull()).select("time", late.alias("_late")).agg(
            F.count("*").alias("rows"), F.count(F.when(F.col("_late"), 1)).alias("late"), F.max("time").alias("newest")
        )
        counted.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return (
        pixels.select("time")
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class LateRows(StreamingQueryListener):
    """Rows that each query dropped behind its watermark, over all its batches.

    Register it with ``spark.streams.addListener`` before the query starts; progress
    events arrive shortly after their batch.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_late_rows(query) -> int:
    """Rows dropped behind the watermark in the batches that the query still remembers
    (``spark.sql.streaming.numRecentProgressUpdates``); ``LateRows`` counts all."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
