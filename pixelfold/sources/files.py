"""CSV and Parquet sinks and the CSV compiler."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import values as V
from ..operators.series import pivot_metric_aoi, pivot_series
from ..plans.sizing import materialize


def canonical(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """The header's columns in its order; absent ones as NULL."""
    return df.select(
        *[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("double").alias(c) for c in header]
    )


def write_per_key(
    df: DataFrame, key: str, out: str, header: Sequence[str], time: str = "time", prefix: str = "BANDS_", rows_per_file: int = 5_000_000
) -> None:
    """One folder ``<prefix><safe key>`` per key with CSV files sorted by time.

    Rows are ranged by (key, time): a key with many rows is split into
    consecutive time ranges, and each file is sorted. ``rows_per_file`` bounds a file.
    Two keys that would share a folder are an error.
    """
    clash = df.select(key).distinct().groupBy(V.safe_file_key(key).alias("name")).agg(F.count(key).alias("keys"), F.min(key).alias("a"), F.max(key).alias("b"))
    if first := clash.where("keys > 1").first():
        raise ValueError(f"keys {first['a']!r} and {first['b']!r} would share the folder {prefix}{first['name']}")
    shaped = canonical(df.where(F.col(key).isNotNull()), header)
    folder = F.concat(F.lit(prefix), V.safe_file_key(key))
    (
        shaped.withColumn("file", folder)
        .repartitionByRange("file", time)
        .sortWithinPartitions("file", time)
        .write.mode("overwrite")
        .option("header", "true")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("file")
        .csv(out)
    )


def write_by_year(df: DataFrame, out: str, time: str = "time", fmt: str = "parquet") -> None:
    """Files partitioned by the year of ``time``."""
    w = df.withColumn("year", F.year(time)).repartitionByRange("year", time).write.mode("overwrite").partitionBy("year")
    w.option("header", "true").csv(out) if fmt == "csv" else w.parquet(out)


def write_wide(
    df: DataFrame, out: str, metrics: Sequence[str], aois: Sequence[str], time: str = "time"
) -> None:
    """Long (time, aoi, metric, value) as one wide CSV per metric and a combined one.

    ``df`` is read once and written to the shared folder, from which the files are made."""
    df = materialize(df, "wide")
    for m in metrics:
        one = pivot_series(df.where(F.col("metric") == m), time, "aoi", "value", aois)
        one.orderBy(time).write.mode("overwrite").option("header", "true").csv(f"{out}/{V.safe_name(m)}")
    pairs = [(m, a) for m in metrics for a in aois]
    both = pivot_metric_aoi(df, time, pairs)
    both.orderBy(time).write.mode("overwrite").option("header", "true").csv(f"{out}/combined")


def compile_csvs(
    spark: SparkSession, path: str, key: str, schema: str, pattern: str = "*.csv", recursive: bool = False, time: str = "time"
) -> tuple[DataFrame, DataFrame]:
    """All matching CSVs as one frame ordered by (key, time), and a one-row summary.

    Columns are matched by name to the header of each file, whatever their order; a
    file without a column has NULL there. Files that cannot be read, or whose header
    lacks ``key``, give no rows and are counted as ``failed``.
    """
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": str(recursive).lower(), "ignoreCorruptFiles": "true"}
    listed = spark.read.format("binaryFile").options(**options).load(path).select(F.col("path").alias("_f"))
    lines = spark.read.options(**options).text(path).where("_metadata.file_block_start = 0")
    lines = lines.select(F.col("_metadata.file_path").alias("_f"), "value", F.monotonically_increasing_id().alias("_at"))
    names = F.transform(F.split(F.regexp_replace("value", "^\ufeff", ""), ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    headers = lines.groupBy("_f").agg(F.min_by("value", "_at").alias("value")).select("_f", names.alias("_names"))
    headers = headers.where(F.array_contains("_names", key))
    width = headers.agg(F.max(F.size("_names"))).first()[0] or 1
    places = [f"c{i}" for i in range(width)]
    raw = spark.read.schema(", ".join(f"{c} string" for c in places)).option("header", "true").options(**options).csv(path)
    raw = raw.select(F.array(*places).alias("_cells"), F.col("_metadata.file_path").alias("_f")).join(headers, "_f")
    wanted = StructType.fromDDL(schema)
    with_file = raw.select("_f", *(F.get("_cells", F.array_position("_names", c.name).cast("int") - 1).try_cast(c.dataType).alias(c.name) for c in wanted))
    df = with_file.drop("_f")
    failed = listed.join(headers, "_f", "left_anti").agg(F.count("*")).scalar()
    summary = with_file.agg(
        F.count_distinct("_f").alias("files"),
        failed.alias("failed"),
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("unique_keys"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )
    return df.orderBy(key, time), summary


# Columns of a parcel series file.
PARCEL_SERIES_DDL = "date string, feature_index int, band_unnamed double"


def read_parcel_series(spark: SparkSession, path: str) -> DataFrame:
    """Parcel series CSV: ISO-8601 date to timestamp, feature index, value."""
    df = spark.read.schema(PARCEL_SERIES_DDL).option("header", "true").csv(path)
    return df.select(F.to_timestamp("date").alias("time"), "feature_index", F.col("band_unnamed").alias("value"))
