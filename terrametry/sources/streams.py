"""Streaming scans, and the bounded pull the polling source performs."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

MESSAGE = "key string, value string, ingest_time timestamp, ingest_partition int, ingest_offset bigint"


def message_stream(
    spark: SparkSession, location: str, format: str = "json", batch_limit: int | None = None,
    **options: str,
) -> DataFrame:
    """Keyed messages (:data:`MESSAGE`), all from the start.

    ``kafka`` takes a topic as ``location`` plus connector options and decodes
    the bytes; file formats take a folder. ``batch_limit`` bounds a micro-batch
    (records for a topic, files for a folder).
    """
    if format == "kafka":
        settings = {"subscribe": location, "startingOffsets": "earliest", **options}
        if batch_limit:
            settings["maxOffsetsPerTrigger"] = str(batch_limit)
        raw = spark.readStream.format("kafka").options(**settings).load()
        # offsets count per topic partition, and a key may move when partitions are added:
        # time, partition and offset together order the messages of a key
        return raw.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("ingest_time"),
            F.col("partition").alias("ingest_partition"),
            F.col("offset").alias("ingest_offset"),
        )
    if batch_limit:
        options["maxFilesPerTrigger"] = str(batch_limit)
    return spark.readStream.format(format).schema(MESSAGE).options(**options).load(location)


def table_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


#: Columns that order messages as they were sent; what a source lacks is NULL.
MESSAGE_ORDER = ("ingest_time", "ingest_partition", "ingest_offset")


def log_line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Lines ``(message, path)`` of every file below a folder, from the start."""
    lines = spark.readStream.option("recursiveFileLookup", True).text(folder)
    return lines.select(F.col("value").alias("message"), F.col("_metadata.file_path").alias("path"))


def log_json_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """JSON-lines events below a folder."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).json(folder)


def observation_pull(
    df: DataFrame,
    ts: str,
    as_of: datetime | Column | None = None,
    lookback: timedelta = timedelta(hours=24),
    measure: str | None = None,
    limit: int | None = None,
    tz: str | None = None,
) -> DataFrame:
    """What one poll returns: rows since ``as_of - lookback``, newest first.

    Rows whose ``measure`` is NULL are left out. ``limit`` is optional, since
    without paging it loses the older rows of the window. ``tz`` renders the
    time in a zone; rows are chosen before that, on the stored time.
    """
    now = F.current_timestamp() if as_of is None else as_of
    now = now if isinstance(now, Column) else F.lit(now)
    seconds = int(lookback.total_seconds())
    kept = df.filter(F.col(ts) >= now - F.expr(f"INTERVAL '{seconds}' SECOND"))
    if measure:
        kept = kept.filter(F.col(measure).isNotNull())
    if limit is not None:
        rest = [c for c in df.columns if c != ts]
        kept = kept.orderBy(F.desc(ts), *rest).limit(limit)
    if tz:
        kept = kept.withColumn(ts, F.from_utc_timestamp(ts, tz))
    return kept
