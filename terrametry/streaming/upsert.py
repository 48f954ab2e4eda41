"""Keyed upsert into a partitioned Parquet table, last write wins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.latest import latest_per_key
from ..session import discard, leaf_folders, path_exists, replace_folder

BUCKET = "_bucket"


def _partition_tag(partitions: Sequence[str]) -> Column:
    """Partition values as one text, NULLs included."""
    return F.concat_ws("/", *[
        F.coalesce(F.concat(F.lit("="), F.col(p).cast("string")), F.lit("")) for p in partitions
    ])


def merge_latest(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
    partitions: Sequence[str],
) -> DataFrame:
    """Latest row per key over ``batch`` and the partitions it touches.

    The values of the touched partitions come to the driver (never more of them
    than the table has partition folders) and prune the read of ``current``.
    """
    tag = _partition_tag(partitions)
    touched = [row[0] for row in batch.select(tag).distinct().collect()]
    kept = current.filter(tag.isin(touched))
    return latest_per_key(kept.unionByName(batch), keys, order)


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def read_keyed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A keyed table, with or without buckets."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _in_folders(touched: Sequence[Row], partitions: Sequence[str]) -> Column:
    """Rows of the touched folders: comparisons that prune partitions, one for each partition."""
    by_partition: dict[tuple, list[int]] = {}
    for row in touched:
        by_partition.setdefault(tuple(row[:-1]), []).append(row[-1])
    chosen = F.lit(False)
    for values, numbers in by_partition.items():
        here = F.col(BUCKET).isin(numbers)
        for name, value in zip(partitions, values):
            here &= F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
        chosen |= here
    return chosen


def _write_buckets(
    batch: DataFrame, staged: str, path: str, schema: StructType, keys: Sequence[str],
    order: Sequence[str | Column], partitions: Sequence[str], buckets: int,
) -> None:
    """The buckets that ``batch`` touches, merged with it, below ``staged``."""
    spark, folders = batch.sparkSession, [*partitions, BUCKET]
    newest = latest_per_key(with_bucket(batch.select(*schema.names), keys, buckets), keys, order).persist()
    touched = newest.select(*folders).distinct().collect()  # folders of one batch, not rows
    merged = newest
    if path_exists(spark, path):
        # the bucket column last, as partition folders read it
        current = spark.read.schema(StructType([*schema.fields, StructField(BUCKET, IntegerType())])).parquet(path)
        merged = latest_per_key(current.filter(_in_folders(touched, partitions)).unionByName(newest), keys, order)
    merged.hint("rebalance", *folders).write.mode("overwrite").partitionBy(*folders).parquet(staged)
    newest.unpersist()


def upsert_sink(
    path: str, checkpoint: str, schema: StructType, keys: Sequence[str],
    order: Sequence[str | Column], partitions: Sequence[str],
    audit: str | None = None, buckets: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``; exactly one stream may write to ``path``.

    With ``buckets``, each partition is cut into so many folders by the hash of the key
    (column ``_bucket``; :func:`read_keyed` leaves it out). A batch reads the buckets
    that its keys fall into, writes them once below ``checkpoint`` and moves
    each folder into place. A job lost in mid-move replays the moves that are left: a
    folder still staged was not moved, or its target is deleted first. Never change the
    number of buckets of a table.

    The merged partitions are first written below ``checkpoint`` (the folder of
    the same stream, so batch numbers agree), then replace their counterparts
    in ``path``. A replayed batch whose staged copy is complete starts from that
    copy, so that a job lost half way through the replacement loses no rows;
    replaying a finished batch changes nothing. The partition columns must
    follow from the key. ``order`` must rise with arrival.
    """

    staging = f"{checkpoint}/staged"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{staging}/batch={batch_id}"
        if buckets is not None:
            if not path_exists(spark, f"{staged}/_SUCCESS"):
                _write_buckets(batch, staged, path, schema, keys, order, partitions, buckets)
            for folder in leaf_folders(spark, staged):
                replace_folder(spark, f"{staged}/{folder}", f"{path}/{folder}")
        elif not path_exists(spark, f"{staged}/_SUCCESS"):
            newest = latest_per_key(batch.select(*schema.names), keys, order).persist()
            merged = newest
            if path_exists(spark, path):
                current = spark.read.schema(schema).parquet(path)
                merged = merge_latest(current, newest, keys, order, partitions)
            merged.write.mode("overwrite").parquet(staged)
            newest.unpersist()
        if buckets is None:
            (
                spark.read.schema(schema).parquet(staged)
                .hint("rebalance", *partitions)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(*partitions).parquet(path)
            )
        if audit:
            batch.agg(F.count(F.lit(1)).alias("n_received")).withColumn(
                "batch_id", F.lit(batch_id)
            ).write.mode("overwrite").parquet(f"{audit}/batch_id={batch_id}")
        if batch_id > 0:
            discard(spark, f"{staging}/batch={batch_id - 1}")

    return write
