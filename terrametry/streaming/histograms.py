"""Histograms of a running stream: windows close by a watermark, late rows are kept."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.series import seconds, step_before
from ..session import discard, path_exists


def _counted(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy("bucket", *by).agg(F.sum("n").alias("n"))


def histogram_sink(
    closed: str, late: str, progress: str, by: Sequence[str], step: timedelta, lateness: timedelta, ts: str = "ts",
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: rows per time bucket and ``by``, appended once a bucket closes.

    A bucket closes when the newest time seen is ``lateness`` past its end, and is
    then never written again. Rows that come for a closed bucket, and rows without
    time, go whole to ``late``: Spark's own windowed aggregate would drop them. The state
    is one small table for each batch, the counts of open buckets; a batch reads that
    of the batch before and its own rows. Everything is stored by batch, so a replayed
    batch replaces what it wrote. :func:`whole_histogram` adds the three up.
    """
    end = F.col("bucket") + seconds(step.total_seconds())

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, kind = batch.sparkSession, batch.schema[ts].dataType
        marks = []
        if path_exists(spark, f"{progress}/marks"):  # one row for each of the last batches
            marks = spark.read.parquet(f"{progress}/marks").filter(F.col("batch_id") < batch_id).orderBy("batch_id").collect()
        at = lambda t: F.lit(t).cast(kind)
        before = marks[-1] if marks else None
        rows = batch.withColumn("bucket", step_before(F.col(ts), step, kind)).persist()
        newest = rows.agg(F.max(ts)).first()[0]
        newest = max((t for t in (newest, before and before.newest) if t is not None), default=None)
        shut = F.lit(False) if before is None else F.coalesce(
            end <= at(before.newest) - seconds(lateness.total_seconds()), F.lit(False))
        behind = F.col(ts).isNull() | shut
        rows.filter(behind).drop("bucket").write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")
        fresh = rows.filter(~behind).select("bucket", *by, F.lit(1).cast("long").alias("n"))
        if before is not None:
            fresh = fresh.unionByName(spark.read.schema(fresh.schema).parquet(f"{progress}/open/batch_id={before.batch_id}"))
        counts = _counted(fresh, by).persist()
        done = F.lit(False) if newest is None else end <= at(newest) - seconds(lateness.total_seconds())
        counts.filter(done).write.mode("overwrite").parquet(f"{closed}/batch_id={batch_id}")
        counts.filter(~done).write.mode("overwrite").parquet(f"{progress}/open/batch_id={batch_id}")
        if newest is not None:
            spark.range(1).select(at(newest).alias("newest")).write.mode("overwrite").parquet(f"{progress}/marks/batch_id={batch_id}")
        counts.unpersist()
        rows.unpersist()
        for old in marks[:-1]:
            for part in ("open", "marks"):
                discard(spark, f"{progress}/{part}/batch_id={old.batch_id}")

    return write


def whole_histogram(
    spark: SparkSession, closed: str, late: str, progress: str, by: Sequence[str], step: timedelta, schema: T.StructType,
    ts: str = "ts",
) -> DataFrame:
    """Rows per bucket (NULL without time) and ``by`` of all that came: closed and open buckets, and late rows of ``schema``."""
    rows = spark.read.schema(schema).parquet(late)
    missed = rows.select(step_before(F.col(ts), step, schema[ts].dataType).alias("bucket"), *by, F.lit(1).cast("long").alias("n"))
    last = spark.read.parquet(f"{progress}/marks").agg(F.max("batch_id")).first()[0]
    parts = [spark.read.schema(missed.schema).parquet(p).select(*missed.columns) for p in (closed, f"{progress}/open/batch_id={last}")]
    return _counted(missed.unionByName(parts[0]).unionByName(parts[1]), by)
