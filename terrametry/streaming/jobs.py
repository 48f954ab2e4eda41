"""Stream jobs: drain what is there, or poll on a schedule."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.logs import drop_blank


def _triggered(writer, every: timedelta | None):
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{int(every.total_seconds())} seconds")


def run_batches(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
    every: timedelta | None = None,
) -> StreamingQuery:
    """Feed micro-batches to ``sink``. Without ``every`` the query stops once
    everything available is processed; the checkpoint tracks progress."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def append_files(
    stream: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = (),
    format: str = "parquet", every: timedelta | None = None,
) -> StreamingQuery:
    """Append-only sink with exactly-once file commits."""
    writer = stream.writeStream.format(format).outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    return _triggered(writer, every).start(path)


def daily_logs(
    stream: DataFrame, path: str, checkpoint: str, ts: str = "@timestamp",
    message: str = "message", every: timedelta | None = None,
) -> StreamingQuery:
    """Log events without blank lines, one folder per day."""
    dated = drop_blank(stream, message).withColumn("day", F.to_date(F.col(f"`{ts}`")))
    return append_files(dated, path, checkpoint, ["day"], every=every)
