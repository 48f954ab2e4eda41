"""The stream jobs: records to messages, messages to a keyed document table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import ENERGY_DOCUMENT, ENERGY_FIELDS, ENERGY_MEASURES
from ..sources.streams import MESSAGE_ORDER, observation_pull
from ..streaming.jobs import run_batches
from ..streaming.messages import clean_messages, parse_messages, publish, route, tallies, to_messages
from ..streaming.upsert import upsert_sink

# fixed values: the first poll's reach, that of each later poll, and the time between polls
BOOTSTRAP = timedelta(hours=24)
LOOKBACK = timedelta(minutes=20)
POLL_INTERVAL = timedelta(minutes=15)

ENERGY_TABLE = T.StructType([
    T.StructField("doc_id", T.StringType()),
    *ENERGY_DOCUMENT.fields,
    T.StructField("ingest_time", T.TimestampType()),
    T.StructField("ingest_partition", T.IntegerType()),
    T.StructField("ingest_offset", T.LongType()),
    T.StructField("day", T.DateType()),
])


def publish_records(
    records: DataFrame, location: str, format: str = "json",
    fields: Sequence[str] = ENERGY_FIELDS, measures: Sequence[str] = ENERGY_MEASURES,
    required: str = "consommation", offset: str | None = None, received: Column | None = None,
    **options: str,
) -> Observation:
    """Clean and send records whose required measure is present, each with the
    time of ingestion (``received``, else now).

    Records come as text columns; a field they lack is sent as NULL. Returns
    ``n_received`` and ``n_ignored``, observed on the one pass that sends.
    """
    counts = Observation()
    missing = {name: F.lit(None).cast("string") for name in fields if name not in records.columns}
    seen = records.withColumns(missing).observe(
        counts, F.count(F.lit(1)).alias("n_received"),
        F.count_if(F.col(required).isNull()).alias("n_ignored"),
    )
    kept = clean_messages(seen.filter(F.col(required).isNotNull()), measures, None, received)
    publish(
        to_messages(kept, [*fields, "ingestion_timestamp"], offset=offset), location, format, **options
    )
    return counts


def poll_observations(
    observations: DataFrame, location: str, now: datetime | Column, first: bool = False,
    ts: str = "date_heure", reach: timedelta | None = None, **how,
) -> Observation:
    """One poll of a table of observations: send what came in the last
    :data:`LOOKBACK`, the first time the last :data:`BOOTSTRAP`; ``reach`` sets another span.

    Polls come every ``POLL_INTERVAL``, so they overlap and send some records
    twice; the keyed table keeps one of each.
    """
    at = now if isinstance(now, Column) else F.lit(now)
    window = observation_pull(observations, ts, at, reach or (BOOTSTRAP if first else LOOKBACK))
    shown = window.filter(F.col(ts) <= at).withColumn(ts, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
    return publish_records(shown, location, **how)


def ingest_energy(
    messages: DataFrame, table: str, dead_letters: str, checkpoint: str,
    every: timedelta | None = None,
) -> StreamingQuery:
    """Clean messages, upsert them by document id, keep what cannot be indexed.

    ``messages`` is a stream of :data:`~terrametry.sources.streams.MESSAGE`. The
    last of a key is that sent last; where the source does not tell, that of the
    latest ingestion, then the one of the larger measures. One failing message
    never stops the others. Each batch leaves its tallies of received, indexable,
    ignored and failed messages below ``checkpoint/audit``. Without ``every`` the
    query drains the source and ends.
    """
    parsed = parse_messages(messages).withColumn("day", F.to_date("date_heure"))
    order = [*MESSAGE_ORDER, "ingestion_timestamp", *ENERGY_MEASURES]
    upsert = upsert_sink(table, checkpoint, ENERGY_TABLE, ["doc_id"], order, ["day"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, dead = route(batch)
            upsert(good, batch_id)
            tallies(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                f"{checkpoint}/audit/batch_id={batch_id}"
            )
            dead.select("key", "value", "status").write.mode("overwrite").parquet(
                f"{dead_letters}/batch_id={batch_id}"
            )
        finally:
            batch.unpersist()

    return run_batches(parsed, sink, checkpoint, every)
