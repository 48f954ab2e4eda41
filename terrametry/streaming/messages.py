"""Message cleaning, keys and dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import document_id, message_key, number_from_text
from ..schemas import ENERGY_FIELDS, ENERGY_MEASURES

BROKEN = "_corrupt_record"


def decode(
    df: DataFrame, value: str = "value", fields: Sequence[str] = ENERGY_FIELDS
) -> DataFrame:
    """The wanted fields of a JSON text as strings; other fields are left out
    and missing ones are NULL. Text that is no JSON object sets ``broken``."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*fields, BROKEN)])
    parsed = df.withColumn("_json", F.from_json(
        value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    ))
    return parsed.select(
        "*", *[F.col("_json")[name].alias(name) for name in fields],
        (F.col("_json").isNull() | F.col("_json")[BROKEN].isNotNull()).alias("broken"),
    ).drop("_json")


def clean_messages(
    df: DataFrame, measures: Sequence[str] = ENERGY_MEASURES, ts: str | None = "date_heure",
    received: Column | None = None,
) -> DataFrame:
    """Measures as numbers (bad text gives NULL), the time as a timestamp, and
    the time of ingestion: ``received``, else as sent, else now."""
    cleaned = df.withColumns({name: number_from_text(name) for name in measures})
    if ts:
        cleaned = cleaned.withColumn(ts, F.try_to_timestamp(ts))
    if received is None:
        received = F.current_timestamp()
        if "ingestion_timestamp" in df.columns:
            received = F.coalesce(F.try_to_timestamp("ingestion_timestamp"), received)
    return cleaned.withColumn("ingestion_timestamp", received)


def parse_messages(
    df: DataFrame, value: str = "value", fields: Sequence[str] = ENERGY_FIELDS,
    measures: Sequence[str] = ENERGY_MEASURES, required: str = "consommation",
    region: str = "libelle_region", ts: str = "date_heure", received: Column | None = None,
) -> DataFrame:
    """Messages cleaned and routed, still in one stream.

    ``status`` is ``ok``, or why the message is not indexed: ``broken`` JSON,
    ``no_measure`` (the required measure is NULL) or ``no_region``. ``doc_id``
    is built from the texts as sent, and the ingestion time sent is kept.
    """
    decoded = decode(df, value, [*fields, "ingestion_timestamp"])
    status = (
        F.when(F.col("broken"), "broken")
        .when(F.col(required).isNull(), "no_measure")
        .when(F.col(region).isNull(), "no_region")
        .otherwise("ok")
    )
    keyed = decoded.withColumns({
        "status": status, "doc_id": document_id(message_key(region, ts)),
    })
    return clean_messages(keyed, measures, ts, received).drop("broken")


def route(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages to index, and dead letters."""
    ok = F.col("status") == "ok"
    return parsed.filter(ok).drop("status"), parsed.filter(~ok)


def tallies(parsed: DataFrame) -> DataFrame:
    """Received, indexable, ignored and failed messages."""
    status = F.col("status")
    return parsed.agg(
        F.count(F.lit(1)).alias("n_received"),
        F.count_if(status == "ok").alias("n_ok"),
        F.count_if(status == "no_measure").alias("n_ignored"),
        F.count_if(status.isin("broken", "no_region")).alias("n_failed"),
    )


def to_messages(
    df: DataFrame, fields: Sequence[str], key: Sequence[str] = ("libelle_region", "date_heure"),
    offset: str | None = None,
) -> DataFrame:
    """Rows as ``(key, value)`` messages; NULL fields are kept in the JSON."""
    columns = [
        message_key(*key).alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    ]
    if offset:
        columns.append(F.col(offset).cast("bigint").alias("ingest_offset"))
    return df.select(*columns)


def publish(df: DataFrame, location: str, format: str = "json", **options: str) -> None:
    """Send ``(key, value)`` rows to a topic, or to a folder a stream reads."""
    if format == "kafka":
        df.write.format("kafka").options(topic=location, **options).save()
    else:
        df.write.format(format).mode("append").options(**options).save(location)


def drop_repeats(
    df: DataFrame, keys: Sequence[str], ts: str, within: timedelta
) -> DataFrame:
    """First message of each key; state is kept for ``within`` of event time.

    The overlap of two polls repeats messages: ``within`` must exceed it.
    """
    bounded = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(
        ts, f"{int(within.total_seconds())} seconds"
    )
    return bounded.dropDuplicatesWithinWatermark(list(keys))
