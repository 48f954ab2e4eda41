"""Messages made of events: cleaning, keys, upsert, dedup, dead letters."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F, types as T

from ...functions import document_id, message_key
from ...operators.clean import project
from ...operators.latest import latest_per_key
from ...session import scratch_path
from ...sources import message_stream, observation_pull, table_stream
from ...streaming.jobs import run_batches
from ...streaming.messages import (
    clean_messages, decode, parse_messages, publish, route, tallies, to_messages,
)
from ...streaming.upsert import read_keyed, upsert_sink
from .. import roles
from ..energy import ENERGY_TABLE, POLL_INTERVAL, ingest_energy, poll_observations, publish_records
from . import Registry

registry = Registry()
query = registry.add

FIELDS = ("date_heure", "libelle_region", "consommation", "production", "event_id")
MEASURES = ("consommation", "production")

# how an event turns into a message: region NULL, measure NULL or bad text by its number
MESSAGES_SQL = """
messages AS (
  SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS date_heure,
         CASE WHEN event_id % 17 <> 0 THEN event_type END AS libelle_region,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE value::decimal(18,2)::varchar END AS consommation,
         CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE user_id::varchar END AS production,
         date_trunc('hour', ts) AS hour, ts, event_type, value, user_id
  FROM events
)"""


def raw_messages(spark, sf_dir):
    event = F.col("event_id")
    return project(roles.events(spark, sf_dir), {
        "event_id": "event_id",
        "date_heure": F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss"),
        "libelle_region": F.when(event % 17 != 0, F.col("event_type")),
        "consommation": F.when(event % 13 != 0, F.col("value").cast("decimal(18,2)").cast("string")),
        "production": F.when(event % 7 == 0, "n/a").otherwise(F.col("user_id").cast("string")),
    })


def _encoded(spark, sf_dir):
    return to_messages(raw_messages(spark, sf_dir), FIELDS, offset="event_id")


def _parsed(spark, sf_dir):
    return parse_messages(_encoded(spark, sf_dir), "value", FIELDS, MEASURES)


@query(f"""WITH {MESSAGES_SQL}
SELECT event_id, libelle_region, consommation::double AS consommation,
       CASE WHEN production <> 'n/a' THEN production::double END AS production,
       strftime(hour, '%Y-%m-%d %H:%M:%S') AS date_heure
FROM messages""", name="clean_messages")
def cleaned_messages(spark, sf_dir):
    decoded = decode(_encoded(spark, sf_dir), "value", FIELDS)
    cleaned = clean_messages(decoded, MEASURES)
    return cleaned.select(
        F.col("event_id").try_cast("bigint").alias("event_id"), "libelle_region", *MEASURES,
        F.date_format("date_heure", "yyyy-MM-dd HH:mm:ss").alias("date_heure"),
    )


@query(f"""WITH {MESSAGES_SQL}
SELECT event_id, coalesce(libelle_region, 'None') || '_' || date_heure AS key,
       replace(replace(coalesce(libelle_region, 'None') || '_' || date_heure, ' ', '_'), ':', '-') AS doc_id
FROM messages""")
def message_key_id(spark, sf_dir):
    key = message_key("libelle_region", "date_heure")
    return raw_messages(spark, sf_dir).select(
        "event_id", key.alias("key"), document_id(key).alias("doc_id")
    )


@query("SELECT event_id, (props::json->>'k')::bigint AS k, event_type, user_id FROM events")
def json_roundtrip(spark, sf_dir):
    schema = "event_id bigint, event_type string, user_id bigint, props string"
    text = roles.events(spark, sf_dir).select(
        F.to_json(F.struct("event_id", "event_type", "user_id", "props")).alias("value")
    )
    back = text.select(F.from_json("value", schema).alias("m")).select("m.*")
    return back.select(
        "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        "event_type", "user_id",
    )


@query("""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""", name="latest_per_key")
def latest_event(spark, sf_dir):
    newest = latest_per_key(roles.events(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value")


UPSERT_TABLE = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("libelle_region", T.StringType()),
    T.StructField("consommation", T.DoubleType()), T.StructField("production", T.DoubleType()),
    T.StructField("ingest_offset", T.LongType()), T.StructField("day", T.StringType()),
])


@query(f"""WITH {MESSAGES_SQL}, keyed AS (
  SELECT replace(libelle_region || '_' || date_heure, ':', '-') AS doc_id, libelle_region,
         consommation::double AS consommation,
         CASE WHEN production <> 'n/a' THEN production::double END AS production,
         event_id AS ingest_offset, strftime(hour, '%Y-%m-%d') AS day
  FROM messages WHERE libelle_region IS NOT NULL AND consommation IS NOT NULL)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ingest_offset DESC) AS rn FROM keyed)
WHERE rn = 1""")
def stream_upsert(spark, sf_dir):
    """Messages published to a folder, drained as a stream, upserted by id."""
    topic, table, checkpoint = (
        scratch_path(spark, name) for name in ("topic", "upserts", "upsert-progress")
    )
    publish(_encoded(spark, sf_dir), topic)
    stream = message_stream(spark, topic)
    good, _ = route(parse_messages(stream, "value", FIELDS, MEASURES))
    keyed = good.withColumn("day", F.date_format("date_heure", "yyyy-MM-dd"))
    sink = upsert_sink(table, checkpoint, UPSERT_TABLE, ["doc_id"], ["ingest_offset"], ["day"], buckets=2)
    run_batches(keyed.select(*UPSERT_TABLE.names), sink, checkpoint).awaitTermination()
    return read_keyed(spark, table, UPSERT_TABLE)


FIRST_TABLE = T.StructType([
    T.StructField("event_type", T.StringType()), T.StructField("hour", T.TimestampType()),
    T.StructField("event_id", T.LongType()), T.StructField("month", T.StringType()),
])


@query("""
SELECT event_type, date_trunc('hour', ts) AS hour, min(event_id) AS first_event
FROM events GROUP BY event_type, date_trunc('hour', ts)""")
def stream_dedup(spark, sf_dir):
    """First message per region and hour, whenever and in whatever order they come:
    the key holds the hour, so the keyed table itself is the memory."""
    files, table, checkpoint = (scratch_path(spark, name) for name in ("events", "first", "dedup-progress"))
    hour = F.date_trunc("hour", "ts")
    roles.events(spark, sf_dir).select(
        "event_type", hour.cast("timestamp").alias("hour"), "event_id", F.date_format(hour, "yyyy-MM").alias("month")
    ).repartitionByRange(3, F.desc("hour")).write.parquet(files)
    stream = table_stream(spark, files, FIRST_TABLE, files_per_batch=1)
    sink = upsert_sink(table, checkpoint, FIRST_TABLE, ["event_type", "hour"], [-F.col("event_id")], ["month"], buckets=8)
    run_batches(stream, sink, checkpoint).awaitTermination()
    return read_keyed(spark, table, FIRST_TABLE).select(
        "event_type", F.col("hour").cast("timestamp_ntz").alias("hour"), F.col("event_id").alias("first_event")
    )


@query("""
SELECT event_id, user_id, value, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time
FROM events WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' AND value IS NOT NULL
ORDER BY ts DESC, event_id LIMIT 100""")
def lookback_pull(spark, sf_dir):
    """One poll: the last 48 hours, newest 100, shown in Paris time."""
    pulled = observation_pull(
        roles.events(spark, sf_dir), "ts", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"),
        timedelta(hours=48), "value", 100, "Europe/Paris",
    )
    return pulled.select(
        "event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("local_time")
    )


POLLED = datetime(2024, 1, 20, 12)


@query("""
WITH polls AS (SELECT TIMESTAMP '2024-01-20 12:00:00' AS due, INTERVAL 24 HOUR AS reach
               UNION ALL SELECT TIMESTAMP '2024-01-20 12:15:00', INTERVAL 20 MINUTE
               UNION ALL SELECT TIMESTAMP '2024-01-20 12:30:00', INTERVAL 20 MINUTE),
sent AS (SELECT event_type, date_trunc('minute', ts) AS t, value::decimal(18,2)::double AS v, event_id, due
         FROM events JOIN polls ON date_trunc('minute', ts) >= due - reach AND date_trunc('minute', ts) <= due
         WHERE event_id % 13 <> 0),
kept AS (SELECT *, row_number() OVER (PARTITION BY event_type, t ORDER BY event_id DESC, due DESC) AS rn FROM sent)
SELECT event_type || '_' || strftime(t, '%Y-%m-%dT%H-%M-%S') AS doc_id, v AS consommation, event_id AS ingest_offset,
       strftime(due, '%Y-%m-%d %H:%M:%S') AS ingested,
       (SELECT count(*) FROM sent) AS n_received, (SELECT count(*) FROM sent) AS n_ok
FROM kept WHERE rn = 1""")
def energy_pipeline(spark, sf_dir):
    """Three overlapping polls, each sent and drained in small batches; the table keeps the
    last message of each id and the time it was ingested, the audit counts all."""
    topic, table, dead, checkpoint = (scratch_path(spark, n) for n in ("polls", "energy", "dead", "energy-progress"))
    event = F.col("event_id")
    seen = project(roles.events(spark, sf_dir), {
        "event_id": event, "libelle_region": "event_type", "date_heure": F.date_trunc("minute", "ts"),
        "consommation": F.when(event % 13 != 0, F.col("value").cast("decimal(18,2)").cast("string")),
    })
    for k in range(3):
        at = POLLED + k * POLL_INTERVAL
        poll_observations(seen, topic, F.lit(str(at)).cast("timestamp_ntz"), first=k == 0, offset="event_id",
                          received=F.lit(str(at)).cast("timestamp"))
        stream = message_stream(spark, topic, batch_limit=2)
        ingest_energy(stream, table, dead, checkpoint).awaitTermination()
    audit = spark.read.parquet(f"{checkpoint}/audit").agg(F.sum("n_received").alias("n_received"), F.sum("n_ok").alias("n_ok"))
    counted = audit.first()  # one row
    return spark.read.schema(ENERGY_TABLE).parquet(table).select(
        "doc_id", "consommation", "ingest_offset", F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested"),
        F.lit(counted.n_received).alias("n_received"), F.lit(counted.n_ok).alias("n_ok"))


@query("""
WITH seen AS (SELECT event_type, date_trunc('minute', ts) AS t, value::decimal(18,2)::double AS v, event_id FROM events),
sent AS (SELECT *, row_number() OVER (PARTITION BY event_type, t ORDER BY event_id DESC) AS rn FROM seen WHERE event_id % 13 <> 0)
SELECT event_type || '_' || strftime(t, '%Y-%m-%dT%H-%M-%S') AS doc_id, v AS consommation, event_id AS ingest_offset,
       (SELECT count(*) FROM sent) AS n_received, (SELECT count(*) FROM sent) AS n_ok, 0::bigint AS n_failed,
       (SELECT count(*) FROM seen) AS n_polled, (SELECT count(*) FROM seen WHERE event_id % 13 = 0) AS n_unsent
FROM sent WHERE rn = 1""")
def energy_backfill(spark, sf_dir):
    """A first poll over the whole table, drained in small batches: every row is cleaned, counted and ordered."""
    topic, table, dead, checkpoint = (scratch_path(spark, n) for n in ("backfill", "filled", "unfilled", "backfill-progress"))
    event = F.col("event_id")
    seen = project(roles.events(spark, sf_dir), {
        "event_id": event, "libelle_region": "event_type", "date_heure": F.date_trunc("minute", "ts"),
        "consommation": F.when(event % 13 != 0, F.col("value").cast("decimal(18,2)").cast("string")),
    })
    first, last = seen.agg(F.min("date_heure"), F.max("date_heure")).first()
    polled = poll_observations(
        seen.repartition(6, "event_id"), topic, F.lit(last).cast("timestamp_ntz"), reach=last - first, offset="event_id").get
    ingest_energy(message_stream(spark, topic, batch_limit=2), table, dead, checkpoint).awaitTermination()
    audit = spark.read.parquet(f"{checkpoint}/audit").agg(*[F.sum(n).alias(n) for n in ("n_received", "n_ok", "n_failed")])
    counted = audit.first()  # one row
    return spark.read.schema(ENERGY_TABLE).parquet(table).select(
        "doc_id", "consommation", "ingest_offset", *[F.lit(counted[n]).alias(n) for n in audit.columns],
        F.lit(polled["n_received"]).alias("n_polled"), F.lit(polled["n_ignored"]).alias("n_unsent"))


@query(f"""WITH {MESSAGES_SQL}
SELECT event_id, CASE WHEN consommation IS NULL THEN 'no_measure' ELSE 'no_region' END AS status
FROM messages WHERE consommation IS NULL OR libelle_region IS NULL""")
def dead_letter_split(spark, sf_dir):
    _, dead = route(_parsed(spark, sf_dir))
    return dead.select(F.col("ingest_offset").alias("event_id"), "status")


@query(f"""WITH {MESSAGES_SQL}
SELECT count(*) AS n_received,
       count(*) FILTER (consommation IS NOT NULL AND libelle_region IS NOT NULL) AS n_ok,
       count(*) FILTER (consommation IS NULL) AS n_ignored,
       count(*) FILTER (consommation IS NOT NULL AND libelle_region IS NULL) AS n_failed
FROM messages""")
def ingest_tallies(spark, sf_dir):
    return tallies(_parsed(spark, sf_dir))


@query(f"""WITH {MESSAGES_SQL}
SELECT 'received' AS tally, count(*) AS n FROM messages
UNION ALL SELECT 'ignored', count(*) FILTER (consommation IS NULL) FROM messages
UNION ALL SELECT 'sent', count(*) FILTER (consommation IS NOT NULL) FROM messages""", name="publish_records")
def published(spark, sf_dir):
    """Records sent to a folder, counted in passing; the folder holds the rest."""
    topic = scratch_path(spark, "published")
    counts = publish_records(
        raw_messages(spark, sf_dir), topic, fields=FIELDS, measures=MEASURES, offset="event_id"
    ).get
    sent = spark.read.schema("key string, value string").json(topic)
    return sent.agg(F.array(
        F.struct(F.lit("received").alias("tally"), F.lit(counts["n_received"]).cast("bigint").alias("n")),
        F.struct(F.lit("ignored").alias("tally"), F.lit(counts["n_ignored"]).cast("bigint").alias("n")),
        F.struct(F.lit("sent").alias("tally"), F.count("value").alias("n")),
    ).alias("t")).select(F.inline("t"))
