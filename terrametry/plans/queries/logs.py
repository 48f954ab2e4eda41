"""Log analytics over events and document lines."""

from datetime import timedelta

from pyspark.sql import functions as F, types as T

from ...operators.logs import (
    cardinality, date_histogram, document_total, drop_blank, last_bucket, recent, reduce_series,
    since, top_term_histogram, top_terms, total_vs_errors,
)
from ...operators.sketches import daily_sketches, distinct_in_ranges, error_bound
from ...schemas import LOG_EVENT, STRING, struct
from ...session import scratch_path, stage
from ...sources import log_json_stream, log_line_stream, read_daily_logs, table_stream
from ...streaming.histograms import histogram_sink, whole_histogram
from ...streaming.jobs import daily_logs, run_batches
from .. import roles
from . import Registry

registry = Registry()
query = registry.add

ERRORS = ("error",)


@query("""
SELECT doc_id, count(*) FILTER (NOT regexp_full_match(line, '\\s*')) AS n_lines
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
GROUP BY doc_id HAVING n_lines > 0""")
def blank_line_filter(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("message")
    )
    return drop_blank(lines).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query("""
WITH counts AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS bucket, count(*) AS n FROM events GROUP BY 1),
spine AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 10 MINUTE)) AS bucket FROM counts)
SELECT bucket, coalesce(n, 0) AS n FROM spine LEFT JOIN counts USING (bucket)""")
def date_histogram_zero_fill(spark, sf_dir):
    return date_histogram(roles.logs(spark, sf_dir), "ts", timedelta(minutes=10))


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, count(*) AS n,
       count(*) FILTER (event_type IN ('error')) AS n_errors
FROM events GROUP BY 1""")
def total_vs_error_histogram(spark, sf_dir):
    return total_vs_errors(
        roles.logs(spark, sf_dir), "ts", timedelta(hours=1), errors=ERRORS, zero_fill=False
    )


@query("""
WITH top AS (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 3),
counts AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS bucket, event_type AS level, count(*) AS n
           FROM events WHERE event_type IN (FROM top) GROUP BY ALL),
spine AS (SELECT level, unnest(generate_series(min(bucket), max(bucket), INTERVAL 30 MINUTE)) AS bucket
          FROM counts GROUP BY level)
SELECT bucket, level, coalesce(n, 0) AS n FROM spine LEFT JOIN counts USING (level, bucket)""")
def level_histogram_topk(spark, sf_dir):
    return top_term_histogram(roles.logs(spark, sf_dir), "ts", timedelta(minutes=30), k=3)


@query("""
WITH top AS (SELECT 'host-' || user_id AS host, count(*) AS n FROM events GROUP BY 1
             ORDER BY n DESC, host LIMIT 10)
SELECT host, n, n * 100 / sum(n) OVER ()::double AS share_pct FROM top""")
def top_terms_share(spark, sf_dir):
    return top_terms(roles.logs(spark, sf_dir), "host")


@query("SELECT count(*) AS n FROM events", name="document_total")
def all_documents(spark, sf_dir):
    return document_total(roles.logs(spark, sf_dir))


@query("SELECT count(DISTINCT user_id) AS n_distinct FROM events")
def distinct_hosts(spark, sf_dir):
    return cardinality(roles.logs(spark, sf_dir), "host", exact=True)


@query("SELECT count(DISTINCT user_id) AS n_exact, true AS within_bound FROM events")
def approx_hosts(spark, sf_dir):
    """A sketch count beside the exact one: within three times its standard error of 5 %."""
    logs = roles.logs(spark, sf_dir)
    about = cardinality(logs, "host").first()["n_distinct"]
    off = F.abs(F.col("n_distinct") - about) / F.col("n_distinct")
    return cardinality(logs, "host", exact=True).select(F.col("n_distinct").alias("n_exact"), (off <= 0.15).alias("within_bound"))


@query("""
SELECT event_id, 'host-' || user_id AS host, event_type AS level FROM events
WHERE event_type IN ('error') ORDER BY ts DESC, event_id DESC LIMIT 500""")
def recent_errors(spark, sf_dir):
    newest = recent(
        roles.logs(spark, sf_dir), "ts", 500, levels=ERRORS, tiebreak=["event_id"]
    )
    return newest.select("event_id", "host", "level")


@query("""
SELECT level, count(*) AS n FROM (
  SELECT event_type AS level FROM events
  WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '2024-01-30 00:00:00')
GROUP BY 1""")
def last_day_levels(spark, sf_dir):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    kept = since(roles.logs(spark, sf_dir), "ts", as_of, timedelta(hours=24))
    return kept.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH counts AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS bucket, count(*) AS n FROM events GROUP BY 1)
SELECT bucket, n, CASE WHEN n < 100 THEN 'green' WHEN n < 1000 THEN 'yellow' ELSE 'red' END AS mark
FROM counts ORDER BY bucket DESC LIMIT 1""")
def last_bucket_rate(spark, sf_dir):
    return last_bucket(roles.logs(spark, sf_dir), "ts")


@query("""
WITH counts AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS bucket, event_type AS level, count(*) AS n
                FROM events GROUP BY ALL)
SELECT level, sum(n)::bigint AS sum, max(n) AS max, sum(n) / count(n)::double AS mean, arg_max(n, bucket) AS last
FROM counts GROUP BY level""")
def histogram_reducers(spark, sf_dir):
    daily = date_histogram(
        roles.logs(spark, sf_dir), "ts", timedelta(days=1), ["level"], zero_fill=False
    )
    return reduce_series(daily, by=["level"])


DAILY = struct(event_type=STRING, day=T.DateType())


def _stored_daily(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "daily"), scratch_path(spark, "daily-progress")
    stream = table_stream(spark, sf_dir, roles.events(spark, sf_dir).schema, "events.parquet")
    daily_logs(stream, out, checkpoint, ts="ts", message="props").awaitTermination()
    return out


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS level, count(*) AS n FROM events
WHERE NOT regexp_full_match(props, '\\s*') GROUP BY ALL""")
def daily_log_partitions(spark, sf_dir):
    """Events streamed into one folder per day."""
    stored = read_daily_logs(spark, _stored_daily(spark, sf_dir), DAILY)
    return stored.groupBy(F.col("day").cast("string").alias("day"), F.col("event_type").alias("level")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
SELECT event_type AS level, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' GROUP BY 1""")
def daily_log_range(spark, sf_dir):
    """Three days of the stored logs; only their folders are read."""
    days = read_daily_logs(
        spark, _stored_daily(spark, sf_dir), DAILY, "2024-01-10", "2024-01-12"
    )
    return days.groupBy(F.col("event_type").alias("level")).agg(F.count(F.lit(1)).alias("n"))


DAYS = (("2024-01-01", "2024-01-31"), ("2024-01-05", "2024-01-05"), ("2024-01-10", "2024-01-20"), ("2024-01-29", "2024-02-10"))
_RANGES = ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in DAYS)


@query(f"""WITH ranges AS (SELECT * FROM (VALUES {_RANGES}) AS r(first, last))
SELECT first::varchar AS first, last::varchar AS last, event_type AS level, count(*) > 0 AS within_bound
FROM ranges JOIN events ON ts::date BETWEEN first AND last GROUP BY ALL""")
def hosts_by_range(spark, sf_dir):
    """Distinct hosts of any range of days from one stored sketch a day, each within its error bound of the exact count."""
    logs = roles.logs(spark, sf_dir)
    sketches = stage(daily_sketches(logs, "ts", "host", ["level"]), "sketches")
    ranges = spark.createDataFrame(DAYS, "first string, last string").select(
        F.col("first").cast("date").alias("first"), F.col("last").cast("date").alias("last"))
    estimates = distinct_in_ranges(sketches, ranges, ["level"])
    days = ranges.withColumn("day", F.explode(F.sequence("first", "last")))
    exact = logs.withColumn("day", F.to_date("ts")).join(F.broadcast(days), "day").groupBy("first", "last", "level").agg(
        F.count_distinct("host").alias("n_exact"))
    off = F.abs(F.col("n_distinct") - F.col("n_exact")) / F.col("n_exact")
    return exact.join(estimates, ["first", "last", "level"], "left").select(
        F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"), "level",
        F.coalesce(off <= error_bound(), F.lit(False)).alias("within_bound"))


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, event_type AS level, count(*) AS n FROM events GROUP BY ALL""")
def histogram_stream(spark, sf_dir):
    """A running histogram whose files come newest first: closed, open and late buckets make the whole."""
    files, closed, late, progress, checkpoint = (
        scratch_path(spark, n) for n in ("log-events", "closed", "late", "histogram", "histogram-progress"))
    logs = roles.logs(spark, sf_dir)
    logs.repartitionByRange(5, F.desc("ts")).write.parquet(files)
    step, by = timedelta(hours=1), ["level"]
    sink = histogram_sink(closed, late, progress, by, step, timedelta(days=10))
    run_batches(table_stream(spark, files, logs.schema, files_per_batch=1), sink, checkpoint).awaitTermination()
    return whole_histogram(spark, closed, late, progress, by, step, logs.schema)


@query("""
SELECT event_type AS level, count(*) AS n, sum(length(event_id || ' ' || event_type || ' ' || props))::bigint AS n_chars
FROM events WHERE event_id % 10 <> 0 GROUP BY 1""")
def log_line_ingest(spark, sf_dir):
    """Log files, blank lines among them, streamed into daily folders."""
    lines, out, checkpoint = (scratch_path(spark, n) for n in ("log-lines", "log-days", "log-progress"))
    event = F.col("event_id")
    roles.events(spark, sf_dir).select(
        F.when(event % 10 != 0, F.concat_ws(" ", event.cast("string"), "event_type", "props"))
        .otherwise(F.when(event % 20 == 0, "   ").otherwise("")).alias("value")).write.text(lines)
    stream = log_line_stream(spark, lines).withColumn("@timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    daily_logs(stream, out, checkpoint).awaitTermination()
    kept = spark.read.parquet(out)
    return kept.groupBy(F.split("message", " ")[1].alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("message")).alias("n_chars"))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS level, count(*) AS n FROM events GROUP BY ALL""")
def log_json_ingest(spark, sf_dir):
    """JSON log events streamed on a schedule until all have come."""
    events, out, checkpoint = (scratch_path(spark, n) for n in ("log-json", "json-days", "json-progress"))
    roles.events(spark, sf_dir).select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("@timestamp"), F.col("event_id").cast("string").alias("message"),
        F.col("event_type").alias("level")).write.json(events)
    stream = log_json_stream(spark, events, LOG_EVENT)
    polled = daily_logs(stream, out, checkpoint, every=timedelta(seconds=1))
    polled.processAllAvailable()
    polled.stop()
    stored = spark.read.parquet(out)
    return stored.groupBy(F.col("day").cast("string").alias("day"), "level").agg(F.count(F.lit(1)).alias("n"))
