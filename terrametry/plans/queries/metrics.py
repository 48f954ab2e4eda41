"""Time-series queries over event samples."""

from datetime import timedelta

from pyspark.sql import functions as F

from ...functions import matches_label
from ...operators.alerts import Rule, evaluate_rules
from ...operators.series import (
    absent, age_seconds, alert_hold, counter_increase, counter_rate, gauge_series, instant,
    promote_labels, relabel, series_count, vector_and, vector_div, vector_or,
)
from ...session import scratch_path
from ...sources import table_stream
from ...streaming.jobs import run_batches
from ...streaming.watch import rule_sink
from .. import roles
from . import Registry

registry = Registry()
query = registry.add

AS_OF = "2024-01-30 12:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def _increase_sql(series: str, seconds: int, divisor: int, alias: str) -> str:
    return f"""
WITH stepped AS (
  SELECT {series}, ts, value::decimal(18,2) AS value,
         lag(value::decimal(18,2)) OVER (PARTITION BY {series} ORDER BY ts) AS before FROM events),
run AS (
  SELECT {series}, ts, value, sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value
         ELSE value - before END) OVER (PARTITION BY {series} ORDER BY ts ROWS UNBOUNDED PRECEDING) AS total
  FROM stepped)
SELECT {series} AS metric, ts, value::double AS value,
       CASE WHEN count(*) OVER w > 1 THEN (total - min(total) OVER w)::double{f' / {divisor}' if divisor > 1 else ''} END AS {alias}
FROM run WINDOW w AS (PARTITION BY {series} ORDER BY ts RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW)"""


def _counters(spark, sf_dir):
    return roles.samples(spark, sf_dir).select("metric", "ts", "value")


@query(_increase_sql("event_type", 300, 300, "rate"))
def counter_rate_5m(spark, sf_dir):
    rated = counter_rate(_counters(spark, sf_dir), ["metric"], range_s=300)
    return rated.withColumn("value", F.col("value").cast("double"))


@query(_increase_sql("event_type", 3600, 1, "increase"))
def counter_increase_1h(spark, sf_dir):
    grown = counter_increase(_counters(spark, sf_dir), ["metric"], range_s=3600)
    return grown.withColumn("value", F.col("value").cast("double"))


@query(_increase_sql("event_type", 1_209_600, 1, "increase"))
def counter_increase_14d(spark, sf_dir):
    """A window of 56 slices, by the slices' summaries."""
    grown = counter_increase(_counters(spark, sf_dir), ["metric"], range_s=1_209_600)
    return grown.withColumn("value", F.col("value").cast("double"))


@query(f"""
SELECT event_type AS metric, user_id::varchar AS instance, max(ts) AS ts, arg_max(value, ts) AS value
FROM events WHERE ts <= TIMESTAMP '{AS_OF}' AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY
GROUP BY ALL""")
def instant_vector(spark, sf_dir):
    latest = instant(
        roles.samples(spark, sf_dir), ["metric", "instance"], as_of(), lookback=timedelta(days=5)
    )
    return latest.withColumn("value", F.col("value").cast("double"))


@query("""
SELECT event_type AS metric, time_bucket(INTERVAL 1 HOUR, ts) AS step, arg_max(value, ts) AS value
FROM events GROUP BY ALL""", name="gauge_series")
def hourly_gauges(spark, sf_dir):
    gauges = gauge_series(_counters(spark, sf_dir), ["metric"], timedelta(hours=1))
    return gauges.withColumn("value", F.col("value").cast("double"))


@query("""
SELECT event_type AS metric, user_id::varchar AS instance, count(*) AS n FROM events
WHERE regexp_full_match(user_id::varchar, '1.*|.*5') AND event_type <> '' GROUP BY ALL""")
def label_regex(spark, sf_dir):
    chosen = roles.samples(spark, sf_dir).filter(
        matches_label("instance", "1.*|.*5") & (F.col("metric") != "")
    )
    return chosen.groupBy("metric", "instance").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT user_id::varchar AS "Container", max(epoch_us(ts)) // 1000000 * 1000 AS "Started At"
FROM events GROUP BY 1""")
def relabel_table(spark, sf_dir):
    labelled = roles.samples(spark, sf_dir).select(
        F.create_map(F.lit("name"), F.col("instance"), F.lit("job"), F.col("metric")).alias("labels"),
        F.unix_timestamp("ts").alias("value"), "ts",
    )
    started = promote_labels(labelled, ["name", "job"]).groupBy("name").agg(
        F.max(F.col("value") * 1000).alias("Value"), F.first("job").alias("job")
    )
    return relabel(started, {"name": "Container", "Value": "Started At"}, drop=["job"])


@query(f"""
SELECT user_id::varchar AS instance,
       (epoch_us(TIMESTAMP '{AS_OF}') // 1000000 - max(epoch_us(ts)) // 1000000)::bigint AS age_s
FROM events WHERE ts <= TIMESTAMP '{AS_OF}' GROUP BY 1""")
def series_age(spark, sf_dir):
    seen = instant(roles.samples(spark, sf_dir), ["instance"], as_of(), lookback=None)
    return seen.select(
        "instance", age_seconds(F.unix_timestamp(as_of()), F.unix_timestamp("ts")).alias("age_s")
    )


@query(f"""
SELECT count(*) AS n_series FROM (
  SELECT DISTINCT event_type, user_id FROM events
  WHERE ts <= TIMESTAMP '{AS_OF}' AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY)""", name="series_count")
def live_series(spark, sf_dir):
    return series_count(
        roles.samples(spark, sf_dir), ["metric", "instance"], as_of=as_of(),
        lookback=timedelta(days=1),
    )


VECTORS_SQL = """
latest AS (SELECT event_type AS metric, user_id::varchar AS instance, arg_max(value, ts) AS value
           FROM events GROUP BY ALL),
used AS (SELECT instance, value FROM latest WHERE metric = 'view'),
allowed AS (SELECT instance, value FROM latest WHERE metric = 'click' AND value > 5)"""


def _vectors(spark, sf_dir):
    latest = instant(roles.samples(spark, sf_dir), ["metric", "instance"]).select(
        "metric", "instance", F.col("value").cast("double").alias("value")
    )
    used = latest.filter(F.col("metric") == "view").drop("metric")
    allowed = latest.filter((F.col("metric") == "click") & (F.col("value") > 5)).drop("metric")
    return used, allowed


@query(f"""WITH {VECTORS_SQL}
SELECT instance, used.value / allowed.value AS value FROM used JOIN allowed USING (instance)""")
def ratio_match(spark, sf_dir):
    return vector_div(*_vectors(spark, sf_dir), ["instance"])


@query(f"""WITH {VECTORS_SQL}
SELECT instance, value FROM used WHERE instance IN (SELECT instance FROM allowed)""", name="vector_and")
def matched_series(spark, sf_dir):
    return vector_and(*_vectors(spark, sf_dir), ["instance"])


@query(f"""WITH {VECTORS_SQL}
SELECT instance, value FROM used UNION ALL
SELECT instance, value FROM allowed WHERE instance NOT IN (SELECT instance FROM used)""", name="vector_or")
def either_series(spark, sf_dir):
    return vector_or(*_vectors(spark, sf_dir), ["instance"])


@query(f"""
SELECT c_custkey::varchar AS instance FROM customer WHERE c_custkey NOT IN (
  SELECT user_id FROM events WHERE ts <= TIMESTAMP '{AS_OF}' AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 12 HOUR)""")
def absent_series(spark, sf_dir):
    expected = roles.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("instance")
    )
    return absent(
        expected, roles.samples(spark, sf_dir), ["instance"], as_of(), max_age=timedelta(hours=12)
    )


def _hold_sql(source: str, keys: str, on: str, hold: str, stale: int) -> str:
    return f"""
flagged AS (SELECT *, coalesce({on}, false) AS is_on,
   lag(ts) OVER (PARTITION BY {keys} ORDER BY ts) AS pts,
   lag(coalesce({on}, false)) OVER (PARTITION BY {keys} ORDER BY ts) AS pon FROM {source}),
islands AS (SELECT *, sum(CASE WHEN is_on AND pon AND ts - pts <= to_seconds({stale}) THEN 0 ELSE 1 END)
   OVER (PARTITION BY {keys} ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM flagged),
begun AS (SELECT *, CASE WHEN is_on THEN min(ts) OVER (PARTITION BY {keys}, island) END AS active_since FROM islands),
held AS (SELECT *, CASE WHEN NOT is_on THEN 'inactive' WHEN ts - active_since >= to_seconds({hold}) THEN 'firing'
   ELSE 'pending' END AS state FROM begun)"""


@query(f"""WITH {_hold_sql('events', 'event_type', 'value < 15', '3600', 7200)}
SELECT event_type AS metric, ts, value, active_since, state FROM held""", name="alert_hold")
def held_condition(spark, sf_dir):
    held = alert_hold(
        _counters(spark, sf_dir), ["metric"], F.col("value") < 15, 3600, staleness_s=7200
    )
    return held.withColumn("value", F.col("value").cast("double"))


RULES = [
    Rule("HighValue", "gauge", "view", ">", 10, 86_400, "critical", "instance", "1.*"),
    Rule("FewLive", "count", "click", "<", 3, 3600, "warning", member=(">", 10.0)),
    Rule("Busy", "rate", "purchase", ">", 0.001, 600, "warning", range_s=86_400),
    Rule("Restarts", "increase", "error", ">", 20, 60, "warning", range_s=172_800),
    Rule("HighShare", "ratio", "view", ">", 0.9, 86_400, "critical", divisor="click"),
    Rule("Old", "age", "signup", ">", 1_706_000_000, 86_400, "critical", "instance", "1.*"),
    Rule("Gone", "absent", "signup", ">", 200_000, 86_400, "critical", "instance", "2.*"),
]
STALE = 864_000


def _growth_rule_sql(metric: str, seconds: int, divisor: int, threshold: float, rule: str) -> str:
    return f"""
SELECT '{rule}' AS rule, instance, ts, CASE WHEN count(*) OVER w > 1
       THEN (total - min(total) OVER w)::double / {divisor} END AS value FROM (
  SELECT instance, ts, sum(CASE WHEN before IS NULL THEN 0 WHEN v < before THEN v ELSE v - before END)
         OVER (PARTITION BY instance ORDER BY ts ROWS UNBOUNDED PRECEDING) AS total
  FROM (SELECT instance, ts, v, lag(v) OVER (PARTITION BY instance ORDER BY ts) AS before
        FROM history WHERE metric = '{metric}'))
WINDOW w AS (PARTITION BY instance ORDER BY ts RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW)"""


RULE_STATES_SQL = f"""WITH history AS (
  SELECT event_type AS metric, user_id::varchar AS instance, ts, value::decimal(18,2) AS v
  FROM events WHERE ts <= TIMESTAMP '{AS_OF}'),
times AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '{AS_OF}', INTERVAL 6 HOUR)) AS g),
stepped AS (SELECT metric, instance, g AS ts, arg_max(v, history.ts)::double AS v
            FROM times JOIN history ON history.ts <= g AND history.ts > g - INTERVAL 15 HOUR GROUP BY metric, instance, g),
cond AS (
  SELECT 'HighValue' AS rule, 'critical' AS severity, 86400 AS hold, instance, ts, v::double AS value, v > 10 AS hit
  FROM history WHERE metric = 'view' AND regexp_full_match(instance, '1.*')
  UNION ALL
  SELECT 'FewLive', 'warning', 3600, '', ts, count(*) FILTER (v > 10)::double, count(*) FILTER (v > 10) < 3
  FROM stepped WHERE metric = 'click' GROUP BY ts
  UNION ALL
  SELECT rule, 'warning', 600, instance, ts, value, value > 0.001
  FROM ({_growth_rule_sql('purchase', 86400, 86400, 0.001, 'Busy')})
  UNION ALL
  SELECT rule, 'warning', 60, instance, ts, value, value > 20
  FROM ({_growth_rule_sql('error', 172800, 1, 20, 'Restarts')})
  UNION ALL
  SELECT 'HighShare', 'critical', 86400, u.instance, u.ts, u.v / nullif(d.v, 0), d.v > 0 AND u.v / nullif(d.v, 0) > 0.9
  FROM stepped u JOIN stepped d ON u.instance = d.instance AND u.ts = d.ts
  WHERE u.metric = 'view' AND d.metric = 'click'
  UNION ALL
  SELECT 'Old', 'critical', 86400, instance, ts, epoch(ts) - v, epoch(ts) - v > 1706000000
  FROM stepped WHERE metric = 'signup' AND regexp_full_match(instance, '1.*')),
{_hold_sql('cond', 'rule, instance', 'hit', 'hold', STALE)},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rule, instance ORDER BY ts DESC) AS rn FROM held)
           WHERE rn = 1),
silent AS (SELECT instance, max(ts) + to_seconds(200000) AS due FROM history
           WHERE metric = 'signup' AND regexp_full_match(instance, '2.*') GROUP BY instance)
SELECT rule, severity, instance, value,
       CASE WHEN ts >= TIMESTAMP '{AS_OF}' - to_seconds({STALE}) THEN active_since END AS active_since,
       CASE WHEN ts < TIMESTAMP '{AS_OF}' - to_seconds({STALE}) THEN 'inactive' ELSE state END AS state
FROM latest
UNION ALL
SELECT 'Gone', 'critical', instance, NULL, CASE WHEN due < TIMESTAMP '{AS_OF}' THEN due END,
       CASE WHEN due >= TIMESTAMP '{AS_OF}' THEN 'inactive'
            WHEN TIMESTAMP '{AS_OF}' - due >= to_seconds(86400) THEN 'firing' ELSE 'pending' END
FROM silent"""


@query(RULE_STATES_SQL, name="evaluate_rules")
def rule_states(spark, sf_dir):
    return evaluate_rules(
        roles.samples(spark, sf_dir), RULES, as_of(), ["instance"], step=timedelta(hours=6),
        staleness_s=STALE, lookback=timedelta(hours=15),
    )


LATER = "2024-02-02 00:00:00"
COUNTED = [Rule(f"Few_{kind}", "count", kind, "<", 4, 7200, member=(">", 10.0))
           for kind in ("view", "click", "purchase", "signup", "error")]


@query(f"""WITH times AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '{LATER}', INTERVAL 1 HOUR)) AS g),
kinds AS (SELECT event_type, min(ts) AS first_ts FROM events WHERE ts <= TIMESTAMP '{LATER}'
          AND event_type IN ('view', 'click', 'purchase', 'signup', 'error') GROUP BY 1),
seen AS (SELECT event_type, user_id, g, arg_max(value, ts) AS v FROM times JOIN events ON ts <= g AND ts > g - INTERVAL 3 HOUR
         GROUP BY ALL),
counts AS (SELECT k.event_type, t.g AS ts, count(s.v) FILTER (s.v > 10)::double AS n
           FROM kinds k JOIN times t ON t.g >= first_ts LEFT JOIN seen s ON s.event_type = k.event_type AND s.g = t.g GROUP BY 1, 2),
runs AS (SELECT *, max(CASE WHEN n >= 4 THEN ts END) OVER (PARTITION BY event_type) AS healthy FROM counts),
since AS (SELECT event_type, min(CASE WHEN n < 4 AND (healthy IS NULL OR ts > healthy) THEN ts END) AS active_since,
                 arg_max(n, ts) AS value FROM runs GROUP BY 1)
SELECT 'Few_' || event_type AS rule, 'warning' AS severity, '' AS instance, value, active_since,
       CASE WHEN active_since IS NULL THEN 'inactive'
            WHEN TIMESTAMP '{LATER}' - active_since >= INTERVAL 2 HOUR THEN 'firing' ELSE 'pending' END AS state FROM since""")
def vanished_counts(spark, sf_dir):
    """Counts after the last event: series that have all gone count zero, and the hold runs from then."""
    return evaluate_rules(
        roles.samples(spark, sf_dir), COUNTED, F.lit(LATER).cast("timestamp_ntz"), ["instance"], step=timedelta(hours=1),
        lookback=timedelta(hours=3), staleness_s=7200)


@query(RULE_STATES_SQL.replace(f"TIMESTAMP '{AS_OF}'", "(SELECT max(ts) FROM events)"))
def rules_stream(spark, sf_dir):
    """The same rules over the samples as a stream of small batches; the states after the last."""
    files, history, states, progress = (scratch_path(spark, n) for n in ("samples", "history", "states", "rule-progress"))
    samples = roles.samples(spark, sf_dir)
    samples.repartitionByRange(3, "ts").write.parquet(files)
    sink = rule_sink(history, states, RULES, ["instance"], step=timedelta(hours=6), staleness_s=STALE, lookback=timedelta(hours=15))
    run_batches(table_stream(spark, files, samples.schema, files_per_batch=1), sink, progress).awaitTermination()
    kept = spark.read.parquet(states)
    last = kept.agg(F.max("batch_id")).first()[0]
    return kept.filter(F.col("batch_id") == last).drop("batch_id", "as_of")
