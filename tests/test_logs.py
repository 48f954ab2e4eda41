import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from terrametry.operators.logs import (
    auto_step, cardinality, date_histogram, document_total, drop_blank, last_bucket, recent,
    reduce_series, since, top_term_histogram, top_terms, total_vs_errors,
)

START = dt.datetime(2024, 1, 1, 10)


def at(minutes, seconds=0):
    return START + timedelta(minutes=minutes, seconds=seconds)


LOGS = [
    (at(0), "ERROR", "h1", "m1"), (at(0, 59), "info", "h1", "m2"), (at(1), "warn", "h2", "m3"),
    (at(4), "info", "h3", "m4"), (at(4, 30), None, "h1", "m5"), (None, "info", "h1", "m6"),
]


@pytest.fixture
def logs(spark):
    return spark.createDataFrame(LOGS, "ts timestamp, level string, host string, message string")


def test_blank_lines(spark, rows):
    df = spark.createDataFrame([("",), ("  \t",), ("x",), (" y ",), (None,)], "message string")
    assert rows(drop_blank(df)) == [(" y ",), ("x",), (None,)]


def test_histogram_counts_empty_buckets(logs):
    got = {r.bucket: r.n for r in date_histogram(logs, "ts", timedelta(minutes=1)).collect()}
    assert got == {at(0): 2, at(1): 1, at(2): 0, at(3): 0, at(4): 2}
    assert date_histogram(logs, "ts", timedelta(minutes=1), zero_fill=False).count() == 3
    assert date_histogram(logs.filter("1 = 0"), "ts", timedelta(minutes=1)).count() == 0


def test_histogram_by_a_field_that_may_be_missing(logs):
    got = date_histogram(logs, "ts", timedelta(minutes=1), ["level"]).collect()
    assert {(r.bucket, r.level): r.n for r in got if r.level in (None, "info")} == {
        (at(0), "info"): 1, (at(1), "info"): 0, (at(2), "info"): 0, (at(3), "info"): 0,
        (at(4), "info"): 1, (at(4), None): 1}


@pytest.mark.parametrize("step", [timedelta(minutes=7), timedelta(hours=5), timedelta(days=2)])
def test_histogram_spine_has_no_gap_over_days(spark, step):
    df = spark.createDataFrame([(START,), (START + timedelta(days=9, hours=3),)], "ts timestamp")
    buckets = sorted(r.bucket for r in date_histogram(df, "ts", step).collect())
    assert all(b - a == step for a, b in zip(buckets, buckets[1:]))
    assert buckets[0] <= START and buckets[-1] + step > START + timedelta(days=9, hours=3)


def test_total_vs_errors(logs):
    got = {r.bucket: (r.n, r.n_errors) for r in total_vs_errors(logs, "ts", timedelta(minutes=1)).collect()}
    assert got[at(0)] == (2, 1) and got[at(1)] == (1, 1) and got[at(2)] == (0, 0)


def test_top_terms_over_time(logs):
    got = top_term_histogram(logs, "ts", timedelta(minutes=1), k=1).collect()
    assert {(r.bucket, r.level, r.n) for r in got} == {
        (at(m), "info", 1 if m in (0, 4) else 0) for m in range(5)}


def test_top_terms(logs):
    got = [tuple(r) for r in top_terms(logs, "host", 2).collect()]
    assert sorted(got) == [("h1", 4, 80.0), ("h2", 1, 20.0)]


def test_totals_and_recent(logs):
    assert document_total(logs).first().n == 6
    assert cardinality(logs, "level", exact=True).first().n_distinct == 3
    assert cardinality(logs, "level").first().n_distinct == 3
    assert [r.message for r in recent(logs, "ts", 2).collect()] == ["m5", "m4"]
    assert [r.message for r in recent(logs, "ts", 9, ["ERROR", "warn"]).collect()] == ["m3", "m1"]
    assert since(logs, "ts", at(4), timedelta(minutes=3)).count() == 2


def test_reducers_and_last_bucket(spark, logs):
    hist = date_histogram(logs, "ts", timedelta(minutes=1))
    row = reduce_series(hist).first()
    assert (row["sum"], row["max"], row["mean"], row["last"]) == (5, 2, 1.0, 2)
    assert tuple(last_bucket(logs, "ts").first()) == (at(4), 2, "green")
    busy = spark.createDataFrame([(START,)] * 100, "ts timestamp")
    assert last_bucket(busy, "ts").first().mark == "yellow"


def test_auto_step(logs):
    assert auto_step(logs, "ts", 60) == timedelta(seconds=5)
    assert auto_step(logs, "ts", 5) == timedelta(minutes=1)
    assert auto_step(logs.filter("1 = 0"), "ts") == timedelta(seconds=1)
    far = logs.select("ts").unionAll(logs.select(F.col("ts") + F.expr("INTERVAL 20 YEAR")))
    step = auto_step(far, "ts", 60)
    assert step.days % 7 == 0 and step * 60 >= timedelta(days=20 * 365)


def test_empty_buckets_are_made_by_many_tasks(logs):
    plan = date_histogram(logs, "ts", timedelta(minutes=1))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_day" in plan
