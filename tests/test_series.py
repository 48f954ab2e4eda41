import datetime as dt
import random
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from terrametry.operators.latest import latest_per_key
from terrametry.operators.series import (
    absent, age_seconds, alert_hold, alert_state, counter_increase, counter_rate, gauge_series,
    instant, promote_labels, relabel, series_count, vector_and, vector_div, vector_or,
)

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def counters(spark, points, kind="timestamp"):
    return spark.createDataFrame([(s, at(t), float(v)) for s, t, v in points],
                                 f"name string, ts {kind}, value double")


def random_points(seed, n=400, span=20_000):
    chance = random.Random(seed)
    points, seen = [], set()
    for _ in range(n):
        name, t = chance.choice("aaab"), chance.randrange(span)
        if (name, t) not in seen:
            seen.add((name, t))
            points.append((name, t, chance.randrange(100)))
    return points


def brute_increase(points, range_s):
    by_series, out = defaultdict(list), {}
    for name, t, v in points:
        by_series[name].append((t, v))
    for name, samples in by_series.items():
        samples.sort()
        for i, (t, _) in enumerate(samples):
            inside = [v for u, v in samples[: i + 1] if u >= t - range_s]
            grown = sum(b if b < a else b - a for a, b in zip(inside, inside[1:]))
            out[name, at(t)] = float(grown) if len(inside) > 1 else None
    return out


@pytest.mark.parametrize("seed,range_s,slice_s", [(1, 300, None), (2, 900, 900), (3, 60, 7200), (4, 2000, 300), (5, 5000, 60)])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_increase_against_brute_force(spark, seed, range_s, slice_s, kind):
    points = random_points(seed)
    got = counter_increase(counters(spark, points, kind), ["name"], range_s=range_s, slice_s=slice_s)
    assert {(r.name, r.ts): r.increase for r in got.collect()} == brute_increase(points, range_s)


def test_reset_and_rate(spark):
    points = [("a", 0, 10), ("a", 100, 40), ("a", 200, 5), ("a", 300, 15), ("a", 601, 15)]
    got = {r.ts: r.rate for r in counter_rate(counters(spark, points), ["name"]).collect()}
    # 30, then a restart counts 5, then 10; the sample at 0 is on the closed edge
    assert got == {at(0): None, at(100): 0.1, at(200): 35 / 300, at(300): 45 / 300, at(601): None}


def brute_hold(points, limit, hold, stale):
    by_series, out = defaultdict(list), {}
    for name, t, v in points:
        by_series[name].append((t, v))
    for name, samples in by_series.items():
        begun, last = None, None
        for t, v in sorted(samples):
            if v > limit:
                if begun is None or t - last > stale:
                    begun = t
            else:
                begun = None
            last = t
            state = "inactive" if begun is None else "firing" if t - begun >= hold else "pending"
            out[name, at(t)] = (None if begun is None else at(begun), state)
    return out


@pytest.mark.parametrize("seed,slice_s", [(1, 100), (2, 1000), (3, 90_000), (4, 37)])
def test_hold_against_brute_force(spark, seed, slice_s):
    points = random_points(seed)
    held = alert_hold(counters(spark, points), ["name"], F.col("value") > 20, 500, "ts", 200, slice_s)
    want = brute_hold(points, 20, 500, 200)
    assert {(r.name, r.ts): (r.active_since, r.state) for r in held.collect()} == want
    for moment in (5000, 12_345, 30_000):
        state = alert_state(counters(spark, points), ["name"], F.col("value") > 20, 500, at(moment),
                            staleness_s=200, slice_s=slice_s)
        for row in state.collect():
            seen = max(t for n, t, _ in points if n == row.name and t <= moment)
            live = moment - seen <= 200
            assert (row.active_since, row.state) == (
                want[row.name, at(seen)] if live else (None, "inactive"))


def test_hold_boundaries(spark):
    points = [("a", t, 1) for t in (0, 30, 59, 60, 61)] + [("b", 0, 1), ("b", 30, 0), ("b", 70, 1)]
    held = alert_hold(counters(spark, points), ["name"], F.col("value") == 1, 60, staleness_s=60)
    states = {(r.name, r.ts): r.state for r in held.collect()}
    assert [states["a", at(t)] for t in (0, 59, 60, 61)] == ["pending", "pending", "firing", "firing"]
    assert [states["b", at(t)] for t in (0, 30, 70)] == ["pending", "inactive", "pending"]


def test_a_gap_beyond_staleness_starts_again(spark):
    points = [("a", 0, 1), ("a", 100, 1), ("a", 201, 1)]
    held = alert_hold(counters(spark, points), ["name"], F.col("value") == 1, 1, staleness_s=100)
    assert [r.active_since for r in held.orderBy("ts").collect()] == [at(0), at(0), at(201)]


def test_null_condition_is_false(spark):
    df = spark.createDataFrame([("a", at(0), None)], "name string, ts timestamp, value double")
    assert alert_hold(df, ["name"], F.col("value") > 0, 1).first().state == "inactive"


def test_hold_keeps_samples_without_label_or_time(spark, rows):
    points = [(None, "u", at(0), 1.0), (None, "u", at(50), 1.0), (None, "u", at(150), 1.0), (None, "u", at(160), 0.0),
              (None, None, at(60), 1.0), ("a", None, at(0), 1.0), ("a", None, at(90), 1.0), ("a", None, None, 1.0),
              ("a", None, None, 0.0), (None, None, None, 1.0), ("b", "u", None, 1.0)]
    df = spark.createDataFrame(points, "name string, user string, ts timestamp, value double")
    for slice_s in (40, 100, 1000):
        held = alert_hold(df, ["name", "user"], F.col("value") == 1, 90, staleness_s=100, slice_s=slice_s)
        assert held.columns == ["name", "user", "ts", "value", "active_since", "state"]
        assert rows(held) == sorted([
            (None, "u", at(0), 1.0, at(0), "pending"), (None, "u", at(50), 1.0, at(0), "pending"),
            (None, "u", at(150), 1.0, at(0), "firing"), (None, "u", at(160), 0.0, None, "inactive"),
            (None, None, at(60), 1.0, at(60), "pending"), ("a", None, at(0), 1.0, at(0), "pending"),
            ("a", None, at(90), 1.0, at(0), "firing"), ("a", None, None, 1.0, None, "pending"),
            ("a", None, None, 0.0, None, "inactive"), (None, None, None, 1.0, None, "pending"),
            ("b", "u", None, 1.0, None, "pending")], key=repr)


def test_samples_without_time_do_not_part_a_run(spark):
    points = [("a", dt.datetime(1969, 12, 31, 23, 59, 50), 1.0), ("a", dt.datetime(1970, 1, 4), 1.0)]
    points += [("a", None, float(k)) for k in range(1, 60)]
    df = spark.createDataFrame(points, "name string, ts timestamp, value double")
    held = alert_hold(df, ["name"], F.col("value") >= 1, 60, staleness_s=500_000, slice_s=100)
    assert {r.active_since for r in held.filter("ts IS NOT NULL").collect()} == {points[0][1]}
    assert held.count() == len(points)


def test_instant_and_gauges(spark, rows):
    df = counters(spark, [("a", 0, 1), ("a", 200, 2), ("b", 10, 3), ("a", 900, 9)])
    assert rows(instant(df, ["name"], at(250))) == [("a", at(200), 2.0), ("b", at(10), 3.0)]
    assert rows(instant(df, ["name"], at(400)), "name") == [("a",)]
    assert rows(instant(df, ["name"]), "name", "value") == [("a", 9.0), ("b", 3.0)]
    assert series_count(df, ["name"], as_of=at(250)).first().n_series == 2
    assert rows(gauge_series(df, ["name"], timedelta(minutes=5))) == [
        ("a", at(0), 2.0), ("a", at(900), 9.0), ("b", at(0), 3.0)]


def test_vectors(spark, rows):
    left = spark.createDataFrame([("a", 6.0), ("b", 1.0), ("c", 2.0)], "name string, value double")
    right = spark.createDataFrame([("a", 3.0), ("b", 0.0), ("d", 4.0)], "name string, value double")
    assert rows(vector_div(left, right, ["name"])) == [("a", 2.0), ("b", None)]
    assert rows(vector_and(left, right, ["name"])) == [("a", 6.0), ("b", 1.0)]
    assert rows(vector_or(left, right, ["name"])) == [("a", 6.0), ("b", 1.0), ("c", 2.0), ("d", 4.0)]


def test_absent(spark, rows):
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    df = counters(spark, [("a", 0, 1), ("b", 290, 1)])
    assert rows(absent(expected, df, ["name"], at(301))) == [("a",), ("c",)]
    assert rows(absent(expected, df, ["name"])) == [("c",)]


def test_labels_and_ages(spark, rows):
    df = spark.createDataFrame([({"job": "x"}, 5.0)], "labels map<string,string>, value double")
    flat = promote_labels(df, ["job", "name"])
    assert rows(flat, "job", "name") == [("x", "")]
    assert relabel(flat, {"name": "Container"}, drop=["job"]).columns == ["value", "Container"]
    assert flat.select(age_seconds(F.lit(8.0), "value")).first()[0] == 3.0


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"), ("b", 0, "w")],
                               "k string, o int, v string")
    newest = latest_per_key(df, ["k"], ["o"])
    assert rows(newest, "k", "v") == [("a", "y"), ("b", "w")]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
