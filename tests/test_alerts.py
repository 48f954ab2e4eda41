import datetime as dt
import itertools
import random
import shutil
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from terrametry.operators.alerts import Rule, _age, _Setting, evaluate_rules, reference_rules, tag
from terrametry.operators.series import promote_labels
from terrametry.sources import table_stream
from terrametry.streaming.jobs import run_batches
from terrametry.streaming.watch import rule_sink

START = dt.datetime(2024, 1, 1)
EPOCH = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
LABELS = ("job", "instance", "name")


def at(seconds):
    return START + timedelta(seconds=seconds)


def samples(spark, points):
    """points: (metric, {labels}, [(second, value)])"""
    data = [(at(t), metric, labels, float(v)) for metric, labels, series in points for t, v in series]
    df = spark.createDataFrame(
        data, "ts timestamp, metric string, labels map<string,string>, value double")
    return promote_labels(df, LABELS)


def states(df):
    return {(r.rule, r.job or r.instance or r.name): (r.state, r.active_since) for r in df.collect()}


def every(step, end, value, start=0):
    return [(t, value(t) if callable(value) else value) for t in range(start, end + 1, step)]


def test_reference_rules(spark):
    mem, limit = "container_memory_usage_bytes", "container_spec_memory_limit_bytes"
    node, board = {"name": "opensearch"}, {"name": "opensearch-dashboards"}
    df = samples(spark, [
        ("up", {"job": "seaweedfs"}, every(15, 900, lambda t: 0 if t >= 840 else 1)),
        ("up", {"job": "seaweedfs-master"}, every(15, 900, lambda t: 0 if t >= 885 else 1)),
        ("up", {"job": "seaweedfs-filer"}, every(15, 900, 1)),
        ("weed_volume_disk_usage_percent", {"instance": "v1"}, every(15, 900, 85)),
        ("weed_volume_disk_usage_percent", {"instance": "v2"}, every(15, 900, 86)),
        ("weed_filer_request_duration_seconds", {"instance": "f"}, every(15, 900, lambda t: 2 if t >= 700 else 0)),
        ("container_last_seen", node, every(15, 900, lambda t: EPOCH + t)),
        ("container_last_seen", board, every(15, 900, lambda t: EPOCH + min(t, 795))),
        ("container_cpu_usage_seconds_total", node, every(15, 900, lambda t: t * 1.0)),
        ("container_cpu_usage_seconds_total", board, every(15, 900, lambda t: t * 0.5)),
        (mem, node, every(15, 900, 95)), (limit, node, every(15, 900, 100)),
        (mem, board, every(15, 900, 95)), (limit, board, every(15, 900, 0)),
        ("container_start_time_seconds", node, every(15, 900, lambda t: 100 + (3 if t >= 600 else 0))),
    ])
    got = states(evaluate_rules(df, reference_rules(), at(900), LABELS))
    assert got["SeaweedFSNodeDown", "seaweedfs"] == ("firing", at(840))
    assert got["SeaweedFSMasterDown", "seaweedfs-master"] == ("pending", at(885))
    assert got["SeaweedFSFilerDown", "seaweedfs-filer"] == ("inactive", None)
    # no volume job reports at all: counted as zero
    assert got["SeaweedFSVolumeMissing", ""][0] == "firing"
    assert got["SeaweedFSVolumeHighUsage", "v1"][0] == "inactive"
    assert got["SeaweedFSVolumeHighUsage", "v2"] == ("firing", at(0))
    assert got["SeaweedFSHighLatency", "f"] == ("pending", at(705))
    assert got["OpenSearchNodeDown", "opensearch"] == ("inactive", None)
    # last seen at 795, though samples go on: more than a minute ago from 870 on
    assert got["OpenSearchDashboardsDown", "opensearch-dashboards"] == ("pending", at(870))
    assert got["GrafanaDown", "grafana"] == ("firing", None)
    # growth over five minutes first passes 0.9 per second at 270
    assert got["OpenSearchHighCPU", "opensearch"][0] == "firing"
    assert got["OpenSearchDashboardsHighCPU", "opensearch-dashboards"][0] == "inactive"
    assert got["OpenSearchHighMemory", "opensearch"] == ("firing", at(0))
    assert got["OpenSearchDashboardsHighMemory", "opensearch-dashboards"][0] == "inactive"
    assert got["OpenSearchFrequentRestarts", "opensearch"] == ("firing", at(600))
    assert len(reference_rules()) == 18


@pytest.mark.parametrize("up,state", [([1, 1, 1], "inactive"), ([0, 0, 1], "inactive"), ([0, 0, 0], "firing")])
def test_count_rule(spark, up, state):
    df = samples(spark, [
        ("up", {"job": "seaweedfs-volume", "instance": str(i)}, every(15, 120, v)) for i, v in enumerate(up)])
    rule = next(r for r in reference_rules() if r.kind == "count")
    rows = evaluate_rules(df, [rule], at(120), LABELS).collect()
    assert [(r.state, r.severity) for r in rows] == [(state, "warning")]


def test_age_rule_fires_on_a_frozen_value(spark):
    df = samples(spark, [("container_last_seen", {"name": "grafana"}, every(15, 900, lambda t: EPOCH + min(t, 300)))])
    rule = next(r for r in reference_rules() if r.name == "GrafanaDown")
    assert states(evaluate_rules(df, [rule], at(900), LABELS)) == {("GrafanaDown", "grafana"): ("firing", at(375))}
    assert states(evaluate_rules(df, [rule], at(330), LABELS)) == {("GrafanaDown", "grafana"): ("inactive", None)}
    # five minutes after the last sample the series is gone, and its absence is what fires
    late = states(evaluate_rules(df, [rule], at(1300), LABELS, staleness_s=60))
    assert late["GrafanaDown", "grafana"][0] in ("firing", "inactive")
    rows = evaluate_rules(df, [rule], at(1300), LABELS, staleness_s=60).collect()
    assert {(r.state, r.active_since) for r in rows} == {("inactive", None), ("firing", at(1200))}


def test_count_rule_on_unaligned_scrapes(spark):
    """Two series scraped each minute at different seconds are two at every evaluation."""
    df = samples(spark, [("up", {"job": "j", "instance": "a"}, every(60, 900, 1, 7)), ("up", {"job": "j", "instance": "b"}, every(60, 900, 1, 40))])
    rule = Rule("Few", "count", "up", "<", 2, 60)
    assert states(evaluate_rules(df, [rule], at(900), LABELS)) == {("Few", ""): ("inactive", None)}
    for slice_s in (60, 300):
        held = evaluate_rules(df, [Rule("Two", "count", "up", "==", 2, 60)], at(900), LABELS, slice_s=slice_s)
        assert states(held) == {("Two", ""): ("firing", at(45))}


def test_ratio_of_unaligned_scrapes(spark):
    df = samples(spark, [("used", {"name": "a"}, every(30, 600, 95, 3)), ("limit", {"name": "a"}, every(60, 600, 100, 50))])
    rule = Rule("High", "ratio", "used", ">", 0.9, 60, divisor="limit")
    assert states(evaluate_rules(df, [rule], at(600), LABELS)) == {("High", "a"): ("firing", at(60))}


def test_quiet_series_resolves(spark):
    df = samples(spark, [("g", {"name": "a"}, every(15, 300, 9))])
    rule = Rule("High", "gauge", "g", ">", 5, 60)
    assert states(evaluate_rules(df, [rule], at(300), LABELS)) == {("High", "a"): ("firing", at(0))}
    assert states(evaluate_rules(df, [rule], at(601), LABELS)) == {("High", "a"): ("inactive", None)}


def test_expected_series(spark):
    df = samples(spark, [("seen", {"name": "a"}, every(15, 300, 1))])
    rule = Rule("Down", "absent", "seen", ">", 60, 60)
    expected = spark.createDataFrame([("Down", "", "", "a"), ("Down", "", "", "b")],
                                     "rule string, job string, instance string, name string")
    got = states(evaluate_rules(df, [rule], at(300), LABELS, expected=expected))
    assert got == {("Down", "a"): ("inactive", None), ("Down", "b"): ("firing", None)}


def test_a_sample_may_belong_to_several_rules(spark):
    df = samples(spark, [("g", {"name": "a"}, every(15, 60, 9))])
    rules = [Rule("Low", "gauge", "g", ">", 1, 0), Rule("Top", "gauge", "g", ">", 10, 0)]
    assert states(evaluate_rules(df, rules, at(60), LABELS)) == {
        ("Low", "a"): ("firing", at(0)), ("Top", "a"): ("inactive", None)}


def test_rules_over_a_stream(spark, tmp_path, rows):
    """Two batches; the state after the second equals that of all samples."""
    source, history, out = (str(tmp_path / n) for n in ("in", "history", "states"))
    rules = [Rule("High", "gauge", "g", ">", 5, 60), Rule("Fast", "rate", "c", ">", 0.9, 60)]
    sink = rule_sink(history, out, rules, LABELS, timedelta(hours=1))
    def feed(lo, hi):
        df = samples(spark, [("g", {"name": "a"}, every(15, hi, 9, lo)),
                             ("c", {"name": "b"}, every(15, hi, lambda t: t * 2, lo))])
        df.coalesce(1).write.mode("append").parquet(source)
        stream = table_stream(spark, source, df.schema, files_per_batch=1)
        run_batches(stream, sink, str(tmp_path / "c")).awaitTermination()
        return df
    first, second = feed(0, 45), feed(60, 300)
    got = states(spark.read.parquet(f"{out}/batch_id=0"))
    assert got["High", "a"] == ("pending", at(0))
    whole = first.unionByName(second)
    want = states(evaluate_rules(whole, rules, at(300), LABELS))
    assert states(spark.read.parquet(f"{out}/batch_id=1")) == want
    assert want["High", "a"] == ("firing", at(0)) and want["Fast", "b"][0] == "firing"
    sink(second, 1)  # a replay
    assert states(spark.read.parquet(f"{out}/batch_id=1")) == want
    assert spark.read.parquet(history).count() == whole.count()


KINDS = [
    Rule("High", "gauge", "g", ">", 5, 60), Rule("Fast", "rate", "c", ">", 0.9, 60, range_s=120),
    Rule("Grown", "increase", "c", ">", 100, 30, range_s=90), Rule("Share", "ratio", "g", ">", 0.5, 60, divisor="c"),
    Rule("Few", "count", "g", "<", 2, 60, member=(">", 3.0)), Rule("None", "count", "never", "<", 1, 60),
    Rule("Old", "age", "seen", ">", 60, 60), Rule("Gone", "absent", "seen", ">", 90, 30),
]


def random_samples(spark, seed, until):
    rng = random.Random(seed)
    points = []
    for metric in ("g", "c", "seen"):
        for name in "abc":
            series, t, value = [], rng.randint(0, 60), 0
            while t < until:
                if rng.random() < 0.1:
                    t += rng.randint(100, 900)  # gone for a while
                value = rng.randint(0, 9) if metric == "g" else (0 if rng.random() < 0.1 else value + rng.randint(0, 40))
                series.append((t, EPOCH + t - rng.choice([0, 30, 90]) if metric == "seen" else value))
                t += rng.choice([10, 15, 20, 60])
            points.append((metric, {"name": name}, series))
    return samples(spark, points)


def seen(df):
    return sorted((r.rule, r.name, r.state, r.active_since, r.value) for r in df.collect())


@pytest.mark.parametrize("seed,cuts", [(1, (300, 320, 1500)), (2, (900, 1800, 2600)), (3, (70, 3000))])
def test_progress_merges_to_the_states_of_all_samples(spark, tmp_path, seed, cuts):
    """Batch by batch, each without the samples of those before."""
    df = random_samples(spark, seed, 3600)
    history, out = str(tmp_path / "history"), str(tmp_path / "states")
    sink = rule_sink(history, out, KINDS, LABELS, slice_s=600)
    edges = [0, *cuts, 4000]
    for k, (lo, hi) in enumerate(itertools.pairwise(edges)):
        sink(df.filter((F.col("ts") >= at(lo)) & (F.col("ts") < at(hi))), k)
        so_far = df.filter(F.col("ts") < at(hi))
        as_of = so_far.agg(F.max("ts")).first()[0]
        want = seen(evaluate_rules(so_far, KINDS, as_of, LABELS, slice_s=600))
        assert seen(spark.read.parquet(f"{out}/batch_id={k}")) == want
        shutil.rmtree(f"{history}/batch_id={k}")  # later batches must not need it
        carried = spark.read.parquet(f"{out}-progress/carry/batch_id={k}")
        assert carried.filter(F.col("ts") <= F.lit(as_of) - F.expr("INTERVAL 5 MINUTES")).isEmpty()
        assert spark.read.parquet(f"{out}-progress/runs/batch_id={k}").count() <= 3 * len(KINDS)


def test_late_samples_are_evaluated_again(spark, tmp_path):
    df = random_samples(spark, 4, 2400)
    history, out = str(tmp_path / "history"), str(tmp_path / "states")
    sink = rule_sink(history, out, KINDS, LABELS)
    late = (F.hash("ts", "name") % 5 == 0) & (F.col("ts") > at(700))
    for k, (lo, hi) in enumerate([(0, 600), (600, 1500), (1500, 9000)]):
        sink(df.filter((F.col("ts") >= at(lo)) & (F.col("ts") < at(hi)) & ~late), k)
    sink(df.filter(late), 3)
    as_of = df.agg(F.max("ts")).first()[0]
    assert seen(spark.read.parquet(f"{out}/batch_id=3")) == seen(evaluate_rules(df, KINDS, as_of, LABELS))


@pytest.mark.parametrize("seed", [5, 6])
def test_sweeps_equal_a_walk_over_evaluation_times(spark, seed):
    """Count, ratio and age against one look at every multiple of the step."""
    df = random_samples(spark, seed, 1800)
    by_series = {}
    for r in df.collect():
        by_series.setdefault((r.metric, r.name), []).append((int((r.ts - START).total_seconds()), r.value))
    def value(metric, name, t):
        live = [(s, v) for s, v in by_series.get((metric, name), []) if s <= t < s + 300]
        return max(live)[1] if live else None
    rules = [r for r in KINDS if r.kind in ("count", "ratio", "age")]
    got = {(r.rule, r.name): (r.state, r.active_since) for r in evaluate_rules(df, rules, at(1800), LABELS, slice_s=300).collect()}
    def walk(condition, first=0):
        since, last = None, None
        for t in range(first, 1801, 15):
            on = condition(t)
            if on is None:
                continue
            if on and (since is None or t - last > 300):
                since = t
            last, since = t, since if on else None
        live = last is not None and last >= 1500
        return ("inactive", None) if since is None or not live else ("firing" if last - since >= 60 else "pending", at(since))
    start = min(-(-s // 15) * 15 for (m, _), v in by_series.items() if m == "g" for s, _ in v)
    count = lambda t: sum((value("g", n, t) or 0) > 3 for n in "abc")
    assert got["Few", ""] == walk(lambda t: count(t) < 2, start)
    assert got["None", ""] == ("firing", None)
    for n in "abc":
        def share(t, n=n):
            up, low = value("g", n, t), value("c", n, t)
            return None if up is None or low is None else low > 0 and up / low > 0.5
        if ("Share", n) in got:
            assert got["Share", n] == walk(share)
        old = walk(lambda t, n=n: None if value("seen", n, t) is None else EPOCH + t - value("seen", n, t) > 60)
        assert got["Old", n] == old


def test_a_count_whose_series_have_all_gone_is_zero(spark):
    """After a healthy start the outage shows: the hold counts from when the last sample expired."""
    df = samples(spark, [("up", {"job": "j", "instance": "a"}, every(15, 600, 1))])
    rule = Rule("Missing", "count", "up", "<", 1, 60)
    assert states(evaluate_rules(df, [rule], at(600), LABELS)) == {("Missing", ""): ("inactive", None)}
    assert states(evaluate_rules(df, [rule], at(930), LABELS)) == {("Missing", ""): ("pending", at(900))}
    assert states(evaluate_rules(df, [rule], at(4200), LABELS)) == {("Missing", ""): ("firing", at(900))}


def test_null_labels_are_labels(spark):
    df = samples(spark, [("g", {"name": "a"}, every(15, 300, 9)), ("c", {"name": "a"}, every(15, 300, lambda t: t))])
    df = df.withColumn("name", F.lit(None).cast("string"))
    got = evaluate_rules(df, KINDS[:5], at(300), LABELS, slice_s=60).collect()
    assert {(r.rule, r.name, r.state) for r in got if r.rule != "Few"} == {
        ("High", None, "firing"), ("Fast", None, "firing"), ("Grown", None, "inactive"), ("Share", None, "inactive")}


def test_rules_read_samples_once_and_make_no_row_for_each_step(spark):
    df = samples(spark, [("g", {"name": "a"}, [(0, 1)]), ("c", {"name": "a"}, [(0, 1)]), ("seen", {"name": "a"}, [(0, 1)])])
    out = evaluate_rules(df, KINDS, at(300), LABELS, step=timedelta(seconds=1))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and "LocalRelation [ts" not in plan and "LogicalRDD [ts" not in plan


def test_age_pieces_are_not_computed_again_in_a_filter(spark):
    df = samples(spark, [("seen", {"name": "a"}, [(0, EPOCH), (30, EPOCH + 20), (90, EPOCH + 25)])])
    rule = Rule("Old", "age", "seen", ">", 60, 0)
    assert states(evaluate_rules(df, [rule], at(100), LABELS)) == {("Old", "a"): ("firing", at(90))}
    tagged = tag(df, [rule], LABELS)
    how = _Setting([*LABELS], timedelta(seconds=15), timedelta(minutes=5), 21_600, "ts", df.schema["ts"].dataType, F.lit(at(100)), None)
    plan = _age(tagged, [rule], how, None)._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in plan and plan.count("timestamp_micros") < 4
