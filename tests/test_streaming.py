import datetime as dt
import json
import shutil
from datetime import timedelta

import pytest
from pyspark.sql import functions as F, types as T

from terrametry.operators.latest import latest_per_key
from terrametry.plans.energy import ENERGY_TABLE, ingest_energy, publish_records
from terrametry.schemas import ENERGY_FIELDS, LOG_EVENT
from terrametry.sources import log_json_stream, log_line_stream, message_stream
from terrametry.streaming.histograms import histogram_sink, whole_histogram
from terrametry.streaming.jobs import append_files, daily_logs
from terrametry.streaming.messages import (
    drop_repeats, parse_messages, publish, route, tallies, to_messages,
)
from terrametry.session import replace_folder
from terrametry.streaming import upsert
from terrametry.streaming.upsert import merge_latest, read_keyed, upsert_sink

TABLE = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType()),
                      T.StructField("o", T.LongType()), T.StructField("day", T.StringType())])


def message(offset, region="Bretagne", when="2024-01-01T10:00:00+00:00", conso=10, **more):
    return offset, json.dumps({"date_heure": when, "libelle_region": region,
                               "consommation": conso, "unused": 1, **more}, ensure_ascii=False)


def frame(spark, messages):
    return spark.createDataFrame([("k", v, o) for o, v in messages],
                                 "key string, value string, ingest_offset bigint")


MIXED = [message(1), message(2, conso=None), message(3, region=None), (4, "{broken"), (5, None),
         message(6, conso="abc", eolien="12.5", solaire="x", region="Île-de-France"),
         (7, "[1, 2]")]


def test_parse(spark):
    got = {r.ingest_offset: r for r in parse_messages(frame(spark, MIXED)).collect()}
    assert {o: r.status for o, r in got.items()} == {
        1: "ok", 2: "no_measure", 3: "no_region", 4: "broken", 5: "broken", 6: "ok", 7: got[7].status}
    assert got[7].status != "ok"
    assert got[1].consommation == 10.0 and got[1].nucleaire is None
    assert got[1].date_heure == dt.datetime(2024, 1, 1, 10)
    assert got[6].consommation is None and got[6].eolien == 12.5 and got[6].solaire is None
    assert got[6].doc_id == "Île-de-France_2024-01-01T10-00-00+00-00"
    assert got[1].ingestion_timestamp is not None


def test_route_and_tallies(spark):
    parsed = parse_messages(frame(spark, MIXED))
    good, dead = route(parsed)
    assert good.count() + dead.count() == len(MIXED)
    row = tallies(parsed).first()
    assert row.n_received == 7 and row.n_ok == 2
    assert row.n_ok + row.n_ignored + row.n_failed == 7


def test_messages_round_trip(spark):
    df = spark.createDataFrame([("Île", "2024", 1.5, None)],
                               "libelle_region string, date_heure string, consommation double, eolien double")
    sent = to_messages(df, df.columns).first()
    assert sent.key == "Île_2024"
    assert json.loads(sent.value) == {
        "libelle_region": "Île", "date_heure": "2024", "consommation": 1.5, "eolien": None}
    assert "Île" in sent.value


def test_publish_counts_and_cleans(spark, tmp_path, rows):
    records = spark.createDataFrame(
        [("2024-01-01T10:00:00", "Corse", "10", "x"), ("2024-01-01T10:15:00", "Corse", None, "1")],
        "date_heure string, libelle_region string, consommation string, eolien string")
    counts = publish_records(records, str(tmp_path / "topic")).get
    assert counts == {"n_received": 2, "n_ignored": 1}
    sent = spark.read.json(str(tmp_path / "topic")).first()
    value = json.loads(sent.value)
    assert sent.key == "Corse_2024-01-01T10:00:00"
    assert value["consommation"] == 10.0 and value["eolien"] is None and value["taux_co2"] is None
    assert set(value) == {*ENERGY_FIELDS, "ingestion_timestamp"}


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), TABLE)


def test_upsert_last_write_wins_and_replay_changes_nothing(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    sink = upsert_sink(table, str(tmp_path / "c"), TABLE, ["id"], ["o"], ["day"], str(tmp_path / "a"))
    sink(batch(spark, ("a", 1, 1, "d1"), ("a", 2, 2, "d1"), ("b", 3, 3, "d2")), 0)
    second = batch(spark, ("a", 5, 5, "d1"), ("c", 6, 4, "d1"), ("c", 7, 6, "d1"))
    sink(second, 1)
    want = [("a", 5, 5, "d1"), ("b", 3, 3, "d2"), ("c", 7, 6, "d1")]
    read = lambda: rows(spark.read.schema(TABLE).parquet(table))
    assert read() == want
    sink(second, 1)
    assert read() == want
    late = batch(spark, ("a", 0, 0, "d1"))  # an older write does not win
    sink(late, 2)
    assert read() == want
    assert rows(spark.read.parquet(str(tmp_path / "a")), "batch_id", "n_received") == [
        (0, 3), (1, 3), (2, 1)]


def test_upsert_reads_only_touched_partitions(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    first = batch(spark, ("a", 1, 1, "d1"), ("b", 1, 1, "d2"), ("n", 1, 1, None))
    upsert_sink(table, str(tmp_path / "c"), TABLE, ["id"], ["o"], ["day"])(first, 0)
    current = spark.read.schema(TABLE).parquet(table)
    merged = merge_latest(current, batch(spark, ("b", 2, 2, "d2"), ("m", 2, 2, None)), ["id"], ["o"], ["day"])
    scan = next(l for l in merged._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in l)
    assert "PartitionFilters: [concat_ws" in scan
    # the partition without a value is merged like any other
    assert rows(merged) == [("b", 2, 2, "d2"), ("m", 2, 2, None), ("n", 1, 1, None)]


def test_replay_after_a_loss_in_mid_replacement(spark, tmp_path, rows):
    """A partition deleted but not yet replaced comes back from the staged copy."""
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    sink = upsert_sink(table, checkpoint, TABLE, ["id"], ["o"], ["day"])
    sink(batch(spark, ("a", 1, 1, "d1"), ("b", 1, 1, "d1"), ("z", 1, 1, "d2")), 0)
    update = batch(spark, ("a", 2, 2, "d1"))
    sink(update, 1)
    shutil.rmtree(f"{table}/day=d1")
    sink(update, 1)
    assert rows(spark.read.schema(TABLE).parquet(table)) == [
        ("a", 2, 2, "d1"), ("b", 1, 1, "d1"), ("z", 1, 1, "d2")]


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


@pytest.mark.parametrize("partitions", [["day"], ["day", "v"], []])
def test_a_one_row_batch_rewrites_one_bucket(spark, tmp_path, rows, partitions):
    table = str(tmp_path / "t")
    sink = upsert_sink(table, str(tmp_path / "c"), TABLE, ["id"], ["o"], partitions, buckets=4)
    first = [(f"k{i}", i % 3, i, ["d1", "d 2/x", None][i % 3]) for i in range(120)]
    sink(batch(spark, *first), 0)
    before = files_of(tmp_path / "t")
    assert rows(read_keyed(spark, table, TABLE)) == sorted(first, key=repr)
    update = batch(spark, ("k4", 1, 500, "d 2/x"))
    sink(update, 1)
    after = files_of(tmp_path / "t")
    assert len(before) - len(set(before.items()) & set(after.items())) == 1
    assert not files_of(tmp_path / "c")  # no second copy is kept
    want = [r for r in first if r[0] != "k4"] + [("k4", 1, 500, "d 2/x")]
    assert rows(read_keyed(spark, table, TABLE)) == sorted(want, key=repr)
    sink(update, 1)  # a replay
    sink(batch(spark, ("k4", 1, 2, "d 2/x"), ("new", 0, 1, None)), 2)  # an older write does not win
    assert rows(read_keyed(spark, table, TABLE)) == sorted([*want, ("new", 0, 1, None)], key=repr)


def test_buckets_survive_a_loss_in_mid_move(spark, tmp_path, rows, monkeypatch):
    table = str(tmp_path / "t")
    sink = upsert_sink(table, str(tmp_path / "c"), TABLE, ["id"], ["o"], ["day"], buckets=4)
    first = [(f"k{i}", 0, i, "d1") for i in range(40)]
    sink(batch(spark, *first), 0)
    update = batch(spark, *[(f"k{i}", 1, 100, "d1") for i in range(20)])
    moved = []

    def broken(spark, source, target):
        if moved:
            shutil.rmtree(target)  # deleted, not yet replaced
            raise OSError("lost")
        moved.append(target)
        replace_folder(spark, source, target)

    monkeypatch.setattr(upsert, "replace_folder", broken)
    with pytest.raises(OSError):
        sink(update, 1)
    monkeypatch.setattr(upsert, "replace_folder", replace_folder)
    sink(update, 1)
    want = [(f"k{i}", 1, 100, "d1") for i in range(20)] + first[20:]
    assert rows(read_keyed(spark, table, TABLE)) == sorted(want, key=repr)


def test_only_touched_buckets_are_read(spark, tmp_path):
    table = str(tmp_path / "t")
    upsert_sink(table, str(tmp_path / "c"), TABLE, ["id"], ["o"], ["day"], buckets=4)(
        batch(spark, *[(f"k{i}", 0, i, f"d{i % 3}") for i in range(60)]), 0)
    current = spark.read.parquet(table)
    touched = upsert.with_bucket(batch(spark, ("k1", 0, 1, "d1")), ["id"], 4).select("day", upsert.BUCKET).collect()
    chosen = current.filter(upsert._in_folders(touched, ["day"]))
    assert len(chosen.inputFiles()) == 12 and chosen.select(F.input_file_name()).distinct().count() == 1
    scan = next(l for l in chosen._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in l)
    assert "PartitionFilters: [" in scan and "PushedFilters: []" in scan


def test_stream_equals_batch(spark, tmp_path, rows):
    topic, table = str(tmp_path / "topic"), str(tmp_path / "table")
    def drain():
        stream = message_stream(spark, topic, batch_limit=1)
        ingest_energy(stream, table, str(tmp_path / "dead"), str(tmp_path / "c")).awaitTermination()
    first = [message(1, conso=10), message(2, region="Corse"), message(3, conso=None), message(4, conso=11)]
    second = [message(5, conso=12), message(6, when="2024-01-02T00:15:00+00:00"), (7, "oops")]
    publish(frame(spark, first).coalesce(1), topic)
    drain()
    publish(frame(spark, second).coalesce(1), topic)
    drain()
    stored = spark.read.schema(ENERGY_TABLE).parquet(table)
    good, _ = route(parse_messages(frame(spark, first + second)))
    want = latest_per_key(good, ["doc_id"], ["ingest_offset"])
    columns = ["doc_id", "consommation", "ingest_offset"]
    assert rows(stored, *columns) == rows(want, *columns)
    assert stored.count() == 3
    dead = rows(spark.read.parquet(str(tmp_path / "dead")), "value", "status")
    assert ("oops", "broken") in dead and len(dead) == 2
    drain()  # nothing new
    assert stored.count() == 3


def test_repeats_within_the_overlap(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, 10)), ("a", dt.datetime(2024, 1, 1, 10)), ("b", dt.datetime(2024, 1, 1, 11))],
        "id string, ts timestamp")
    df.write.parquet(source)
    df.limit(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    out = str(tmp_path / "out")
    append_files(drop_repeats(stream, ["id"], "ts", timedelta(hours=2)), out,
                 str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.schema(df.schema).parquet(out), "id") == [("a",), ("b",)]


def test_log_lines_and_events(spark, tmp_path, rows):
    nested = tmp_path / "logs" / "a" / "b"
    nested.mkdir(parents=True)
    (nested / "x.log").write_text("one\n\n   \ntwo\n")
    stream = log_line_stream(spark, str(tmp_path / "logs")).withColumn("@timestamp", F.lit(dt.datetime(2024, 1, 1)))
    out = str(tmp_path / "out")
    daily_logs(stream, out, str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.parquet(f"{out}/day=2024-01-01"), "message") == [("one",), ("two",)]

    events = tmp_path / "events"
    events.mkdir()
    (events / "e.json").write_text("\n".join(json.dumps(e) for e in [
        {"@timestamp": "2024-01-01T10:00:00Z", "message": "m", "level": "ERROR", "host": {"name": "h"}},
        {"@timestamp": "2024-01-02T10:00:00Z", "message": " "},
        {"@timestamp": "2024-01-02T11:00:00Z", "level": "info"}]))
    out2 = str(tmp_path / "out2")
    daily_logs(log_json_stream(spark, str(events), LOG_EVENT), out2, str(tmp_path / "c2")).awaitTermination()
    stored = spark.read.parquet(out2)
    assert rows(stored, F.col("day").cast("string"), "level", "host.name") == [
        ("2024-01-01", "ERROR", "h"), ("2024-01-02", "info", None)]


def test_topic_source_options(spark):
    """The connector is not installed here; the request reaches its lookup."""
    with pytest.raises(Exception, match="(?i)kafka"):
        message_stream(spark, "topic", "kafka", 50, **{"kafka.bootstrap.servers": "x:1"})
    assert len(ENERGY_FIELDS) == 14


def test_running_histogram(spark, tmp_path, rows):
    """Buckets close once, late rows go aside, a replay changes nothing."""
    closed, late, progress = (str(tmp_path / n) for n in ("closed", "late", "progress"))
    hour, schema = timedelta(hours=1), "ts timestamp, level string"
    sink = histogram_sink(closed, late, progress, ["level"], hour, timedelta(hours=2))
    def feed(n, *hours):
        df = spark.createDataFrame([(None if h is None else dt.datetime(2024, 1, 1) + timedelta(hours=h), "e") for h in hours], schema)
        sink(df, n)
        return df
    stored = lambda path: rows(spark.read.parquet(path).select("bucket", "n"))
    at = lambda h: dt.datetime(2024, 1, 1, h)
    whole = feed(0, 0.5, 1.5, 1.7)
    assert stored(closed) == []
    whole = whole.union(feed(1, 0.2, 4.1, None))  # 0 to 2 o'clock close
    assert stored(closed) == [(at(0), 2), (at(1), 2)]
    third = feed(2, 1.9, 3.5, 4.2)  # for a closed bucket
    sink(third, 2)
    whole = whole.union(third)
    assert rows(spark.read.parquet(late), "level", "batch_id") == [("e", 1), ("e", 2)]
    feed(3)
    found = whole_histogram(spark, closed, late, progress, ["level"], hour, whole.schema)
    assert rows(found, "bucket", "n") == sorted([(None, 1), (at(0), 2), (at(1), 3), (at(3), 1), (at(4), 2)], key=repr)
