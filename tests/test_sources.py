import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from terrametry.operators.documents import (
    conform, conformance, replace_collection, sale_documents, write_documents,
    write_split_documents,
)
from terrametry.schemas import (
    DOUBLE, ENERGY_DOCUMENT, ENRICHED, INT, LONG, SALE_DOCUMENT, STRING, TableSpec, all_strings,
    document_mapping, struct,
)
from terrametry.sources import (
    local_rows, observation_pull, preview, profile_schema, read_delimited, read_documents,
    read_multiline, stage_delimited,
)


def test_delimited_folder_with_old_encoding(spark, tmp_path, rows):
    for year, city in (("2020", "ÉPINAL"), ("2021", "ORLÉANS")):
        (tmp_path / f"{year}.txt").write_bytes(f"code|ville\n01|{city}\n".encode("iso-8859-1"))
    df = read_delimited(spark, str(tmp_path), sep="|", encoding="latin1")
    assert dict(df.dtypes) == {"code": "string", "ville": "string"}
    assert rows(df) == [("01", "ORLÉANS"), ("01", "ÉPINAL")]
    files = [str(tmp_path / "2020.txt"), str(tmp_path / "2021.txt")]
    assert read_delimited(spark, files, sep="|", encoding="latin1").count() == 2


def test_declared_names_are_checked_against_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(tmp_path), all_strings(["y", "x"])).collect()


def test_multiline_text(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id,t\n1,"two\nlines, ""quoted"""\n2,plain\n')
    df = read_delimited(spark, str(tmp_path / "a.csv"), multiline=True, escape='"')
    want = [("1", 'two\nlines, "quoted"'), ("2", "plain")]
    assert rows(df) == want
    assert rows(stage_delimited(df)) == want
    assert stage_delimited(df, ["id"]).columns == ["id"]


@pytest.fixture
def small_blocks(spark):
    """Files are cut every 300 bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ("300", "0", "1")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


@pytest.mark.parametrize("escape", ['"', "\\"])
def test_one_multiline_file_is_read_by_many_tasks(spark, tmp_path, rows, small_blocks, escape):
    rng = random.Random(9)
    words = ['"', ",", "\n", "\r\n", "a", "é", "text ", "\n\n", '""', " x", "\\N"]
    data = [(str(i), "".join(rng.choices(words, k=rng.choice([0, 1, 5, 30, 300])))) for i in range(150)]
    data[7] = ("7", None)
    quoted = lambda v: "\\N" if v is None else '"' + v.replace("\\", "\\\\" if escape != '"' else "\\").replace('"', escape + '"') + '"'
    for part in range(2):
        lines = ["id,t"] + [f"{i},{quoted(t)}" for i, t in data[part::2]]
        end = "\r\n" if part else "\n"
        (tmp_path / f"{part}.csv").write_bytes((end.join(lines) + end * part).encode())
    found = read_multiline(spark, str(tmp_path), escape=escape, null_value="\\N")
    want = [(i, None if t == "\\N" else t) for i, t in data]
    assert rows(found) == sorted(want, key=repr)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert rows(read_multiline(spark, str(tmp_path), struct(t=STRING, id=INT), escape=escape, null_value="\\N")) == sorted(
        ((t, int(i)) for i, t in want), key=repr)


def test_multiline_reader_on_plain_and_empty_text(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id,t\n1,"two\nlines, ""quoted"""\n\n2,plain\n')
    assert rows(read_multiline(spark, str(tmp_path / "a.csv"))) == [("1", 'two\nlines, "quoted"'), ("2", "plain")]
    (tmp_path / "b.csv").write_text("id,t\n")
    assert rows(read_multiline(spark, str(tmp_path / "b.csv"))) == []


def test_profile(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "s string, n int")
    assert rows(profile_schema(df, exact=True)) == [("n", "int", 3, 1, 2), ("s", "string", 3, 2 - 1, 1)]
    assert rows(profile_schema(df)) == rows(profile_schema(df, exact=True))
    assert preview(df, 2).count() == 2
    assert local_rows(spark, [("x", 1)], struct(a=STRING, b=INT)).first() == ("x", 1)


def test_observation_pull(spark):
    now = dt.datetime(2024, 7, 1, 12)
    data = [(now - dt.timedelta(minutes=m), None if m == 10 else float(m)) for m in range(0, 60, 5)]
    df = spark.createDataFrame(data, "ts timestamp, consommation double")
    pulled = observation_pull(df, "ts", now, dt.timedelta(minutes=20), "consommation", 3)
    assert [r.consommation for r in pulled.collect()] == [0.0, 5.0, 15.0]
    assert observation_pull(df, "ts", now, dt.timedelta(minutes=20)).count() == 5
    local = observation_pull(df, "ts", now, dt.timedelta(0), tz="Europe/Paris").first()
    assert local.ts == dt.datetime(2024, 7, 1, 14)


def test_conform(spark, rows):
    df = spark.createDataFrame([("1", "x", "2.5", 9)], "id string, n string, v string, extra int")
    mapping = struct(id=LONG, n=INT, v=DOUBLE, absent=STRING)
    assert conform(df, mapping).dtypes == [
        ("id", "bigint"), ("n", "int"), ("v", "double"), ("absent", "string")]
    assert conform(df, mapping).first() == (1, None, 2.5, None)
    assert rows(conformance(df, mapping)) == [
        ("absent", "missing", 0), ("extra", "unmapped", 0), ("id", "mapped", 0),
        ("n", "mapped", 1), ("v", "mapped", 0)]


def test_replace_collection(spark, tmp_path, rows):
    path, mapping = str(tmp_path / "docs"), struct(id=LONG, n=INT)
    df = spark.createDataFrame([("1", "x"), ("2", "7")], "id string, n string")
    for _ in range(2):  # a second run replaces the first
        report = replace_collection(df, path, mapping)
    assert rows(report) == [("id", "mapped", 0), ("n", "mapped", 1)]
    assert rows(read_documents(spark, path, mapping)) == [(1, None), (2, 7)]
    assert json.loads(spark.read.text(f"{path}/_mapping").first().value) == document_mapping(mapping)


def test_replacing_a_collection_computes_its_input_once(spark, tmp_path):
    mapping, seen = struct(id=LONG, n=INT), spark.sparkContext.accumulator(0)
    def watched(i):
        seen.add(1)
        return str(i)
    df = spark.range(20).select(F.udf(watched)("id").alias("id"), F.lit("x").alias("n"))
    report = replace_collection(df, str(tmp_path / "docs"), mapping)
    assert {r.field: r.n_lost for r in report.collect()} == {"id": 0, "n": 20} and seen.value == 20


def test_document_modes(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    schema = struct(id=INT, location=STRING)
    df = spark.createDataFrame([(1, "here"), (2, None)], schema)
    write_split_documents(df, path)
    assert rows(read_documents(spark, path, schema)) == rows(df)
    text = "".join(r.value for r in spark.read.text(path).collect())
    assert "null" not in text and text.count("location") == 1
    write_documents(df.filter("id = 1"), path, mode="ignore")
    assert read_documents(spark, path, schema).count() == 2
    write_documents(df, path)  # a rerun replaces
    assert read_documents(spark, path, schema).count() == 2


def test_split_write_through_another_format(spark, tmp_path):
    """A connector gets both halves appended; a file format stands in for it."""
    path = str(tmp_path / "docs")
    df = spark.createDataFrame([(1, "here"), (2, None)], "id int, location string")
    write_split_documents(df, path, format="parquet")
    assert spark.read.option("mergeSchema", True).parquet(path).count() == 2


def test_derived_contracts():
    mapping = document_mapping(SALE_DOCUMENT, full_text=("nom_commune",))["mappings"]["properties"]
    assert mapping["location"] == {"type": "geo_point"}
    assert mapping["nom_commune"] == {"type": "text"}
    assert mapping["diversite_sectorielle"] == {"type": "long"}
    assert len(mapping) == 18 and len(document_mapping(ENERGY_DOCUMENT)["mappings"]["properties"]) == 15
    assert len(ENRICHED) == 29
    ddl = TableSpec("d", "t", ENRICHED, ("code_departement", "annee"), "/x").ddl()
    assert "`nb_entreprises_actives` bigint" in ddl and "PARTITIONED BY (`code_departement`, `annee`)" in ddl


def test_sale_documents(spark):
    row = {f.name: None for f in ENRICHED.fields} | {"latitude": 1.0, "longitude": 0.0}
    df = spark.createDataFrame([tuple(row[n] for n in ENRICHED.names)], ENRICHED)
    assert sale_documents(df).schema.names == SALE_DOCUMENT.names
    assert sale_documents(df).first().location is None
