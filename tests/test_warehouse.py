import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from terrametry.operators.warehouse import (
    create_database, differing_slots, list_partitions, list_tables, partition_inventory, register_table,
    verify_write, write_partitioned,
)
from terrametry.operators.sketches import (
    bitmap_table, daily_sketches, distinct_in_ranges, distinct_of, error_bound, rolled_up, with_codes,
)
from terrametry.plans.territory import TerritoryPaths, build_labelled, build_warehouse
from terrametry.schemas import (
    DOUBLE, ENRICHED, ENRICHED_V2, INT, STRING, SALE_DOCUMENT, TableSpec, struct,
)
from terrametry.session import discard, path_exists, release_scratch, scratch_path, stage
from terrametry.sources import read_documents, read_parquet, read_table

SCHEMA = struct(name=STRING, price=DOUBLE, dep=STRING, year=INT)
ROWS = [("a", 1.0, "01", 2020), ("b", 2.0, "01", 2021), ("c", 3.0, "2A", 2020)]


def test_codes_keep_their_zero(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([r for r in ROWS if r[2] == "01"], SCHEMA)
    assert write_partitioned(df, path, ["dep", "year"]).get["rows"] == 2
    assert rows(read_parquet(spark, path, SCHEMA)) == rows(df)
    assert spark.read.parquet(path).schema["dep"].dataType.simpleString() == "int"


def test_overwrite_whole_or_touched(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame(ROWS, SCHEMA), path, ["dep", "year"])
    new = spark.createDataFrame([("d", 4.0, "01", 2020)], SCHEMA)
    write_partitioned(new, path, ["dep", "year"], only_touched=True)
    assert rows(read_parquet(spark, path, SCHEMA), "name") == [("b",), ("c",), ("d",)]
    write_partitioned(new, path, ["dep", "year"])
    assert rows(read_parquet(spark, path, SCHEMA), "name") == [("d",)]


def test_a_large_partition_is_split_over_tasks(spark, tmp_path):
    """Most rows fall in one partition folder; it still gets several files."""
    path = str(tmp_path / "t")
    df = spark.range(400_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("dep"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_partitioned(df.repartition(8), path, ["dep"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{path}/dep=hot") if f.endswith(".parquet")]
    assert len(files) > 2
    assert read_parquet(spark, path).count() == 400_000


def test_catalog(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame(ROWS, SCHEMA), path, ["dep", "year"])
    create_database(spark, "db1", str(tmp_path / "db"))
    spec = TableSpec("db1", "sales", SCHEMA, ("dep", "year"), path)
    assert register_table(spark, spec).count() == 3
    assert register_table(spark, spec).count() == 3  # dropped and made again
    register_table(spark, spec, replace=False)
    assert rows(list_partitions(spark, "db1.sales")) == [
        ("dep=01/year=2020",), ("dep=01/year=2021",), ("dep=2A/year=2020",)]
    assert rows(list_tables(spark, "db1"), "tableName") == [("sales",)]
    assert read_table(spark, "SELECT count(*) AS n FROM db1.sales WHERE dep = '01'").first().n == 2
    assert read_table(spark, "db1.sales").columns == SCHEMA.names
    plan = read_table(spark, "db1.sales").filter("dep = '01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dep" in plan


def test_checks_after_write(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame(ROWS, SCHEMA), path)
    assert tuple(verify_write(spark, path, 3).first()) == (3, 3, True)
    assert tuple(verify_write(spark, path, 4).first()) == (4, 3, False)
    found = partition_inventory(read_parquet(spark, path), ["dep", "year"], first=2)
    assert [tuple(r) for r in found.collect()] == [("01", 2020), ("01", 2021)]


def test_scratch_is_in_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert "ExistingRDD" not in staged._jdf.queryExecution().toString()
    file = staged.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    assert path_exists(spark, file)
    release_scratch(spark)
    assert not path_exists(spark, file) and not discard(spark, path)


@pytest.fixture
def raw_files(tmp_path):
    sales = tmp_path / "sales"
    sales.mkdir()
    head = ("No disposition|Date mutation|Nature mutation|Valeur fonciere|Code postal|Commune|"
            "Code departement|Code commune|Type local|Surface reelle bati|Nombre pieces principales|"
            "Surface terrain|Extra\n")
    (sales / "2019.txt").write_bytes((head
        + "1|15/03/2019|Vente|200000,00|01000|BOURG|01|053|Maison|100|4|50|x\n"
        + "1|15/03/2019|Vente|900000,00|01000|BOURG|01|053|Local|100|4|50|x\n").encode("iso-8859-1"))
    (sales / "2020.txt").write_bytes((head
        + "1|02/01/2020|Vente en l'état futur d'achèvement|350000,50|75001|PARIS 01|75|101|Appartement|35|2||x\n"
        + "2|02/01/2020|Vente|40000,00|20000|AJACCIO|2A|004|Appartement|100|2||x\n").encode("iso-8859-1"))
    geo = tmp_path / "geo.csv"
    geo.write_text("code_commune_INSEE,nom_commune_postal,code_departement,latitude,longitude,z\n"
                   "01053,BOURG EN BRESSE,01,46.2,5.2,1\n75101,PARIS 01,75,48.86,2.33,1\n"
                   "2A004,AJACCIO,2A,0.0,8.7,1\n", encoding="utf-8")
    firms = tmp_path / "firms.csv"
    heads = ("siret,codeCommuneEtablissement,libelleCommuneEtablissement,codePostalEtablissement,"
             "activitePrincipaleEtablissement,etatAdministratifEtablissement,dateCreationEtablissement,"
             "trancheEffectifsEtablissement,etablissementSiege,caractereEmployeurEtablissement\n")
    firms.write_text(heads
        + '1,75101,"PARIS\nPREMIER",75001,62.01Z,A,2020-02-01,11,true,O\n'
        + '2,75101,"PARIS ""1""",75001,68.20A,A,2018-02-01,11,true,N\n'
        + "3,75101,PARIS,75001,62.02A,F,2020-07-01,11,true,N\n"
        + "4,01053,BOURG,01000,47.11F,A,2019-01-01,,true,N\n", encoding="utf-8")
    return tmp_path


def test_whole_batch_job(spark, raw_files, rows):
    paths = TerritoryPaths(
        str(raw_files / "sales"), str(raw_files / "geo.csv"), str(raw_files / "firms.csv"),
        str(raw_files / "warehouse"), str(raw_files / "documents"), database="job")
    summary = build_warehouse(spark, paths).first()
    assert (summary.total_transactions, summary.nb_departements, summary.annee_debut,
            summary.annee_fin, summary.nb_types_biens) == (3, 3, 2019, 2020, 2)
    table = spark.table("job.enriched_sales")
    assert table.schema.names == ENRICHED.names
    paris = table.filter("code_departement = '75'").first()
    assert (paris.prix_m2, paris.nb_entreprises_actives, paris.diversite_sectorielle,
            paris.nb_creations_annee, paris.nb_creations_tech, paris.taux_creation_entreprises,
            paris.nom_commune_insee, paris.date_mutation) == (
        10000.01, 2, 2, 2, 2, 100.0, "PARIS 01", dt.date(2020, 1, 2))
    corse = table.filter("code_departement = '2A'").first()
    assert corse.nb_entreprises_actives is None and corse.taux_creation_entreprises is None

    documents = read_documents(spark, paths.documents, SALE_DOCUMENT)
    assert rows(documents, "code_commune", "location") == [
        ("01053", (46.2, 5.2)), ("2A004", None), ("75101", (48.86, 2.33))]

    totals = build_labelled(spark, paths.warehouse, str(raw_files / "v2"))
    assert tuple(totals.first()) == (3, 2, 1)
    v2 = read_parquet(spark, str(raw_files / "v2"), ENRICHED_V2)
    assert rows(v2, "code_departement", "qualite_donnee", "categorie_prix", "zone_idf") == [
        ("01", "OK", "moyen", None), ("2A", "SUSPECTE", "bas", None), ("75", "OK", "tres_eleve", "Paris")]


def test_a_fingerprint_sees_values_that_changed_places(spark, tmp_path, rows):
    path, keys = str(tmp_path / "t"), ["dep", "year"]
    df = spark.createDataFrame(ROWS, SCHEMA)
    seen = write_partitioned(df, path, keys, fingerprint=True).get
    audit = lambda: verify_write(spark, path, seen, SCHEMA, keys).first()
    assert tuple(audit()) == (3, 3, True) and differing_slots(spark, path, seen, SCHEMA, keys).count() == 0
    swapped = df.withColumn("price", F.when(F.col("name") == "a", 2.0).when(F.col("name") == "b", 1.0).otherwise(F.col("price")))
    write_partitioned(swapped, path, keys)
    assert tuple(audit()) == (3, 3, False)
    assert ("01", 2020) in rows(differing_slots(spark, path, seen, SCHEMA, keys))
    write_partitioned(df.orderBy(F.desc("name")), path, keys)  # another order is the same table
    assert audit().complete
    empty = str(tmp_path / "e")
    none = write_partitioned(stage(df, "rows").filter("name = 'zz'"), empty, keys, fingerprint=True).get
    assert tuple(verify_write(spark, empty, none, SCHEMA, keys).first()) == (0, 0, True)


def test_bitmaps_roll_up_exactly(spark, rows):
    rng = random.Random(2)
    data = [(f"a{rng.randint(0, 400)}" if rng.random() < 0.95 else None, f"d{i % 3}", i % 4) for i in range(3000)]
    df = spark.createDataFrame(data, "area string, dep string, year int").repartition(5)
    coded = df.join(with_codes(df, "area"), "area")
    fine = stage(bitmap_table(coded, ["dep", "year"]), "bitmaps")
    for by in (["dep", "year"], ["dep"], ["year"], []):
        want = df.groupBy(*by).agg(F.count_distinct("area").alias("n"))
        assert rows(distinct_of(rolled_up(fine, by), by, "n"), *by, "n") == rows(want, *by, "n")


def test_merged_sketches_keep_their_bound(spark):
    df = spark.range(200_000).select((F.col("id") % 60_000).alias("host"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("ts"))
    ranges = spark.createDataFrame([("2024-01-01", "2024-01-09"), ("2024-01-03", "2024-01-04")], "first string, last string").select(
        F.col("first").cast("date").alias("first"), F.col("last").cast("date").alias("last"))
    for r in distinct_in_ranges(daily_sketches(df, "ts", "host"), ranges).collect():
        exact = df.filter(F.col("ts").between(F.lit(r.first), F.lit(r.last))).select("host").distinct().count()
        assert abs(r.n_distinct - exact) <= error_bound() * exact


def test_labels_are_written_where_the_rows_are_read(spark, tmp_path):
    """A second warehouse of the same keys needs no shuffle: rows of one partition stay in as many files."""
    source, target = str(tmp_path / "v1"), str(tmp_path / "v2")
    row = {"code_departement": "75", "annee": 2020, "id_disposition": "1", "prix_m2": 900.0, "valeur_fonciere": 9000.0}
    df = spark.createDataFrame([tuple(row.get(n) for n in ENRICHED.names)], ENRICHED)
    for _ in range(3):
        df.coalesce(1).write.mode("append").partitionBy("code_departement", "annee").parquet(source)
    assert build_labelled(spark, source, target).first()["n_total"] == 3
    assert len(list((tmp_path / "v2").rglob("part-*.parquet"))) == 3
    assert read_parquet(spark, target, ENRICHED_V2).filter("code_departement = '75' AND annee = 2020 AND categorie_prix = 'bas'").count() == 3
