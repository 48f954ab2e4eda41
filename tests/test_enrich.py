import random
from datetime import datetime

from pyspark.sql import functions as F

from terrametry.operators.documents import union_documents
from terrametry.operators.enrich import (
    enrich_left, frequent_keys, label_sales, one_row_per_key, quality_totals,
    salted_left, split_on_null, with_creation_rate,
)
from terrametry.operators.profiles import (
    active_profile, breakdown, creations_by_year, employer_profile,
)
from terrametry.operators.warehouse import reused
from terrametry.plans.queries.enrichment import left_enrich_geo

ESTABLISHMENTS = [
    # siret, commune, name, section, state, year, employer
    ("1", "75101", "P", "62", "A", 2019, "O"), ("2", "75101", "P", "62", "A", 2020, "N"),
    ("3", "75101", "P", "41", "F", 2020, "O"), ("4", "75101", "P", None, "A", 2018, "N"),
    (None, "75101", "P", "68", "A", 2025, "O"), ("6", "13001", "M", "35", "A", 2026, "N"),
    ("7", "13001", "M", "47", None, None, "O"),
]


def establishments(spark):
    return spark.createDataFrame(
        ESTABLISHMENTS, "siret string, code_commune string, nom_commune string, "
        "section_naf string, etat string, annee_creation int, est_employeur string")


def test_active_profile(spark, rows):
    assert rows(active_profile(establishments(spark))) == [
        ("13001", 1, 1, 0, 0, 0, 0), ("75101", 3, 2, 1, 0, 2, 0)]


def test_creations(spark, rows):
    assert rows(creations_by_year(establishments(spark))) == [
        ("75101", 2019, 1, 1, 0), ("75101", 2020, 2, 1, 1), ("75101", 2025, 0, 0, 0)]


def test_employer_profile(spark, rows):
    assert rows(employer_profile(establishments(spark)), "code_commune", "nb_tech", "nb_energie",
                "pct_employeurs") == [("13001", 0, 1, 0.0), ("75101", 2, 0, 66.67)]


def test_breakdown(spark):
    got = [tuple(r) for r in breakdown(establishments(spark), "etat").collect()]
    assert got == [("A", 5), (None, 1), ("F", 1)]


def test_left_join_keeps_facts_and_fans_out_on_repeated_keys(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a", "x"), ("a", "w"), ("c", "z")], "k string, name string")
    assert enrich_left(facts, [(dim, ["k"])]).count() == 4
    kept = enrich_left(facts, [(dim, ["k"])], dedupe=True)
    assert kept.count() == 3
    assert kept.filter("k = 'a'").first()["name"] == "w"
    assert one_row_per_key(dim, ["k"]).count() == 2


def test_salted_join_equals_plain_join(spark, rows):
    chance = random.Random(7)
    keys = ["hot"] * 300 + [None] * 200 + [f"k{chance.randrange(50)}" for _ in range(400)]
    facts = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    dim = spark.createDataFrame(
        [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 60, 2)], "k string, d int")
    assert rows(frequent_keys(facts, ["k"], 0.1)) == [("hot",), (None,)]
    salted = salted_left(facts, dim, ["k"], salts=5, share=0.1)
    plain = facts.join(dim, ["k"], "left")
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_creation_rate(spark, rows):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 5), (2, None)],
                               "nb_creations_annee bigint, nb_entreprises_actives bigint")
    assert rows(with_creation_rate(df), "taux_creation_entreprises") == [
        (33.33,), (None,), (None,), (None,)]


def labelled(spark):
    return label_sales(spark.createDataFrame(
        [(1000.0, 10.0, 499.0, "Maison", "75"), (1000.0, 10.0, 500.0, "Maison", "92"),
         (1000.0, 10.0, 30000.0, "Maison", "95"), (0.0, 10.0, 600.0, "Maison", "13"),
         (1000.0, 10.0, 2000.0, None, None), (None, None, None, "Maison", "75")],
        "valeur_fonciere double, surface_bati double, prix_m2 double, type_local string, "
        "code_departement string"))


def test_labels(spark, rows):
    assert rows(labelled(spark), "qualite_donnee", "categorie_prix", "zone_idf") == sorted([
        ("SUSPECTE", "bas", "Paris"), ("OK", "bas", "Petite_couronne"),
        ("OK", "tres_eleve", "Grande_couronne"), ("SUSPECTE", "bas", None),
        ("SUSPECTE", "moyen", None), ("OK", None, "Paris")], key=repr)


def test_totals_add_up(spark):
    with reused(labelled(spark)) as df:
        totals = quality_totals(df).first()
    assert (totals.n_total, totals.n_ok, totals.n_suspect) == (6, 3, 3)
    assert totals.n_ok + totals.n_suspect == totals.n_total


def test_halves_reunite(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, location string")
    some, none = split_on_null(df, "location")
    assert none.columns == ["id"] and (some.count(), none.count()) == (1, 1)
    assert rows(union_documents(some, none)) == rows(df)


def test_sales_are_computed_before_they_fan_out_over_areas(spark, tmp_path):
    tables = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double", [(1, "a", 3, 1.5), (1001, "b", 3, 2.5), (2, "c", 3, 0.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz", [
            (7, 1, "F", "1", datetime(1996, 1, 2)), (8, 2, "O", "2", datetime(1997, 1, 2))]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string", [
            (7, 1, 10.0, 20000.0, 0.1, "A"), (8, 1, 10.0, 30000.0, 0.1, "R")]),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    df = left_enrich_geo(spark, str(tmp_path))
    assert sorted((r.id_disposition, r.prix_m2, r.nom_commune_insee) for r in df.collect()) == [
        ("7-1", 2000.0, "a"), ("7-1", 2000.0, "b"), ("8-1", 3000.0, "c")]
    assert "SortMergeJoin [code_commune" in df._jdf.queryExecution().executedPlan().toString()
