import datetime as dt

from pyspark.sql import functions as F

from terrametry.operators.clean import (
    clean_establishments, clean_geography, clean_transactions, has_length, rename, retention,
    strictly_between,
)
from terrametry.schemas import ESTABLISHMENT_HEADINGS, GEOGRAPHY_HEADINGS, TRANSACTION_HEADINGS


def raw_sale(**over):
    sale = {
        "No disposition": "1", "Nature mutation": "Vente", "Date mutation": "31/12/2020",
        "Valeur fonciere": "250000,50", "Code departement": "75", "Code commune": "101",
        "Commune": "PARIS", "Code postal": "75001", "Type local": "Maison",
        "Surface reelle bati": "100", "Nombre pieces principales": "4", "Surface terrain": "12.5",
        "Unused": "x",
    }
    return {**sale, **over}


def cleaned(spark, sales, **how):
    names = [*TRANSACTION_HEADINGS.values(), "Unused"]
    raw = spark.createDataFrame([tuple(s[n] for n in names) for s in sales],
                                ", ".join(f"`{n}` string" for n in names))
    return clean_transactions(raw, **how)


def test_one_sale(spark):
    row = cleaned(spark, [raw_sale()]).first().asDict()
    assert row == {
        "id_disposition": "1", "nature_mutation": "Vente", "date_mutation": dt.date(2020, 12, 31),
        "annee": 2020, "mois": 12, "valeur_fonciere": 250000.5, "code_departement": "75",
        "code_commune": "75101", "nom_commune": "PARIS", "code_postal": "75001",
        "type_local": "Maison", "surface_bati": 100.0, "nb_pieces": 4, "surface_terrain": 12.5,
        "prix_m2": 2500.01,
    }


def test_rejected_sales(spark):
    bad = [
        {"Type local": "Local industriel"}, {"Type local": None}, {"Nature mutation": "Echange"},
        {"Valeur fonciere": "1000"}, {"Valeur fonciere": "50000000"}, {"Valeur fonciere": "1.000,0"},
        {"Surface reelle bati": "5"}, {"Surface reelle bati": "2000"}, {"Surface reelle bati": ""},
        {"Date mutation": "2020-12-31"}, {"Date mutation": None},
        # price exactly 100 and exactly 50,000
        {"Valeur fonciere": "10000"}, {"Valeur fonciere": "5000000"},
    ]
    assert cleaned(spark, [raw_sale(**b) for b in bad]).count() == 0


def test_kept_sales(spark):
    good = [
        {"Nature mutation": "Vente en l'état futur d'achèvement"}, {"Type local": "Appartement"},
        {"Valeur fonciere": "1000,01", "Surface reelle bati": "9"},
        {"Nombre pieces principales": None, "Surface terrain": "n/a"},
        {"Code departement": None, "Code commune": None},
    ]
    assert cleaned(spark, [raw_sale(**g) for g in good]).count() == len(good)
    # with the corrected code the sale without any code has no area
    assert cleaned(spark, [raw_sale(**g) for g in good], code_mode="fixed").count() == len(good) - 1


def test_geography(spark, rows):
    names = list(GEOGRAPHY_HEADINGS.values())
    raw = spark.createDataFrame(
        [("01001", "A", "01", "46.1", "bad"), ("2A004", "B", "2A", "41.9", "8.7"),
         ("1001", "C", "01", "1", "1"), (None, "D", "01", "1", "1")],
        ", ".join(f"{n} string" for n in names))
    assert rows(clean_geography(raw)) == [
        ("01001", "A", "01", 46.1, None), ("2A004", "B", "2A", 41.9, 8.7)]


def test_establishments(spark):
    names = list(ESTABLISHMENT_HEADINGS.values())
    raw = spark.createDataFrame(
        [("1", "75101", "PARIS", "75001", "62.01Z", "A", "2020-05-01", "11", "true", "O"),
         ("2", "751", "PARIS", "75001", "62.01Z", "A", "2020-05-01", "11", "true", "O"),
         ("3", "75102", "PARIS", "75002", None, "F", "01/05/2020", None, "false", "N")],
        ", ".join(f"{n} string" for n in names))
    got = clean_establishments(raw).select(
        "siret", "section_naf", "date_creation", "annee_creation").orderBy("siret").collect()
    assert [tuple(r) for r in got] == [
        ("1", "62", dt.date(2020, 5, 1), 2020), ("3", None, None, None)]


def test_small_filters(spark, rows):
    df = spark.createDataFrame([(1.0, "abc"), (2.0, "abcde"), (3.0, None)], "v double, s string")
    assert rows(df.filter(strictly_between("v", 1, 3)), "v") == [(2.0,)]
    assert rows(df.filter(has_length("s", 5)), "v") == [(2.0,)]
    assert rename(df, {"v": "w"}, drop=["s"]).columns == ["w"]
    assert retention(df, F.col("v") > 1).first().asDict() == {
        "n_total": 3, "n_kept": 2, "kept_pct": 200 / 3}
    assert retention(df.filter("v > 9"), F.col("v") > 1).first()["kept_pct"] is None
