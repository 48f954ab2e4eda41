from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terrametry.operators.reports import (
    anomalies, department_stats, evolution, first_rows, global_summary, group_stats, top_groups,
)

SALES = [
    # department, commune, name, type, year, value, surface, price, flag
    ("75", "75101", "PARIS 01", "Maison", 2020, 1000.0, 10.0, 100.0, "OK"),
    ("75", "75101", "PARIS 01", "Appartement", 2021, 2000.0, 10.0, 200.0, "SUSPECTE"),
    ("75", "75101", "AUTRE", "Maison", 2021, 3000.0, 10.0, 300.0, "OK"),
    ("75", "75102", None, "Maison", 2021, None, 10.0, 500.0, "SUSPECTE"),
    ("13", "13001", "B", "Maison", 2019, 400.0, 10.0, 40.0, "OK"),
    ("13", "13001", "A", "Maison", None, 600.0, 10.0, 60.0, "SUSPECTE"),
]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        SALES, "code_departement string, code_commune string, nom_commune string, "
        "type_local string, annee int, valeur_fonciere double, surface_bati double, "
        "prix_m2 double, qualite_donnee string")


@pytest.mark.parametrize("exact", [False, True])
def test_global_summary(sales, exact):
    assert tuple(global_summary(sales, exact=exact).first()) == (
        6, 3, 2, 2019, 2021, 200.0, 40.0, 500.0, 2)


def test_global_summary_of_nothing(sales):
    row = global_summary(sales.filter("1 = 0")).first()
    assert row.total_transactions == 0 and row.nb_communes == 0 and row.prix_m2_moyen is None


@pytest.mark.parametrize("exact", [False, True])
def test_department_stats(sales, exact):
    assert tuple(department_stats(sales, "75", exact=exact).first()) == ("75", 3, 275.0, 2000.0)
    assert tuple(department_stats(sales, "99", exact=exact).first()) == ("99", 0, 0.0, 0.0)


def test_top_groups(sales):
    got = [tuple(r) for r in top_groups(sales, 3).collect()]
    # a commune without a name shows its code; equal counts: first name in order
    assert got == [("75102", "75102", 500.0), ("PARIS 01", "75101", 200.0), ("A", "13001", 50.0)]
    assert top_groups(sales, 1).count() == 1


def test_top_groups_against_brute_force(spark):
    import random
    chance = random.Random(3)
    data = [(f"{chance.randrange(40):05d}", f"n{chance.randrange(3)}", round(chance.uniform(1, 99), 2))
            for _ in range(2000)]
    prices, names = defaultdict(list), defaultdict(Counter)
    for code, name, price in data:
        prices[code].append(price)
        names[code][name] += 1
    want = sorted(((-sum(map(lambda p: round(p * 100), ps)) / 100 / len(ps), c) for c, ps in prices.items()))[:10]
    df = spark.createDataFrame(data, "code_commune string, nom_commune string, prix_m2 double")
    got = top_groups(df, 10, exact=True).collect()
    assert [r.code for r in got] == [c for _, c in want]
    for row in got:
        best = min(names[row.code].items(), key=lambda item: (-item[1], item[0]))[0]
        assert row.commune == best


def test_anomalies(sales):
    got = anomalies(sales, 2).collect()
    assert len(got) == 2 and got[0].asDict().keys() == {
        "nom_commune", "valeur_fonciere", "surface_bati", "prix_m2", "type_local"}
    assert anomalies(sales).count() == 3


def test_evolution(sales):
    assert [tuple(r) for r in evolution(sales, "75").collect()] == [(2020, 100.0), (2021, 333.33)]
    assert [tuple(r) for r in evolution(sales, "13").collect()] == [(2019, 40.0)]
    assert [tuple(r) for r in evolution(sales, "75", buckets=1).collect()] == [(2020, 100.0)]


def test_group_stats(spark):
    rows = [("north", 10.0, 1), ("south", 4.5, 2), ("north", 20.0, 4), ("west", 7.0, 3), ("south", 5.5, 2)]
    df = spark.createDataFrame(rows, "area string, price double, rooms int")
    got = [tuple(r) for r in group_stats(df, "area", {"avg_price": "price", "avg_rooms": "rooms"}).collect()]
    assert got == [("north", 2, 15.0, 2.5), ("west", 1, 7.0, 3.0), ("south", 2, 5.0, 2.0)]


def test_first_rows(spark):
    df = spark.range(100)
    assert [r.id for r in first_rows(df, [F.desc("id")], 3).collect()] == [99, 98, 97]
