import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrametry.functions import (
    band, compose_code, date_from_text, document_id, geo_struct, guarded_rate, half_up,
    matches_label, message_key, number_from_text, or_zero, prefix, quality_flag, unit_price,
    whole_from_text, zone,
)


def evaluate(spark, schema, values, expression):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_number_from_text(spark):
    texts = ["12,5", "1.234,5", "", None, "abc", "250000", "1,5e3"]
    got = evaluate(spark, "t string", [(t,) for t in texts], number_from_text("t", ","))
    assert got == [12.5, None, None, None, None, 250000.0, 1500.0]


def test_whole_from_text(spark):
    texts = ["3", "3.7", "-2", " 4 ", "", "1e3", "99999999999", None, "x", "5."]
    got = evaluate(spark, "t string", [(t,) for t in texts], whole_from_text("t"))
    assert got == [3, 3, -2, 4, None, None, None, None, None, 5]


def test_date_from_text(spark):
    texts = ["31/12/2020", "1/2/2020", "31/02/2020", "2020-01-01", "", None]
    got = evaluate(spark, "t string", [(t,) for t in texts], date_from_text("t", "dd/MM/yyyy"))
    assert got == [dt.date(2020, 12, 31), None, None, None, None, None]


@pytest.mark.parametrize("mode,want", [
    ("reference", ["75101", "00153", "97110", "00000", "2A004", "00075"]),
    ("fixed", ["75101", "01053", "97101", None, "2A004", None]),
])
def test_compose_code(spark, mode, want):
    parts = [("75", "101"), ("01", "53"), ("971", "101"), (None, None), ("2A", "004"), ("75", None)]
    assert evaluate(spark, "a string, b string", parts, compose_code("a", "b", mode)) == want


def test_compose_code_rejects_unknown_mode():
    with pytest.raises(ValueError):
        compose_code(F.lit("1"), F.lit("2"), "other")


def test_keys(spark):
    parts = [("Île de France", "2024-01-01T10:00:00"), (None, "x:y z")]
    key = message_key("a", "b")
    assert evaluate(spark, "a string, b string", parts, key) == [
        "Île de France_2024-01-01T10:00:00", "None_x:y z"]
    assert evaluate(spark, "a string, b string", parts, document_id(key)) == [
        "Île_de_France_2024-01-01T10-00-00", "None_x-y_z"]
    assert evaluate(spark, "a string, b string", parts, prefix("b", 4)) == ["2024", "x:y "]


def test_prices_and_rates(spark):
    got = evaluate(spark, "v double, s double", [(100.0, 3.0), (1.0, 0.0), (None, 2.0)],
                   unit_price("v", "s"))
    assert got == [33.33, None, None]
    pairs = [(3, 9), (3, 0), (3, None), (None, 5), (0, 5)]
    got = evaluate(spark, "n bigint, d bigint", pairs, guarded_rate("n", "d"))
    assert got == [33.33, None, None, None, 0.0]


def test_rounding_of_ties(spark):
    got = evaluate(spark, "v double", [(79864.65,)], half_up(F.col("v") / 10, exact=True))
    assert got == [7986.47]
    assert evaluate(spark, "v double", [(0.125,), (None,)], or_zero(F.col("v"))) == [0.13, 0.0]


def test_geo_struct(spark):
    points = [(48.8, 2.3), (0.0, 2.3), (48.8, 0.0), (None, 2.3), (48.8, None)]
    strict = evaluate(spark, "a double, b double", points, geo_struct("a", "b"))
    assert strict == [(48.8, 2.3), None, None, None, None]
    loose = evaluate(spark, "a double, b double", points, geo_struct("a", "b", False))
    assert loose == [(48.8, 2.3), (0.0, 2.3), (48.8, 0.0), None, None]


def test_quality_flag_ignores_null_rules(spark):
    rules = [F.col("p") < 500, F.col("p") > 30000, F.col("k").isNull()]
    values = [(500.0, "a"), (499.99, "a"), (30000.0, "a"), (30000.01, "a"), (None, "a"), (None, None)]
    assert evaluate(spark, "p double, k string", values, quality_flag(rules)) == [
        "OK", "SUSPECTE", "OK", "SUSPECTE", "OK", "SUSPECTE"]


def test_band_bounds(spark):
    prices = [1499.99, 1500.0, 3499.99, 3500.0, 6999.99, 7000.0, None]
    steps = [(1500, "bas"), (3500, "moyen"), (7000, "eleve")]
    assert evaluate(spark, "p double", [(p,) for p in prices], band("p", steps, "tres_eleve")) == [
        "bas", "moyen", "moyen", "eleve", "eleve", "tres_eleve", None]


def test_zone(spark):
    members = {"centre": ["75"], "inner": ["92", "93"]}
    assert evaluate(spark, "c string", [("75",), ("93",), ("13",), (None,)], zone("c", members)) == [
        "centre", "inner", None, None]


def test_matches_label_is_anchored(spark):
    names = [("opensearch",), ("my-opensearch",), ("opensearch-dashboards",), (None,)]
    assert evaluate(spark, "n string", names, matches_label("n", "opensearch$")) == [
        True, False, False, False]
    assert evaluate(spark, "n string", names, matches_label("n", "", regex=False)) == [
        False, False, False, True]
