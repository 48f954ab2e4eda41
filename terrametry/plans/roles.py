"""The given tables in the roles of the domain: sales, areas, messages, samples.

Sale = line item with its order and customer; area = customer; establishment =
customer; energy message, log event and metric sample = event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import compose_code, number_from_text
from ..operators.clean import SaleRules, clean_transactions, keep_valid_sales, project

RULES = SaleRules(kinds=("A", "R"), natures=("F", "O"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(c, width: int):
    return F.lpad(c.cast("string"), width, "0")


def department():
    return _code(F.col("c_nationkey"), 2)


def commune_part(customer: str):
    return _code(F.col(customer) % 1000, 3)


def _decimal_text(c: str):
    return F.col(c).cast("decimal(18,2)").cast("string")


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order and customer columns."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return lines.join(placed, lines.l_orderkey == placed.o_orderkey)


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as the delimited input shows them: all text, decimal comma."""
    return project(sale_lines(spark, sf_dir), {
        "No disposition": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "Nature mutation": "o_orderstatus",
        "Date mutation": F.date_format("o_orderdate", "dd/MM/yyyy"),
        "Valeur fonciere": F.replace(_decimal_text("l_extendedprice"), F.lit("."), F.lit(",")),
        "Code departement": department(),
        "Code commune": commune_part("o_custkey"),
        "Commune": "c_name",
        "Code postal": "o_orderpriority",
        "Type local": "l_returnflag",
        "Surface reelle bati": _decimal_text("l_quantity"),
        "Nombre pieces principales": F.concat(F.col("l_linenumber").cast("string"), F.lit(".7")),
        "Surface terrain": _decimal_text("l_discount"),
    })


def cleaned_raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by way of their text form, as from the delimited input."""
    return clean_transactions(raw_sales(spark, sf_dir), RULES, exact=True)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sales from the typed columns: no text to render and parse, and
    the value bounds reach the scan."""
    typed = project(sale_lines(spark, sf_dir), {
        "id_disposition": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "nature_mutation": "o_orderstatus",
        "date_mutation": F.to_date("o_orderdate"),
        "annee": F.year("o_orderdate"),
        "mois": F.month("o_orderdate"),
        "valeur_fonciere": "l_extendedprice",
        "code_departement": department(),
        "code_commune": compose_code(department(), commune_part("o_custkey"), "fixed"),
        "nom_commune": "c_name",
        "code_postal": "o_orderpriority",
        "type_local": "l_returnflag",
        "surface_bati": "l_quantity",
        "nb_pieces": "l_linenumber",
        "surface_terrain": "l_discount",
    })
    return keep_valid_sales(typed, RULES, exact=True)


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas with coordinates; one area code may occur several times."""
    return project(table(spark, sf_dir, "customer"), {
        "code_commune": F.concat(department(), commune_part("c_custkey")),
        "nom_commune_insee": "c_name",
        "departement": department(),
        "latitude": number_from_text(_decimal_text("c_acctbal")),
        "longitude": (F.col("c_nationkey") - 12).cast("double"),
    })


def establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as establishments: active while their balance is positive."""
    return project(table(spark, sf_dir, "customer"), {
        "siret": "c_custkey",
        "code_commune": F.concat(department(), commune_part("c_custkey")),
        "code_departement": department(),
        "nom_commune": "c_nationkey",
        "section_naf": F.substring("c_mktsegment", 1, 2),
        "etat": F.when(F.col("c_acctbal") > 0, "A").otherwise("F"),
        "est_employeur": F.when(F.col("c_acctbal") > 5000, "O").otherwise("N"),
    })


def openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as openings of establishments in the customer's area."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return project(orders.join(customers, orders.o_custkey == customers.c_custkey), {
        "siret": "o_orderkey",
        "code_commune": F.concat(department(), commune_part("c_custkey")),
        "code_departement": department(),
        "section_naf": F.substring("c_mktsegment", 1, 2),
        "annee_creation": F.year("o_orderdate"),
    })


SECTIONS = {
    "nb_entreprises_immobilier": "BU", "nb_entreprises_construction": "AU",
    "nb_entreprises_tech": "MA", "nb_entreprises_commerce": "HO",
}
OPENING_SECTIONS = {"nb_creations_tech": "MA", "nb_creations_construction": "AU"}
YEARS = (1996, 2000)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log events: type is the level, user the host."""
    return project(events(spark, sf_dir), {
        "ts": "ts", "level": "event_type", "host": F.concat(F.lit("host-"), F.col("user_id")),
        "message": "props", "event_id": "event_id",
    })


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric samples: type is the metric, user the instance."""
    return project(events(spark, sf_dir), {
        "ts": "ts", "metric": "event_type",
        "instance": F.col("user_id").cast("string"),
        "value": F.col("value").cast("decimal(18,2)"),
    })
