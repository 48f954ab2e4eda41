"""Typed documents: conforming, writing, reading back."""

from pyspark.sql import functions as F

from ...operators.clean import project
from ...operators.documents import (
    conform, conformance, replace_collection, sale_documents, write_documents, write_split_documents,
)
from ...operators.enrich import split_on_null
from ...schemas import DOUBLE, INT, LONG, SALE_DOCUMENT, STRING, struct
from ...session import scratch_path
from ...sources import read_documents
from .. import roles
from . import Registry
from .enrichment import ENRICHED_SQL, ONE_AREA, enriched
from .sqltext import AREAS, ESTABLISHMENTS, SALES

registry = Registry()
query = registry.add

CUSTOMER_MAPPING = struct(id=LONG, code=INT, balance=DOUBLE, segment_number=INT, city=STRING)


def _customers(spark, sf_dir):
    return project(roles.table(spark, sf_dir, "customer"), {
        "id": F.col("c_custkey").cast("string"),
        "code": F.col("c_nationkey").cast("string"),
        "balance": F.col("c_acctbal").cast("decimal(18,2)").cast("string"),
        "segment_number": "c_mktsegment",
        "label": "c_name",
    })


@query("""
SELECT c_custkey AS id, c_nationkey AS code, c_acctbal AS balance,
       NULL::integer AS segment_number, NULL::varchar AS city
FROM customer""")
def document_conform(spark, sf_dir):
    return conform(_customers(spark, sf_dir), CUSTOMER_MAPPING)


@query("""
SELECT f.field, f.status, CASE WHEN f.field = 'segment_number' THEN n ELSE 0 END::bigint AS n_lost
FROM (SELECT count(c_mktsegment) AS n FROM customer),
     (VALUES ('id', 'mapped'), ('code', 'mapped'), ('balance', 'mapped'),
             ('segment_number', 'mapped'), ('city', 'missing'), ('label', 'unmapped')) f(field, status)""")
def document_conformance(spark, sf_dir):
    return conformance(_customers(spark, sf_dir), CUSTOMER_MAPPING)


ORDER_MAPPING = struct(order_id=LONG, status=STRING, price=DOUBLE, year=INT)


@query("""
SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS price,
       year(o_orderdate)::integer AS year FROM orders""")
def document_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "orders")
    orders = project(roles.table(spark, sf_dir, "orders"), {
        "order_id": "o_orderkey", "status": "o_orderstatus", "price": "o_totalprice",
        "year": F.year("o_orderdate"),
    })
    write_documents(conform(orders, ORDER_MAPPING), path)
    return read_documents(spark, path, ORDER_MAPPING)


@query(f"""WITH {SALES}, {AREAS}, {ONE_AREA}, {ESTABLISHMENTS}, {ENRICHED_SQL}
SELECT code_commune, nom_commune, code_departement, type_local, annee, mois, valeur_fonciere, prix_m2,
       surface_bati, nb_pieces, nb_entreprises_actives, diversite_sectorielle, nb_creations_annee,
       taux_creation_entreprises, date_mutation::varchar AS date_mutation,
       CASE WHEN latitude <> 0 AND longitude <> 0 THEN latitude END AS lat,
       CASE WHEN latitude <> 0 AND longitude <> 0 THEN longitude END AS lon
FROM enriched""")
def document_union(spark, sf_dir):
    """Sales indexed in two halves, with and without a point, read as one."""
    path = scratch_path(spark, "sales-documents")
    write_split_documents(sale_documents(enriched(spark, sf_dir)), path)
    back = read_documents(spark, path, SALE_DOCUMENT)
    return back.select(
        *[c for c in SALE_DOCUMENT.names if c not in ("date_mutation", "latitude", "longitude", "location")],
        F.col("date_mutation").cast("string").alias("date_mutation"),
        F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"),
    )


@query("""
SELECT count(*) FILTER (c_acctbal > 0) AS n_with, count(*) FILTER (c_acctbal <= 0) AS n_without
FROM customer""")
def document_create_if_absent(spark, sf_dir):
    """The second write finds the collection there and leaves it alone."""
    path = scratch_path(spark, "customers")
    balance = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    customers = project(roles.table(spark, sf_dir, "customer"), {"id": "c_custkey", "balance": balance})
    write_documents(customers, path, mode="ignore")
    write_documents(split_on_null(customers, "balance")[0], path, mode="ignore")
    back = read_documents(spark, path, struct(id=LONG, balance=DOUBLE))
    return back.agg(
        F.count("balance").alias("n_with"), F.count_if(F.col("balance").isNull()).alias("n_without")
    )


@query("""
SELECT f.field, f.status, CASE WHEN f.field = 'segment_number' THEN n ELSE 0 END::bigint AS n_lost,
       (SELECT count(*) FROM customer) AS n_stored
FROM (SELECT count(c_mktsegment) AS n FROM customer),
     (VALUES ('id', 'mapped'), ('code', 'mapped'), ('balance', 'mapped'),
             ('segment_number', 'mapped'), ('city', 'missing'), ('label', 'unmapped')) f(field, status)""")
def replaced_collection(spark, sf_dir):
    """A collection recreated under its mapping: what was lost, observed on the write, and what is stored."""
    path = scratch_path(spark, "replaced")
    customers = _customers(spark, sf_dir)
    write_documents(customers.filter("id % 2 = 0"), path)
    report = replace_collection(customers, path, CUSTOMER_MAPPING)
    stored = read_documents(spark, path, CUSTOMER_MAPPING).agg(F.count("id").alias("n_stored")).first()
    return report.withColumn("n_stored", F.lit(stored.n_stored))
