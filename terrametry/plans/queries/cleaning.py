"""Typing, codes, filters and retention over the sales tables."""

from pyspark.sql import functions as F

from ...functions import compose_code, date_from_text, number_from_text, prefix, unit_price
from ...operators.clean import (
    has_length, project, rename, retention, strictly_between, type_transactions,
)
from ...operators.warehouse import partition_inventory
from .. import roles
from . import Registry
from .sqltext import RAW, SALES, rounded

registry = Registry()
query = registry.add


@query("""
SELECT l_returnflag, count(n) AS n_parsed, sum(n::decimal(18,2))::double AS total,
       min(n) AS low, max(n) AS high
FROM (SELECT l_returnflag, l_extendedprice::decimal(18,2)::double AS n FROM lineitem)
GROUP BY l_returnflag""")
def decimal_comma_parse(spark, sf_dir):
    text = F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    parsed = roles.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", number_from_text(text, ",").alias("n")
    )
    return parsed.groupBy("l_returnflag").agg(
        F.count("n").alias("n_parsed"),
        F.sum(F.col("n").cast("decimal(18,2)")).cast("double").alias("total"),
        F.min("n").alias("low"), F.max("n").alias("high"),
    )


@query("""
SELECT year(o_orderdate)::integer AS annee, month(o_orderdate)::integer AS mois,
       count(*) AS n, min(o_orderdate)::date::varchar AS first_day
FROM orders GROUP BY ALL""")
def date_parts(spark, sf_dir):
    day = date_from_text(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy")
    dated = roles.table(spark, sf_dir, "orders").select(day.alias("d"))
    return dated.groupBy(F.year("d").alias("annee"), F.month("d").alias("mois")).agg(
        F.count(F.lit(1)).alias("n"), F.min("d").cast("string").alias("first_day")
    )


@query("""
SELECT c_custkey,
       CASE WHEN length(c_nationkey::varchar || c_custkey::varchar) >= 5
            THEN left(c_nationkey::varchar || c_custkey::varchar, 5)
            ELSE lpad(c_nationkey::varchar || c_custkey::varchar, 5, '0') END AS code_joined,
       lpad(c_nationkey::varchar, 2, '0')
         || CASE WHEN length(c_custkey::varchar) >= 3 THEN left(c_custkey::varchar, 3)
                 ELSE lpad(c_custkey::varchar, 3, '0') END AS code_fixed
FROM customer""")
def composite_code(spark, sf_dir):
    area, unit = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
    return roles.table(spark, sf_dir, "customer").select(
        "c_custkey",
        compose_code(area, unit).alias("code_joined"),
        compose_code(area, unit, "fixed").alias("code_fixed"),
    )


@query("SELECT substring(c_mktsegment, 1, 2) AS section, count(*) AS n FROM customer GROUP BY 1")
def code_prefix(spark, sf_dir):
    customers = roles.table(spark, sf_dir, "customer")
    return customers.groupBy(prefix("c_mktsegment").alias("section")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey AS supplier, s_nationkey AS nation FROM supplier")
def rename_drop(spark, sf_dir):
    return rename(
        roles.table(spark, sf_dir, "supplier"),
        {"s_suppkey": "supplier", "s_nationkey": "nation"}, drop=["s_name", "s_acctbal"],
    )


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_linestatus IN ('O') GROUP BY ALL""")
def membership_filter(spark, sf_dir):
    kept = roles.table(spark, sf_dir, "lineitem").filter(
        F.col("l_returnflag").isin("A", "R") & F.col("l_linestatus").isin("O")
    )
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT year(o_orderdate)::integer AS annee, count(*) AS n FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1""")
def year_between(spark, sf_dir):
    low, high = roles.YEARS
    orders = roles.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("annee"))
    return orders.filter(F.col("annee").between(low, high)).groupBy("annee").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("SELECT DISTINCT l_returnflag, l_shipdate FROM lineitem")
def distinct_pairs(spark, sf_dir):
    return partition_inventory(
        roles.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_shipdate"]
    )


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
       {rounded('l_extendedprice / l_quantity')} AS unit_price
FROM lineitem""", name="unit_price")
def unit_prices(spark, sf_dir):
    return roles.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        unit_price("l_extendedprice", "l_quantity", exact=True).alias("unit_price"),
    )


@query("""
SELECT l_linestatus, count(*) AS n FROM lineitem
WHERE l_extendedprice > 1000 AND l_extendedprice < 90000 AND l_quantity > 5 AND l_quantity < 50
  AND l_shipdate IS NOT NULL
GROUP BY 1""")
def outlier_filter(spark, sf_dir):
    kept = roles.table(spark, sf_dir, "lineitem").filter(
        strictly_between("l_extendedprice", 1000, 90_000) & strictly_between("l_quantity", 5, 50)
        & F.col("l_shipdate").isNotNull()
    )
    return kept.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT n_name, n_nationkey FROM nation WHERE n_name IS NOT NULL AND length(n_name) = 8""")
def length_filter(spark, sf_dir):
    named = roles.table(spark, sf_dir, "nation").filter(has_length("n_name", 8))
    return project(named, {"n_name": "n_name", "n_nationkey": "n_nationkey"})


@query(f"""WITH {RAW}
SELECT annee, mois, code_departement, count(*) AS n, count(DISTINCT code_commune) AS n_areas,
       min(date_mutation)::varchar AS first_day, sum(valeur_fonciere::decimal(18,2))::double AS total,
       sum(nb_pieces)::bigint AS rooms, sum(surface_terrain::decimal(18,2))::double AS land
FROM raw GROUP BY ALL""")
def typed_transactions(spark, sf_dir):
    typed = type_transactions(roles.raw_sales(spark, sf_dir), roles.RULES)
    return typed.groupBy("annee", "mois", "code_departement").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("code_commune").alias("n_areas"),
        F.min("date_mutation").cast("string").alias("first_day"),
        F.sum(F.col("valeur_fonciere").cast("decimal(18,2)")).cast("double").alias("total"),
        F.sum("nb_pieces").alias("rooms"),
        F.sum(F.col("surface_terrain").cast("decimal(18,2)")).cast("double").alias("land"),
    )


@query(f"WITH {SALES} SELECT * EXCLUDE (date_mutation), date_mutation::varchar AS date_mutation FROM sales")
def clean_sales(spark, sf_dir):
    cleaned = roles.cleaned_raw_sales(spark, sf_dir)
    return cleaned.withColumn("date_mutation", F.col("date_mutation").cast("string"))


@query("""
SELECT count(*) AS n_total, count(*) FILTER (l_quantity > 5 AND l_returnflag IN ('A', 'R')) AS n_kept,
       count(*) FILTER (l_quantity > 5 AND l_returnflag IN ('A', 'R')) * 100 / count(*)::double AS kept_pct
FROM lineitem""")
def retention_ratio(spark, sf_dir):
    return retention(
        roles.table(spark, sf_dir, "lineitem"),
        (F.col("l_quantity") > 5) & F.col("l_returnflag").isin("A", "R"),
    )
