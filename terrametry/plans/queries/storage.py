"""Round trips through delimited text, Parquet folders and the catalog."""

import uuid

from pyspark.sql import functions as F

from ...operators.warehouse import (
    create_database, list_partitions, partition_inventory, register_table, reused, verify_write,
    write_partitioned,
)
from ...operators.sketches import bitmap_table, distinct_of, rolled_up, with_codes
from ...schemas import DOUBLE, INT, STRING, TableSpec, all_strings, struct
from ...session import scratch_path, stage
from ...sources import preview, profile_schema, read_delimited, read_multiline, read_parquet, read_table
from .. import roles
from . import Registry
from .sqltext import SALES, exact_mean

registry = Registry()
query = registry.add

SALE_TABLE = struct(
    id_disposition=STRING, code_commune=STRING, valeur_fonciere=DOUBLE, prix_m2=DOUBLE,
    code_departement=STRING, annee=INT,
)
KEYS = ("code_departement", "annee")


def _written_sales(spark, sf_dir):
    path = scratch_path(spark, "sales")
    written = write_partitioned(roles.sales(spark, sf_dir).select(*SALE_TABLE.names), path, KEYS)
    return path, written.get["rows"]


@query("SELECT c_custkey::varchar AS c_custkey, c_name, c_mktsegment FROM customer")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "pipes")
    rows = roles.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment"
    )
    rows.write.csv(path, sep="|", header=True, encoding="iso-8859-1")
    return read_delimited(spark, path, all_strings(rows.columns), sep="|", encoding="latin1")


@query("""
SELECT doc_id::varchar AS doc_id, source, sha256(text) AS text_sha256, length(text)::bigint AS n_text,
       coalesce(contains(text, chr(10)), false) AS has_break, text = '' AS is_empty
FROM (SELECT doc_id, source, CASE WHEN doc_id % 97 = 5 THEN NULL WHEN doc_id % 97 = 6 THEN '' ELSE text END AS text FROM documents)""")
def csv_multiline(spark, sf_dir):
    """Texts with line breaks and quotes, a file for each task that reads them, read back in parallel byte for byte; NULL and empty are two things."""
    path = scratch_path(spark, "texts")
    doc = F.col("doc_id") % 97
    rows = roles.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "source",
        F.when(doc == 5, None).when(doc == 6, "").otherwise(F.col("text")).alias("text"),
    )
    rows.write.csv(
        path, header=True, quoteAll=True, escape='"', emptyValue="", nullValue="\\N",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    back = read_multiline(spark, path, all_strings(rows.columns), null_value="\\N")
    return back.select(
        "doc_id", "source", F.sha2("text", 256).alias("text_sha256"), F.length("text").cast("bigint").alias("n_text"),
        F.coalesce(F.col("text").contains("\n"), F.lit(False)).alias("has_break"), (F.col("text") == "").alias("is_empty"),
    )


@query("""
SELECT year(o_orderdate)::integer AS annee, count(*) AS n,
       sum(o_totalprice::decimal(18,2))::double AS total
FROM orders GROUP BY 1""")
def multi_file_union(spark, sf_dir):
    """One folder of text per year, read as one relation."""
    path = scratch_path(spark, "yearly")
    orders = roles.table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.year("o_orderdate").alias("annee"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
    )
    orders.hint("rebalance", "year").write.partitionBy("year").csv(path, sep="|", header=True)
    back = read_delimited(spark, f"{path}/year=*", all_strings(["annee", "total"]), sep="|")
    return back.groupBy(F.col("annee").try_cast("int").alias("annee")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("total").try_cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(f"""WITH {SALES}
SELECT code_departement, annee, count(*) AS n, sum(valeur_fonciere::decimal(18,2))::double AS total
FROM sales GROUP BY ALL""")
def partitioned_roundtrip(spark, sf_dir):
    path, _ = _written_sales(spark, sf_dir)
    back = read_parquet(spark, path, SALE_TABLE)
    return back.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("valeur_fonciere").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(f"WITH {SALES} SELECT DISTINCT code_departement, annee FROM sales", name="partition_inventory")
def stored_partitions(spark, sf_dir):
    path, _ = _written_sales(spark, sf_dir)
    return partition_inventory(read_parquet(spark, path, SALE_TABLE), KEYS)


def _registered(spark, sf_dir):
    path, _ = _written_sales(spark, sf_dir)
    database = f"territory_{uuid.uuid4().hex[:8]}"
    create_database(spark, database, scratch_path(spark, "database"))
    spec = TableSpec(database, "sales", SALE_TABLE, KEYS, path)
    register_table(spark, spec)
    return spec


@query(f"""WITH {SALES}
SELECT code_departement, count(*) AS n, {exact_mean('prix_m2')} AS mean_price
FROM sales GROUP BY 1""")
def catalog_table_sql(spark, sf_dir):
    spec = _registered(spark, sf_dir)
    return read_table(spark, f"""
        SELECT code_departement, count(*) AS n,
               CAST(sum(CAST(prix_m2 AS DECIMAL(18,2))) AS DOUBLE) / count(prix_m2) AS mean_price
        FROM {spec.qualified} GROUP BY code_departement ORDER BY mean_price DESC""")


@query(f"""WITH {SALES}
SELECT DISTINCT 'code_departement=' || code_departement || '/annee=' || annee AS partition FROM sales""")
def catalog_partitions(spark, sf_dir):
    return list_partitions(spark, _registered(spark, sf_dir).qualified)


@query(f"WITH {SALES} SELECT count(*) AS n_expected, count(*) AS n_read, true AS complete FROM sales")
def write_verification(spark, sf_dir):
    """Counts and row hashes, observed on the write and taken again on the read."""
    path = scratch_path(spark, "sales")
    written = write_partitioned(roles.sales(spark, sf_dir).select(*SALE_TABLE.names), path, KEYS, fingerprint=True)
    return verify_write(spark, path, written.get, SALE_TABLE, KEYS)


@query(f"""WITH {SALES},
seen AS (SELECT code_departement AS department, annee AS year, code_commune FROM sales)
SELECT department, year, count(DISTINCT code_commune) AS n_areas FROM seen GROUP BY GROUPING SETS ((department, year), (department), ())""")
def distinct_areas(spark, sf_dir):
    """Exact distinct areas per department and year, per department and overall, from one stored bitmap table."""
    sold = roles.sales(spark, sf_dir).select(
        F.col("code_departement").alias("department"), F.col("annee").alias("year"), "code_commune")
    coded = sold.join(with_codes(sold, "code_commune"), "code_commune")
    levels = [("department", "year"), ("department",), ()]
    bitmaps = stage(bitmap_table(coded, levels[0]), "bitmaps")
    parts = [bitmaps, rolled_up(bitmaps, levels[1]), rolled_up(bitmaps, levels[2])]
    counted = [distinct_of(part, by, "n_areas").withColumns({c: F.lit(None).cast(bitmaps.schema[c].dataType) for c in levels[0] if c not in by})
               for part, by in zip(parts, levels)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("SELECT least(3, count(*)) AS n_rows, least(3, count(*)) AS n_known FROM orders")
def preview_rows(spark, sf_dir):
    """A preview has three rows of the table, whichever they are."""
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shown = preview(orders, 3)
    known = shown.join(orders.withColumn("known", F.lit(1)), ["o_orderkey", "o_orderdate"], "left")
    return known.agg(F.count(F.lit(1)).alias("n_rows"), F.count("known").alias("n_known"))


@query("""
SELECT o_orderstatus AS status, count(*) AS n, sum(o_totalprice::decimal(18,2))::double AS total,
       (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS n_kept FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def reused_aggregates(spark, sf_dir):
    """A cleaned frame kept for two aggregates, released once both are written."""
    kept = roles.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    with reused(kept) as orders:
        by_status = stage(orders.groupBy(F.col("o_orderstatus").alias("status")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")), "by-status")
        n_kept = orders.count()
    return by_status.withColumn("n_kept", F.lit(n_kept).cast("bigint"))


@query("""
SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, count(*) AS n_rows,
       count(*) - count(o_orderkey) AS n_nulls, count(DISTINCT o_orderkey) AS n_distinct FROM orders
UNION ALL SELECT 'o_custkey', 'bigint', count(*), count(*) - count(o_custkey), count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(*), count(*) - count(o_orderstatus), count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(*), count(*) - count(o_totalprice), count(DISTINCT o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(*), count(*) - count(o_orderdate), count(DISTINCT o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', count(*), count(*) - count(o_orderpriority), count(DISTINCT o_orderpriority) FROM orders
""", name="schema_profile")
def exact_profile(spark, sf_dir):
    return profile_schema(roles.table(spark, sf_dir, "orders"), exact=True)


@query("""
SELECT column_name, data_type, n_rows, n_nulls, true AS within_bound FROM (SELECT count(*) AS n_rows, 0::bigint AS n_nulls FROM lineitem),
     (VALUES ('l_orderkey', 'bigint'), ('l_partkey', 'bigint'), ('l_suppkey', 'bigint'), ('l_linenumber', 'int'),
             ('l_quantity', 'double'), ('l_extendedprice', 'double'), ('l_discount', 'double'), ('l_tax', 'double'),
             ('l_returnflag', 'string'), ('l_linestatus', 'string'), ('l_shipdate', 'timestamp_ntz')) c(column_name, data_type)""",
       name="schema_profile_sketch")
def sketch_profile(spark, sf_dir):
    """The one-scan profile; its distinct counts lie within three times the sketch's standard error of 5 %."""
    lines = roles.table(spark, sf_dir, "lineitem")
    exact = profile_schema(lines, exact=True).select("column_name", F.col("n_distinct").alias("n_exact"))
    off = F.abs(F.col("n_distinct") - F.col("n_exact")) / F.greatest("n_exact", F.lit(1))
    return profile_schema(lines).join(exact, "column_name").select(
        "column_name", "data_type", "n_rows", "n_nulls", (off <= 0.15).alias("within_bound"))
