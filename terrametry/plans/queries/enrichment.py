"""Left joins of dimensions to sales, derived measures and labels."""

import uuid

from pyspark.sql import functions as F

from ...functions import band, geo_struct, guarded_rate, quality_flag, unit_price, zone
from ...operators.clean import project
from ...operators.documents import union_documents
from ...operators.enrich import (
    PRICE_BANDS, TOP_BAND, enrich_left, label_sales, one_row_per_key, quality_totals, salted_left,
    split_on_null, with_creation_rate,
)
from ...operators.profiles import active_profile, creations_by_year, employer_profile
from ...operators.reports import mean
from ...operators.warehouse import create_database, write_bucketed
from ...schemas import ENRICHED_V2, SALE_DOCUMENT
from ...session import scratch_path
from ...sources import read_documents, read_parquet
from .. import roles
from ..territory import TerritoryPaths, build_labelled, build_warehouse, enrich_sales
from . import Registry
from .sqltext import (
    AREAS, ESTABLISHMENTS, LABELLED, SALES, active as active_sql, creations, exact_mean, rounded,
)

registry = Registry()
query = registry.add

ONE_AREA = """
area AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY code_commune
      ORDER BY nom_commune_insee, departement, latitude, longitude) AS rn FROM geography)
  WHERE rn = 1
)"""


def _profile(spark, sf_dir, *keys):
    return active_profile(roles.establishments(spark, sf_dir), keys, sections=roles.SECTIONS)


def _creations(spark, sf_dir, *keys):
    first, last = roles.YEARS
    return creations_by_year(
        roles.openings(spark, sf_dir), keys, first=first, last=last,
        sections=roles.OPENING_SECTIONS,
    )


SALE_COLUMNS = ("id_disposition", "code_commune", "annee", "valeur_fonciere", "prix_m2")


@query(f"""WITH {SALES}, {AREAS}
SELECT id_disposition, code_commune, annee, valeur_fonciere, prix_m2, nom_commune_insee,
       departement, latitude, longitude
FROM sales LEFT JOIN geography USING (code_commune)""")
def left_enrich_geo(spark, sf_dir):
    sales = roles.sales(spark, sf_dir).select(*SALE_COLUMNS)
    # a code has many areas: a broadcast join would compute a sale's columns again for each of them
    joined = enrich_left(sales, [(roles.geography(spark, sf_dir).hint("merge"), ["code_commune"])])
    return joined.select(*SALE_COLUMNS, "nom_commune_insee", "departement", "latitude", "longitude")


@query(f"""WITH {SALES}, {AREAS}, {ONE_AREA}
SELECT id_disposition, code_commune, annee, valeur_fonciere, prix_m2, nom_commune_insee
FROM sales LEFT JOIN area USING (code_commune)""")
def left_enrich_deduped(spark, sf_dir):
    sales = roles.sales(spark, sf_dir).select(*SALE_COLUMNS)
    joined = enrich_left(
        sales, [(roles.geography(spark, sf_dir), ["code_commune"])], dedupe=True
    )
    return joined.select(*SALE_COLUMNS, "nom_commune_insee")


@query(f"""WITH {SALES}, {ESTABLISHMENTS}, profile AS ({active_sql('code_commune')})
SELECT id_disposition, code_commune, annee, valeur_fonciere, prix_m2,
       nb_entreprises_actives, diversite_sectorielle
FROM sales LEFT JOIN profile USING (code_commune)""")
def left_enrich_metrics(spark, sf_dir):
    sales = roles.sales(spark, sf_dir).select(*SALE_COLUMNS)
    joined = enrich_left(sales, [(_profile(spark, sf_dir, "code_commune"), ["code_commune"])])
    return joined.select(*SALE_COLUMNS, "nb_entreprises_actives", "diversite_sectorielle")


@query(f"""WITH {SALES}, {ESTABLISHMENTS}, made AS ({creations('code_commune')})
SELECT id_disposition, code_commune, annee, valeur_fonciere, prix_m2,
       nb_creations_annee, nb_creations_tech
FROM sales LEFT JOIN made USING (code_commune, annee)""")
def left_enrich_composite(spark, sf_dir):
    sales = roles.sales(spark, sf_dir).select(*SALE_COLUMNS)
    joined = enrich_left(
        sales, [(_creations(spark, sf_dir, "code_commune"), ["code_commune", "annee"])]
    )
    return joined.select(*SALE_COLUMNS, "nb_creations_annee", "nb_creations_tech")


ENRICHED_SQL = f"""
profile AS ({active_sql('code_commune')}),
made AS ({creations('code_commune')}),
enriched AS (
  SELECT sales.*, nom_commune_insee, departement, latitude, longitude,
         nb_entreprises_actives, diversite_sectorielle, nb_creations_annee,
         CASE WHEN nb_entreprises_actives > 0
              THEN {rounded('nb_creations_annee * 100 / nb_entreprises_actives')} END
           AS taux_creation_entreprises
  FROM sales LEFT JOIN area USING (code_commune) LEFT JOIN profile USING (code_commune)
             LEFT JOIN made USING (code_commune, annee)
)"""


def enriched(spark, sf_dir):
    return enrich_sales(
        roles.sales(spark, sf_dir), roles.geography(spark, sf_dir),
        _profile(spark, sf_dir, "code_commune"), _creations(spark, sf_dir, "code_commune"),
        dedupe_geography=True, exact=True,
    )


@query(f"""WITH {SALES}, {AREAS}, {ONE_AREA}, {ESTABLISHMENTS}, {ENRICHED_SQL}
SELECT id_disposition, code_commune, code_departement, annee, mois, valeur_fonciere, prix_m2,
       latitude, longitude, nb_entreprises_actives, diversite_sectorielle, nb_creations_annee,
       taux_creation_entreprises
FROM enriched""")
def enriched_sales(spark, sf_dir):
    return enriched(spark, sf_dir).select(
        "id_disposition", "code_commune", "code_departement", "annee", "mois", "valeur_fonciere",
        "prix_m2", "latitude", "longitude", "nb_entreprises_actives", "diversite_sectorielle",
        "nb_creations_annee", "taux_creation_entreprises",
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, o_orderstatus
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""")
def left_enrich_salted(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_partkey", "l_suppkey"
    )
    orders = roles.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("order_key"), "o_custkey", "o_orderstatus"
    )
    joined = salted_left(lines, orders, ["order_key"], salts=8)
    return joined.withColumnRenamed("order_key", "l_orderkey")


SKEWED = "CASE WHEN {key} % 3 = 0 THEN 1 WHEN {key} % 7 = 0 THEN NULL ELSE {key} END"


@query(f"""
WITH lines AS (SELECT {SKEWED.format(key='l_orderkey')} AS order_key, l_orderkey, l_linenumber FROM lineitem)
SELECT order_key, l_orderkey, l_linenumber, o_custkey, o_orderstatus
FROM lines LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON order_key = o_orderkey""")
def left_enrich_skewed(spark, sf_dir):
    """A third of the lines share one key and others have none: both are spread over the salts."""
    lines = roles.table(spark, sf_dir, "lineitem").select(
        F.expr(SKEWED.format(key="l_orderkey")).alias("order_key"), "l_orderkey", "l_linenumber")
    orders = roles.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("order_key"), "o_custkey", "o_orderstatus")
    return salted_left(lines, orders, ["order_key"], salts=16, spread_on=["l_orderkey", "l_linenumber"])


@query(f"""WITH {SALES}, {AREAS}, {ONE_AREA}, {ESTABLISHMENTS}, profile AS ({active_sql('code_commune')})
SELECT id_disposition, code_commune, annee, valeur_fonciere, prix_m2, nom_commune_insee, nb_entreprises_actives
FROM sales LEFT JOIN area USING (code_commune) LEFT JOIN profile USING (code_commune)""")
def left_enrich_bucketed(spark, sf_dir):
    """Sales, areas and profiles bucketed alike by area: both joins run without a shuffle."""
    database = f"buckets_{uuid.uuid4().hex[:8]}"
    create_database(spark, database, scratch_path(spark, "buckets"))
    areas = one_row_per_key(roles.geography(spark, sf_dir), ["code_commune"]).select("code_commune", "nom_commune_insee")
    profile = _profile(spark, sf_dir, "code_commune").select("code_commune", "nb_entreprises_actives")
    sales, areas, profile = (
        write_bucketed(df, f"`{database}`.{name}", ["code_commune"], 8) for name, df in (
            ("sales", roles.sales(spark, sf_dir).select(*SALE_COLUMNS)), ("areas", areas), ("profile", profile)))
    return enrich_left(sales, [(areas.hint("merge"), ["code_commune"]), (profile.hint("merge"), ["code_commune"])]).select(
        *SALE_COLUMNS, "nom_commune_insee", "nb_entreprises_actives")


NAF = {"BUILDING": "68.20A", "AUTOMOBILE": "41.20B", "MACHINERY": "62.01Z", "HOUSEHOLD": "47.11F"}
_NAF_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAF.items()) + " ELSE '10.11Z' END"
_FIRMS_SQL = f"""
firms AS (SELECT c_custkey AS siret, lpad(c_nationkey::varchar, 2, '0') || lpad((c_custkey % 1000)::varchar, 3, '0') AS code_commune,
                 substring({_NAF_SQL}, 1, 2) AS section_naf, c_acctbal > 0 AS active, 2016 + c_custkey % 10 AS annee FROM customer),
profile AS (SELECT code_commune, count(*) AS nb_entreprises_actives, count(DISTINCT section_naf) AS diversite_sectorielle,
                   count(*) FILTER (section_naf = '62') AS nb_entreprises_tech FROM firms WHERE active GROUP BY 1),
made AS (SELECT code_commune, annee, count(*) AS nb_creations_annee FROM firms WHERE annee BETWEEN 2019 AND 2025 GROUP BY ALL)"""


def _raw_files(spark, sf_dir, folder):
    """The given tables as the raw files of the job: sales 24 years on in packed files of few rows, areas, and firms as multi-line text.

    Each is written by as many tasks as read the input.
    """
    later = F.date_format(F.add_months(F.to_date(F.col("Date mutation"), "dd/MM/yyyy"), 288), "dd/MM/yyyy")
    roles.raw_sales(spark, sf_dir).withColumn("Date mutation", later).write.option("maxRecordsPerFile", 500_000).csv(
        f"{folder}/sales", sep="|", header=True, encoding="iso-8859-1", compression="gzip")
    code = F.concat(roles.department(), roles.commune_part("c_custkey"))
    customers = roles.table(spark, sf_dir, "customer")
    project(customers, {
        "code_commune_INSEE": code, "nom_commune_postal": "c_name", "code_departement": roles.department(),
        "latitude": F.col("c_acctbal").cast("decimal(18,2)").cast("string"), "longitude": (F.col("c_nationkey") - 12).cast("string"),
    }).write.csv(f"{folder}/areas", header=True)
    naf = F.lit("10.11Z")
    for segment, activity in NAF.items():
        naf = F.when(F.col("c_mktsegment") == segment, activity).otherwise(naf)
    project(customers, {
        "siret": F.col("c_custkey").cast("string"), "codeCommuneEtablissement": code,
        "libelleCommuneEtablissement": F.concat(F.col("c_name"), F.lit('\n"bis", ter')), "codePostalEtablissement": F.lit("00000"),
        "activitePrincipaleEtablissement": naf, "etatAdministratifEtablissement": F.when(F.col("c_acctbal") > 0, "A").otherwise("F"),
        "dateCreationEtablissement": F.concat((2016 + F.col("c_custkey") % 10).cast("string"), F.lit("-05-17")),
        "trancheEffectifsEtablissement": F.lit("11"), "etablissementSiege": F.lit("true"), "caractereEmployeurEtablissement": F.lit("O"),
    }).write.csv(f"{folder}/firms", header=True, quoteAll=True, escape='"')


@query(f"""WITH {LABELLED}, {AREAS}, {ONE_AREA}, {_FIRMS_SQL},
joined AS (SELECT labelled.* EXCLUDE (annee), labelled.annee + 24 AS annee, nom_commune_insee, latitude, nb_entreprises_actives,
                  diversite_sectorielle, nb_entreprises_tech FROM labelled LEFT JOIN area USING (code_commune) LEFT JOIN profile USING (code_commune))
SELECT code_departement, annee, qualite_donnee, categorie_prix, count(*) AS n, sum(valeur_fonciere::decimal(18,2))::double AS total,
       count(nom_commune_insee) AS n_placed, sum(nb_entreprises_actives)::bigint AS n_active, sum(diversite_sectorielle)::bigint AS n_sections,
       sum(nb_entreprises_tech)::bigint AS n_tech, sum(nb_creations_annee)::bigint AS n_made,
       sum(CASE WHEN nb_entreprises_actives > 0 THEN {rounded('nb_creations_annee * 100 / nb_entreprises_actives')}::decimal(18,2) END)::double AS rates,
       (SELECT count(*) FROM labelled) AS n_sales, (SELECT count(*) FROM labelled) AS n_documents
FROM joined LEFT JOIN made USING (code_commune, annee) GROUP BY ALL""")
def warehouse_job(spark, sf_dir):
    """The whole job over text files of the given tables: clean, profile, join, write, verify, register, index, label."""
    folder, database = scratch_path(spark, "raw"), f"job_{uuid.uuid4().hex[:8]}"
    _raw_files(spark, sf_dir, folder)
    create_database(spark, database, scratch_path(spark, "job"))
    paths = TerritoryPaths(f"{folder}/sales", f"{folder}/areas", f"{folder}/firms", scratch_path(spark, "warehouse"),
                           scratch_path(spark, "documents"), database=database)
    summary = build_warehouse(spark, paths, roles.RULES, "fixed", dedupe_geography=True, exact=True).first()
    target = scratch_path(spark, "warehouse-v2")
    build_labelled(spark, paths.warehouse, target)
    n_documents = read_documents(spark, paths.documents, SALE_DOCUMENT).count()
    sold = read_parquet(spark, target, ENRICHED_V2)
    return sold.groupBy("code_departement", "annee", "qualite_donnee", "categorie_prix").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("valeur_fonciere").cast("decimal(18,2)")).cast("double").alias("total"),
        F.count("nom_commune_insee").alias("n_placed"), F.sum("nb_entreprises_actives").alias("n_active"),
        F.sum("diversite_sectorielle").alias("n_sections"), F.sum("nb_entreprises_tech").alias("n_tech"),
        F.sum("nb_creations_annee").alias("n_made"),
        F.sum(F.col("taux_creation_entreprises").cast("decimal(18,2)")).cast("double").alias("rates"),
        F.lit(summary["total_transactions"]).cast("bigint").alias("n_sales"), F.lit(n_documents).cast("bigint").alias("n_documents"))


@query(f"""WITH {ESTABLISHMENTS}, {AREAS}, {ONE_AREA}, named AS (
  SELECT code_commune, nom_commune, count(siret) AS nb_entreprises_actives
  FROM establishments WHERE etat = 'A' GROUP BY ALL)
SELECT code_commune, nom_commune, nb_entreprises_actives, latitude AS lat, longitude AS lon
FROM named LEFT JOIN area USING (code_commune)""")
def profile_with_coordinates(spark, sf_dir):
    profile = employer_profile(roles.establishments(spark, sf_dir), sections={})
    areas = one_row_per_key(roles.geography(spark, sf_dir), ["code_commune"])
    points = areas.select(
        "code_commune", geo_struct("latitude", "longitude", zero_is_missing=False).alias("location")
    )
    return enrich_left(profile, [(points, ["code_commune"])]).select(
        "code_commune", "nom_commune", "nb_entreprises_actives",
        F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"),
    )


@query(f"""WITH {ESTABLISHMENTS}, made AS ({creations('code_departement')}),
profile AS ({active_sql('code_departement')})
SELECT code_departement, annee, nb_creations_annee, nb_entreprises_actives,
       CASE WHEN nb_entreprises_actives > 0
            THEN {rounded('nb_creations_annee * 100 / nb_entreprises_actives')} END AS rate
FROM made LEFT JOIN profile USING (code_departement)""")
def creation_rate(spark, sf_dir):
    made = _creations(spark, sf_dir, "code_departement")
    joined = enrich_left(made, [(_profile(spark, sf_dir, "code_departement"), ["code_departement"])])
    return joined.select(
        "code_departement", "annee", "nb_creations_annee", "nb_entreprises_actives",
        guarded_rate("nb_creations_annee", "nb_entreprises_actives", exact=True).alias("rate"),
    )


@query(f"""WITH {AREAS}
SELECT nom_commune_insee,
       CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL AND latitude <> 0 AND longitude <> 0
            THEN latitude END AS lat,
       CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL AND latitude <> 0 AND longitude <> 0
            THEN longitude END AS lon
FROM geography""", name="geo_struct")
def geo_points(spark, sf_dir):
    located = roles.geography(spark, sf_dir).select(
        "nom_commune_insee", geo_struct("latitude", "longitude").alias("p")
    )
    return located.select("nom_commune_insee", "p.lat", "p.lon")


@query(f"""WITH {AREAS}, halves AS (
  SELECT *, latitude <> 0 AND longitude <> 0 AS located FROM geography)
SELECT located, count(*) AS n, count(DISTINCT code_commune) AS n_areas FROM halves GROUP BY 1""")
def location_split(spark, sf_dir):
    placed = roles.geography(spark, sf_dir).withColumn("location", geo_struct("latitude", "longitude"))
    whole = union_documents(*split_on_null(placed, "location"))
    return whole.groupBy(F.col("location").isNotNull().alias("located")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("code_commune").alias("n_areas")
    )


@query(f"""WITH {LABELLED}
SELECT qualite_donnee, categorie_prix, count(*) AS n, {exact_mean('prix_m2')} AS mean_price
FROM labelled GROUP BY ALL""")
def quality_and_band(spark, sf_dir):
    labelled = label_sales(roles.sales(spark, sf_dir))
    return labelled.groupBy("qualite_donnee", "categorie_prix").agg(
        F.count(F.lit(1)).alias("n"), mean("prix_m2", exact=True).alias("mean_price")
    )


@query("""
SELECT p_partkey, CASE WHEN p_retailprice <= 0 OR p_size < 5 OR p_type IS NULL
                       THEN 'SUSPECTE' ELSE 'OK' END AS flag
FROM part""", name="quality_flag")
def quality_flags(spark, sf_dir):
    rules = [F.col("p_retailprice") <= 0, F.col("p_size") < 5, F.col("p_type").isNull()]
    return roles.table(spark, sf_dir, "part").select("p_partkey", quality_flag(rules).alias("flag"))


@query(f"""
SELECT price_band, count(*) AS n FROM (
  SELECT CASE WHEN p < 1500 THEN 'bas' WHEN p < 3500 THEN 'moyen' WHEN p < 7000 THEN 'eleve'
              WHEN p IS NOT NULL THEN 'tres_eleve' END AS price_band
  FROM (SELECT {rounded('l_extendedprice / l_quantity')} AS p FROM lineitem))
GROUP BY 1""")
def price_band(spark, sf_dir):
    priced = roles.table(spark, sf_dir, "lineitem").select(
        unit_price("l_extendedprice", "l_quantity", exact=True).alias("p")
    )
    return priced.groupBy(band("p", PRICE_BANDS, TOP_BAND).alias("price_band")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
SELECT zone, count(*) AS n FROM (
  SELECT CASE WHEN code = '05' THEN 'centre' WHEN code IN ('02', '03', '04') THEN 'inner'
              WHEN code IN ('07', '08', '11', '15') THEN 'outer' END AS zone
  FROM (SELECT lpad(c_nationkey::varchar, 2, '0') AS code FROM customer))
GROUP BY 1""")
def zone_lookup(spark, sf_dir):
    members = {"centre": ["05"], "inner": ["02", "03", "04"], "outer": ["07", "08", "11", "15"]}
    customers = roles.table(spark, sf_dir, "customer").select(roles.department().alias("code"))
    return customers.groupBy(zone("code", members).alias("zone")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {LABELLED}
SELECT count(*) AS n_total, count(*) FILTER (qualite_donnee = 'OK') AS n_ok,
       count(*) FILTER (qualite_donnee = 'SUSPECTE') AS n_suspect FROM labelled""", name="quality_totals")
def quality_totals_all(spark, sf_dir):
    return quality_totals(label_sales(roles.sales(spark, sf_dir)))


@query(f"""WITH {SALES}, {ESTABLISHMENTS},
sold AS (SELECT code_departement, annee, count(*) AS n_sales, {exact_mean('prix_m2')} AS mean_price
         FROM sales GROUP BY ALL),
profile AS ({active_sql('code_departement')}),
made AS ({creations('code_departement')})
SELECT code_departement, annee, n_sales, mean_price, nb_entreprises_actives,
       diversite_sectorielle, nb_creations_annee,
       CASE WHEN nb_entreprises_actives > 0
            THEN {rounded('nb_creations_annee * 100 / nb_entreprises_actives')} END
         AS taux_creation_entreprises
FROM sold LEFT JOIN profile USING (code_departement) LEFT JOIN made USING (code_departement, annee)""")
def territory_overview(spark, sf_dir):
    """Flagship: sales, mean unit price and business activity per department and
    year. Sales are aggregated first, so the joins run on the few result rows."""
    sold = roles.sales(spark, sf_dir).groupBy("code_departement", "annee").agg(
        F.count(F.lit(1)).alias("n_sales"), mean("prix_m2", exact=True).alias("mean_price")
    )
    joined = enrich_left(sold, [
        (_profile(spark, sf_dir, "code_departement"), ["code_departement"]),
        (_creations(spark, sf_dir, "code_departement"), ["code_departement", "annee"]),
    ])
    return with_creation_rate(joined, exact=True).select(
        "code_departement", "annee", "n_sales", "mean_price", "nb_entreprises_actives",
        "diversite_sectorielle", "nb_creations_annee", "taux_creation_entreprises",
    )
