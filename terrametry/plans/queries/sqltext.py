"""Shared parts of the checking SQL."""


def rounded(expression: str, digits: int = 2) -> str:
    return f"round(cast({expression} as decimal(28,8)), {digits})::double"


def exact_mean(column: str) -> str:
    return f"(sum({column}::decimal(18,2))::double / count({column}))"


RAW = """
raw AS (
  SELECT l_orderkey || '-' || l_linenumber AS id_disposition, o_orderstatus AS nature_mutation,
         o_orderdate::date AS date_mutation, year(o_orderdate)::integer AS annee,
         month(o_orderdate)::integer AS mois, l_extendedprice::decimal(18,2)::double AS valeur_fonciere,
         lpad(c_nationkey::varchar, 2, '0') AS code_departement,
         lpad(c_nationkey::varchar, 2, '0') || lpad((o_custkey % 1000)::varchar, 3, '0') AS code_commune,
         c_name AS nom_commune, o_orderpriority AS code_postal, l_returnflag AS type_local,
         l_quantity::decimal(18,2)::double AS surface_bati, l_linenumber::integer AS nb_pieces,
         l_discount::decimal(18,2)::double AS surface_terrain
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)"""

SALES = RAW + f""",
priced AS (
  SELECT *, {rounded('valeur_fonciere / surface_bati')} AS prix_m2 FROM raw
  WHERE type_local IN ('A', 'R') AND nature_mutation IN ('F', 'O')
    AND valeur_fonciere > 1000 AND valeur_fonciere < 50000000
    AND surface_bati > 5 AND surface_bati < 2000
),
sales AS (SELECT * FROM priced WHERE prix_m2 > 100 AND prix_m2 < 50000)"""

LABELLED = SALES + """,
labelled AS (
  SELECT *,
    CASE WHEN valeur_fonciere <= 0 OR surface_bati <= 0 OR prix_m2 < 500 OR prix_m2 > 30000
              OR type_local IS NULL THEN 'SUSPECTE' ELSE 'OK' END AS qualite_donnee,
    CASE WHEN prix_m2 < 1500 THEN 'bas' WHEN prix_m2 < 3500 THEN 'moyen'
         WHEN prix_m2 < 7000 THEN 'eleve' WHEN prix_m2 IS NOT NULL THEN 'tres_eleve' END AS categorie_prix
  FROM sales
)"""

AREAS = """
geography AS (
  SELECT lpad(c_nationkey::varchar, 2, '0') || lpad((c_custkey % 1000)::varchar, 3, '0') AS code_commune,
         c_name AS nom_commune_insee, lpad(c_nationkey::varchar, 2, '0') AS departement,
         c_acctbal::decimal(18,2)::double AS latitude, (c_nationkey - 12)::double AS longitude
  FROM customer
)"""

ESTABLISHMENTS = """
establishments AS (
  SELECT c_custkey AS siret,
         lpad(c_nationkey::varchar, 2, '0') || lpad((c_custkey % 1000)::varchar, 3, '0') AS code_commune,
         lpad(c_nationkey::varchar, 2, '0') AS code_departement, c_nationkey AS nom_commune,
         substring(c_mktsegment, 1, 2) AS section_naf,
         CASE WHEN c_acctbal > 0 THEN 'A' ELSE 'F' END AS etat,
         CASE WHEN c_acctbal > 5000 THEN 'O' ELSE 'N' END AS est_employeur
  FROM customer
),
openings AS (
  SELECT o_orderkey AS siret,
         lpad(c_nationkey::varchar, 2, '0') || lpad((c_custkey % 1000)::varchar, 3, '0') AS code_commune,
         lpad(c_nationkey::varchar, 2, '0') AS code_departement,
         substring(c_mktsegment, 1, 2) AS section_naf, year(o_orderdate)::integer AS annee_creation
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def active(keys: str) -> str:
    return f"""SELECT {keys}, count(siret) AS nb_entreprises_actives,
      count(DISTINCT section_naf) AS diversite_sectorielle,
      count(*) FILTER (section_naf = 'BU') AS nb_entreprises_immobilier,
      count(*) FILTER (section_naf = 'AU') AS nb_entreprises_construction,
      count(*) FILTER (section_naf = 'MA') AS nb_entreprises_tech,
      count(*) FILTER (section_naf = 'HO') AS nb_entreprises_commerce
    FROM establishments WHERE etat = 'A' GROUP BY {keys}"""


def creations(keys: str) -> str:
    return f"""SELECT {keys}, annee_creation AS annee, count(siret) AS nb_creations_annee,
      count(*) FILTER (section_naf = 'MA') AS nb_creations_tech,
      count(*) FILTER (section_naf = 'AU') AS nb_creations_construction
    FROM openings WHERE annee_creation BETWEEN 1996 AND 2000 GROUP BY {keys}, annee_creation"""
