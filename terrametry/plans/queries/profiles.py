"""Establishment profiles by area and year."""

from pyspark.sql import functions as F

from ...operators.profiles import active_profile, breakdown, creations_by_year, employer_profile
from .. import roles
from . import Registry
from .sqltext import ESTABLISHMENTS, active as active_sql, creations

registry = Registry()
query = registry.add


@query(f"WITH {ESTABLISHMENTS} {active_sql('code_commune')}", name="active_profile")
def active_profile_by_area(spark, sf_dir):
    return active_profile(roles.establishments(spark, sf_dir), sections=roles.SECTIONS)


@query(f"WITH {ESTABLISHMENTS} {creations('code_commune')}", name="creations_by_year")
def creations_by_area_and_year(spark, sf_dir):
    first, last = roles.YEARS
    return creations_by_year(
        roles.openings(spark, sf_dir), first=first, last=last, sections=roles.OPENING_SECTIONS
    )


@query(f"""WITH {ESTABLISHMENTS}
SELECT code_departement, nom_commune, count(siret) AS nb_entreprises_actives,
       count(DISTINCT section_naf) AS diversite_sectorielle,
       count(*) FILTER (section_naf = 'BU') AS nb_immobilier,
       count(*) FILTER (section_naf = 'AU') AS nb_construction,
       count(*) FILTER (section_naf = 'MA') AS nb_tech,
       count(*) FILTER (section_naf = 'HO') AS nb_commerce,
       count(*) FILTER (section_naf = 'FU') AS nb_energie,
       round(count(*) FILTER (est_employeur = 'O') * 100.0::double / count(siret), 2) AS pct_employeurs
FROM establishments WHERE etat = 'A' GROUP BY ALL""", name="commune_profile_employers")
def employer_profile_by_area(spark, sf_dir):
    return employer_profile(
        roles.establishments(spark, sf_dir), ["code_departement", "nom_commune"],
        sections={"nb_immobilier": "BU", "nb_construction": "AU", "nb_tech": "MA",
                  "nb_commerce": "HO", "nb_energie": "FU"},
    )


@query(f"WITH {ESTABLISHMENTS} SELECT etat, count(*) AS n FROM establishments GROUP BY 1")
def status_breakdown(spark, sf_dir):
    return breakdown(roles.establishments(spark, sf_dir), "etat")


@query("SELECT year(o_orderdate)::integer AS annee, count(*) AS n FROM orders GROUP BY 1")
def count_by_year(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("annee"))
    return breakdown(orders, "annee", by_count=False)
