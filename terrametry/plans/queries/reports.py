"""Report queries over the sales."""

from pyspark.sql import functions as F

from ...operators.enrich import label_sales
from ...operators.profiles import breakdown
from ...operators.reports import (
    anomalies, department_stats, evolution, first_rows, global_summary, group_stats, top_groups,
)
from .. import roles
from . import Registry
from .sqltext import ESTABLISHMENTS, LABELLED, SALES, exact_mean, rounded

registry = Registry()
query = registry.add


@query(f"""WITH {SALES}
SELECT count(*) AS total_transactions, count(DISTINCT code_commune) AS nb_communes,
       count(DISTINCT code_departement) AS nb_departements, min(annee) AS annee_debut,
       max(annee) AS annee_fin, {rounded(exact_mean('prix_m2'), 0)} AS prix_m2_moyen,
       {rounded('min(prix_m2)', 0)} AS prix_m2_min, {rounded('max(prix_m2)', 0)} AS prix_m2_max,
       count(DISTINCT type_local) AS nb_types_biens
FROM sales""", name="global_summary")
def global_summary_all(spark, sf_dir):
    return global_summary(roles.sales(spark, sf_dir), exact=True)


@query(f"""WITH {SALES}
SELECT '05' AS departement, count(valeur_fonciere) AS nb_transactions,
       {rounded(f"coalesce({exact_mean('prix_m2')}, 0)")} AS prix_m2_moyen,
       {rounded(f"coalesce({exact_mean('valeur_fonciere')}, 0)")} AS valeur_moyenne
FROM sales WHERE code_departement = '05'""", name="department_stats")
def department_statistics(spark, sf_dir):
    return department_stats(roles.sales(spark, sf_dir), "05", exact=True)


@query(f"""WITH {SALES}, named AS (
  SELECT code_commune, nom_commune, count(*) AS n FROM sales GROUP BY ALL),
common AS (
  SELECT code_commune, nom_commune FROM (
    SELECT *, row_number() OVER (PARTITION BY code_commune ORDER BY n DESC, nom_commune) AS rn FROM named)
  WHERE rn = 1),
means AS (SELECT code_commune, {exact_mean('prix_m2')} AS m FROM sales GROUP BY 1)
SELECT coalesce(nom_commune, code_commune) AS commune, code_commune AS code,
       {rounded('coalesce(m, 0)')} AS prix_m2_moyen
FROM means JOIN common USING (code_commune) ORDER BY m DESC, code_commune LIMIT 10""")
def top_communes(spark, sf_dir):
    return top_groups(roles.sales(spark, sf_dir), 10, exact=True)


@query(f"""WITH {LABELLED}
SELECT nom_commune, valeur_fonciere, surface_bati, prix_m2, type_local FROM labelled
WHERE qualite_donnee = 'SUSPECTE'
ORDER BY nom_commune, valeur_fonciere, surface_bati, prix_m2, type_local LIMIT 100""", name="anomalies")
def suspect_sales(spark, sf_dir):
    return anomalies(label_sales(roles.sales(spark, sf_dir)), 100)


@query(f"""WITH {SALES}
SELECT annee, {rounded(f"coalesce({exact_mean('prix_m2')}, 0)")} AS prix_m2_moyen
FROM sales WHERE code_departement = '07' GROUP BY annee ORDER BY annee""")
def price_evolution(spark, sf_dir):
    return evolution(roles.sales(spark, sf_dir), "07", exact=True)


@query(f"""
SELECT c_mktsegment, count(*) AS n, {exact_mean('c_acctbal')} AS avg_balance,
       {exact_mean('c_nationkey')} AS avg_nation
FROM customer GROUP BY 1""")
def group_avg_sorted(spark, sf_dir):
    return group_stats(
        roles.table(spark, sf_dir, "customer"), "c_mktsegment",
        {"avg_balance": "c_acctbal", "avg_nation": "c_nationkey"}, exact=True,
    )


@query(f"""WITH {ESTABLISHMENTS}
SELECT code_commune, count(*) AS n FROM openings GROUP BY 1 ORDER BY n DESC, code_commune LIMIT 10""")
def top10_desc(spark, sf_dir):
    return first_rows(
        breakdown(roles.openings(spark, sf_dir), "code_commune"), [F.desc("n"), "code_commune"]
    )


@query(f"""WITH {SALES}
SELECT DISTINCT code_departement, annee FROM sales ORDER BY code_departement, annee LIMIT 10""")
def top10_multikey(spark, sf_dir):
    found = roles.sales(spark, sf_dir).select("code_departement", "annee").distinct()
    return first_rows(found, ["code_departement", "annee"])
