"""Report queries over the enriched sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import half_up, or_zero


def _addend(c: str, exact: bool) -> Column:
    """Summand whose total does not depend on the order of addition."""
    return F.col(c).cast("decimal(18,2)") if exact else F.col(c)


def mean(c: str, exact: bool = False) -> Column:
    """Average; ``exact`` adds as decimals with two places."""
    if exact:
        return F.try_divide(F.sum(_addend(c, True)).cast("double"), F.count(c))
    return F.avg(c)


def global_summary(
    df: DataFrame, area: str = "code_commune", department: str = "code_departement",
    year: str = "annee", price: str = "prix_m2", kind: str = "type_local", exact: bool = False,
) -> DataFrame:
    """One row over the whole table.

    Rows are first folded map-side to (department, area, kind), so the three
    distinct counts run on the folded rows and the big scan is not expanded
    once per distinct count.
    """
    folded = df.groupBy(department, area, kind).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(price).alias("_priced"),
        F.sum(_addend(price, exact)).alias("_sum"),
        F.min(price).alias("_low"), F.max(price).alias("_high"),
        F.min(year).alias("_first"), F.max(year).alias("_last"),
    )
    average = F.try_divide(F.sum("_sum").cast("double"), F.sum("_priced"))
    return folded.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_transactions"),
        F.count_distinct(area).alias("nb_communes"),
        F.count_distinct(department).alias("nb_departements"),
        F.min("_first").alias("annee_debut"),
        F.max("_last").alias("annee_fin"),
        half_up(average, 0, exact).alias("prix_m2_moyen"),
        half_up(F.min("_low"), 0, exact).alias("prix_m2_min"),
        half_up(F.max("_high"), 0, exact).alias("prix_m2_max"),
        F.count_distinct(kind).alias("nb_types_biens"),
    )


def department_stats(
    df: DataFrame, department: str, key: str = "code_departement",
    value: str = "valeur_fonciere", price: str = "prix_m2", exact: bool = False,
) -> DataFrame:
    """Sales and averages of one department: always one row, zeros when empty.

    The key is a partition column of the warehouse, so only that department's
    files are read.
    """
    return df.filter(F.col(key) == department).agg(
        F.lit(department).alias("departement"),
        F.count(value).alias("nb_transactions"),
        or_zero(mean(price, exact), exact=exact).alias("prix_m2_moyen"),
        or_zero(mean(value, exact), exact=exact).alias("valeur_moyenne"),
    )


def top_groups(
    df: DataFrame, k: int = 10, key: str = "code_commune", name: str | None = "nom_commune",
    value: str = "prix_m2", exact: bool = False,
) -> DataFrame:
    """The ``k`` groups with the highest average, each under its commonest name.

    Rows without a key are in no group; a group without any name shows its key. Counts fold to (group, name) before
    the group itself, so one huge group is reduced map-side.
    """
    names = [name] if name else []
    folded = df.filter(F.col(key).isNotNull()).groupBy(key, *names).agg(
        F.count(F.lit(1)).alias("_n"), F.count(value).alias("_valued"),
        F.sum(_addend(value, exact)).alias("_sum"),
    )
    common = (
        F.min_by(F.col(name), F.when(F.col(name).isNotNull(), F.struct(-F.col("_n"), F.col(name))))
        if name else F.lit(None).cast("string")
    )
    average = F.try_divide(F.sum("_sum").cast("double"), F.sum("_valued"))
    return (
        folded.groupBy(key).agg(common.alias("_name"), average.alias("_mean"))
        .orderBy(F.desc_nulls_last("_mean"), key)
        .limit(k)
        .select(
            F.coalesce(F.col("_name"), F.col(key).cast("string")).alias("commune"),
            F.col(key).alias("code"),
            or_zero(F.col("_mean"), exact=exact).alias("prix_m2_moyen"),
        )
    )


# fixed values: the fields an anomaly report shows
ANOMALY_FIELDS = ("nom_commune", "valeur_fonciere", "surface_bati", "prix_m2", "type_local")


def anomalies(
    df: DataFrame, k: int = 100, flag: str = "qualite_donnee", bad: str = "SUSPECTE",
    fields: Sequence[str] = ANOMALY_FIELDS, order: Sequence[str] | None = None,
) -> DataFrame:
    """Up to ``k`` suspect rows, always the same ones: the first in ``order``."""
    chosen = df.filter(F.col(flag) == bad).orderBy(*(order or fields)).limit(k)
    return chosen.select(*fields)


def evolution(
    df: DataFrame, department: str, key: str = "code_departement", year: str = "annee",
    price: str = "prix_m2", buckets: int | None = None, exact: bool = False,
) -> DataFrame:
    """Average price per year of one department; ``buckets`` may keep the first years only."""
    years = (
        df.filter((F.col(key) == department) & F.col(year).isNotNull())
        .groupBy(year)
        .agg(or_zero(mean(price, exact), exact=exact).alias("prix_m2_moyen"))
        .orderBy(year)
    )
    return years if buckets is None else years.limit(buckets)


def group_stats(
    df: DataFrame, key: str, measures: dict[str, str], exact: bool = False
) -> DataFrame:
    """Count and averages per group; the first average orders the rows."""
    averages = {alias: mean(column, exact) for alias, column in measures.items()}
    first = next(iter(averages))
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), *[c.alias(a) for a, c in averages.items()])
        .orderBy(F.desc_nulls_last(first), key)
    )


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int = 10) -> DataFrame:
    """Top ``n`` by several keys, without a full sort."""
    return df.orderBy(*order).limit(n)
