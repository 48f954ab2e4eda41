"""Establishment profiles by area and year."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: activity sections and the columns they are counted under
ACTIVE_SECTIONS = {
    "nb_entreprises_immobilier": "68",
    "nb_entreprises_construction": "41",
    "nb_entreprises_tech": "62",
    "nb_entreprises_commerce": "47",
}
CREATION_SECTIONS = {"nb_creations_tech": "62", "nb_creations_construction": "41"}
PROFILE_SECTIONS = {
    "nb_immobilier": "68", "nb_construction": "41", "nb_tech": "62",
    "nb_commerce": "47", "nb_energie": "35",
}


def section_counts(section: str, sections: Mapping[str, str]) -> list[Column]:
    return [F.count_if(F.col(section) == code).alias(name) for name, code in sections.items()]


def active_profile(
    df: DataFrame, keys: Sequence[str] = ("code_commune",), ident: str = "siret",
    section: str = "section_naf", status: str = "etat", active: str = "A",
    sections: Mapping[str, str] = ACTIVE_SECTIONS,
) -> DataFrame:
    """Active establishments, distinct sections and section counts per area.

    Folds to (area, section) first: an area holding much of the data is spread
    over its sections and reduced map-side, and the distinct count becomes a
    plain count of folded rows.
    """
    folded = (
        df.filter(F.col(status) == active)
        .groupBy(*keys, section)
        .agg(F.count(ident).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    )
    counts = [
        F.coalesce(F.sum(F.when(F.col(section) == code, F.col("_rows"))), F.lit(0)).alias(name)
        for name, code in sections.items()
    ]
    return folded.groupBy(*keys).agg(
        F.sum("_n").alias("nb_entreprises_actives"),
        F.count(section).alias("diversite_sectorielle"),
        *counts,
    )


def creations_by_year(
    df: DataFrame, keys: Sequence[str] = ("code_commune",), year: str = "annee_creation",
    ident: str = "siret", section: str = "section_naf", first: int = 2019, last: int = 2025,
    sections: Mapping[str, str] = CREATION_SECTIONS,
) -> DataFrame:
    """Creations per area and year, years ``first..last`` inclusive."""
    return (
        df.filter(F.col(year).between(first, last))
        .groupBy(*keys, F.col(year).alias("annee"))
        .agg(F.count(ident).alias("nb_creations_annee"), *section_counts(section, sections))
    )


def employer_profile(
    df: DataFrame, keys: Sequence[str] = ("code_commune", "nom_commune"), ident: str = "siret",
    section: str = "section_naf", status: str = "etat", active: str = "A",
    employer: str = "est_employeur", yes: str = "O",
    sections: Mapping[str, str] = PROFILE_SECTIONS,
) -> DataFrame:
    """Active profile per named area with the share of employers."""
    folded = (
        df.filter(F.col(status) == active)
        .groupBy(*keys, section)
        .agg(
            F.count(ident).alias("_n"), F.count(F.lit(1)).alias("_rows"),
            F.count_if(F.col(employer) == yes).alias("_employers"),
        )
    )
    counts = [
        F.coalesce(F.sum(F.when(F.col(section) == code, F.col("_rows"))), F.lit(0)).alias(name)
        for name, code in sections.items()
    ]
    share = F.try_divide(F.sum("_employers") * F.lit(100.0), F.sum("_n"))
    return folded.groupBy(*keys).agg(
        F.sum("_n").alias("nb_entreprises_actives"),
        F.count(section).alias("diversite_sectorielle"),
        *counts,
        F.round(share, 2).alias("pct_employeurs"),
    )


def breakdown(df: DataFrame, *keys: str, by_count: bool = True) -> DataFrame:
    """Rows per key, most frequent first (keys break ties) or in key order."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *keys) if by_count else counts.orderBy(*keys)
