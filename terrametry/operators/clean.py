"""Projection, typing and filtering of raw records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    compose_code, date_from_text, number_from_text, prefix, unit_price, whole_from_text,
)
from ..schemas import ESTABLISHMENT_HEADINGS, GEOGRAPHY_HEADINGS, TRANSACTION_HEADINGS


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename in one step: output name to source name or expression."""
    return df.select(*[
        (F.col(f"`{source}`") if isinstance(source, str) else source).alias(name)
        for name, source in columns.items()
    ])


def rename(df: DataFrame, names: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed(dict(names)).drop(*drop)


def strictly_between(c: str | Column, low: float, high: float) -> Column:
    """Open interval: both bounds are themselves outliers."""
    value = F.col(c) if isinstance(c, str) else c
    return (value > low) & (value < high)


def has_length(c: str, length: int) -> Column:
    return F.length(c) == length


@dataclass(frozen=True)
class SaleRules:
    """What makes a sale valid. Defaults are the reference's fixed values."""

    kinds: tuple[str, ...] = ("Maison", "Appartement")
    natures: tuple[str, ...] = ("Vente", "Vente en l'état futur d'achèvement")
    value: tuple[float, float] = (1000, 50_000_000)
    surface: tuple[float, float] = (5, 2000)
    price: tuple[float, float] = (100, 50_000)
    headings: Mapping[str, str] = field(default_factory=lambda: dict(TRANSACTION_HEADINGS))


def type_transactions(
    raw: DataFrame, rules: SaleRules = SaleRules(), code_mode: str = "reference"
) -> DataFrame:
    """Raw text sales as typed columns, unfiltered."""
    raw_column = {role: F.col(f"`{heading}`") for role, heading in rules.headings.items()}
    day = date_from_text(raw_column["date"], "dd/MM/yyyy")
    return project(raw, {
        "id_disposition": raw_column["id_disposition"],
        "nature_mutation": raw_column["nature_mutation"],
        "date_mutation": day,
        "annee": F.year(day),
        "mois": F.month(day),
        "valeur_fonciere": number_from_text(raw_column["value"], ","),
        "code_departement": raw_column["department"],
        "code_commune": compose_code(raw_column["department"], raw_column["commune"], code_mode),
        "nom_commune": raw_column["nom_commune"],
        "code_postal": raw_column["code_postal"],
        "type_local": raw_column["type_local"],
        "surface_bati": number_from_text(raw_column["surface"]),
        "nb_pieces": whole_from_text(raw_column["rooms"]),
        "surface_terrain": number_from_text(raw_column["land"]),
    })


def keep_valid_sales(
    typed: DataFrame, rules: SaleRules = SaleRules(), exact: bool = False
) -> DataFrame:
    """Valid kinds, natures and bounds; then the unit price and its own bounds."""
    valid = (
        F.col("type_local").isin(*rules.kinds)
        & F.col("nature_mutation").isin(*rules.natures)
        & strictly_between("valeur_fonciere", *rules.value)
        & strictly_between("surface_bati", *rules.surface)
        & F.col("annee").isNotNull()
        & F.col("code_commune").isNotNull()
    )
    priced = typed.filter(valid).withColumn(
        "prix_m2", unit_price("valeur_fonciere", "surface_bati", exact=exact)
    )
    return priced.filter(strictly_between("prix_m2", *rules.price))


def clean_transactions(
    raw: DataFrame, rules: SaleRules = SaleRules(), code_mode: str = "reference",
    exact: bool = False,
) -> DataFrame:
    return keep_valid_sales(type_transactions(raw, rules, code_mode), rules, exact)


def clean_geography(
    raw: DataFrame, headings: Mapping[str, str] = GEOGRAPHY_HEADINGS, code_length: int = 5
) -> DataFrame:
    """Areas with typed coordinates; codes of the wrong length are dropped."""
    columns = {name: F.col(f"`{heading}`") for name, heading in headings.items()}
    for name in ("latitude", "longitude"):
        columns[name] = number_from_text(columns[name])
    return project(raw, columns).filter(has_length("code_commune", code_length))


def clean_establishments(
    raw: DataFrame, headings: Mapping[str, str] = ESTABLISHMENT_HEADINGS,
    code_length: int = 5, section_length: int = 2,
) -> DataFrame:
    """Establishments with creation year and activity section."""
    columns = {name: F.col(f"`{heading}`") for name, heading in headings.items()}
    created = date_from_text(columns["date_creation"])
    columns |= {
        "section_naf": prefix(columns["code_naf"], section_length),
        "date_creation": created,
        "annee_creation": F.year(created),
    }
    return project(raw, columns).filter(has_length("code_commune", code_length))


def retention(df: DataFrame, kept: Column) -> DataFrame:
    """Rows, rows kept and their share, in one pass."""
    kept_rows = F.count_if(kept)
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        kept_rows.alias("n_kept"),
        F.try_divide(kept_rows * 100, F.count(F.lit(1))).alias("kept_pct"),
    )
