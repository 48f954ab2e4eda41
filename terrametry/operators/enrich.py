"""Joining dimensions to facts and labelling the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import band, guarded_rate, quality_flag, zone
from ..session import stage

# fixed values: price bands and zones of the reference
PRICE_BANDS = ((1500, "bas"), (3500, "moyen"), (7000, "eleve"))
TOP_BAND = "tres_eleve"
ZONES = {
    "Paris": ("75",),
    "Petite_couronne": ("92", "93", "94"),
    "Grande_couronne": ("77", "78", "91", "95"),
}
PLAUSIBLE_PRICE = (500, 30_000)


def one_row_per_key(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dimension with one row per key, so that a left join cannot fan out.

    Keeps the row smallest in its remaining columns, which is the same row on
    every run.
    """
    rest = [c for c in dim.columns if c not in keys]
    folded = dim.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return folded.select(*keys, "_row.*")


def enrich_left(
    facts: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], dedupe: bool = False
) -> DataFrame:
    """Facts with each dimension left-joined on its own keys.

    No hint is set: the planner broadcasts a dimension whose size, known from
    files or measured at run time, is under the session's threshold, and
    otherwise shuffles with skewed fact partitions split.
    """
    for dim, keys in dims:
        facts = facts.join(
            one_row_per_key(dim, keys) if dedupe else dim, on=list(keys), how="left"
        )
    return facts


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float = 0.02) -> DataFrame:
    """Keys holding more than ``share`` of all rows: at most ``1 / share`` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") > total * share).select(*keys)


def salted_left(
    facts: DataFrame, dim: DataFrame, keys: Sequence[str], salts: int = 32,
    share: float = 0.02, spread_on: Sequence[str] | None = None,
) -> DataFrame:
    """Left join that splits frequent keys, for a dimension too big to broadcast.

    Rows of a frequent key, and rows whose key is NULL, are spread over
    ``salts`` groups by a hash of ``spread_on`` (default: the whole row); the
    matching dimension rows are repeated once per group. All other keys keep
    one group. The result equals the plain left join.
    """
    keys = list(keys)
    # at most 1/share rows by construction, hence safe to broadcast; staged so
    # that the keys are counted once for both sides
    frequent = stage(frequent_keys(facts, keys, share), "frequent-keys")
    frequent = F.broadcast(frequent.withColumn("_hot", F.lit(True)))
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    group = F.pmod(F.xxhash64(*(spread_on or facts.columns)), F.lit(salts)).cast("int")
    salted = (
        facts.join(frequent, keys, "left")
        .withColumn("_salt", F.when(F.col("_hot") | no_key, group).otherwise(F.lit(0)))
        .drop("_hot")
    )
    groups = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
    repeated = (
        dim.join(frequent, keys, "left")
        .withColumn("_salt", F.explode(groups.otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return salted.join(repeated, [*keys, "_salt"], "left").drop("_salt")


def with_creation_rate(df: DataFrame, exact: bool = False) -> DataFrame:
    """Creations of the year per 100 active establishments."""
    return df.withColumn(
        "taux_creation_entreprises",
        guarded_rate("nb_creations_annee", "nb_entreprises_actives", exact=exact),
    )


def suspicion_rules(
    value: str = "valeur_fonciere", surface: str = "surface_bati", price: str = "prix_m2",
    kind: str = "type_local", plausible: tuple[float, float] = PLAUSIBLE_PRICE,
) -> list[Column]:
    low, high = plausible
    return [
        F.col(value) <= 0, F.col(surface) <= 0, F.col(price) < low, F.col(price) > high,
        F.col(kind).isNull(),
    ]


def label_sales(
    df: DataFrame, bands: Sequence[tuple[float, str]] = PRICE_BANDS, above: str = TOP_BAND,
    zones: Mapping[str, Sequence[str]] = ZONES,
) -> DataFrame:
    """Quality flag, price band and zone of each sale."""
    return df.withColumns({
        "qualite_donnee": quality_flag(suspicion_rules()),
        "categorie_prix": band("prix_m2", bands, above),
        "zone_idf": zone("code_departement", zones),
    })


def quality_totals(df: DataFrame, flag: str = "qualite_donnee") -> DataFrame:
    """All, good and suspect rows from one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col(flag) == "OK").alias("n_ok"),
        F.count_if(F.col(flag) == "SUSPECTE").alias("n_suspect"),
    )


def split_on_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows that have the column, and rows that lack it (column dropped)."""
    return df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull()).drop(column)
