"""The batch job: raw files to an enriched, registered, indexed warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import (
    SaleRules, clean_establishments, clean_geography, clean_transactions,
)
from ..operators.documents import sale_documents, write_split_documents
from ..operators.enrich import (
    enrich_left, label_sales, one_row_per_key, quality_totals, with_creation_rate,
)
from ..operators.profiles import active_profile, creations_by_year
from ..operators.reports import global_summary
from ..operators.warehouse import (
    create_database, register_table, verify_write, write_partitioned,
)
from ..schemas import ENRICHED, ENRICHED_V2, PARTITION_KEYS, TableSpec
from ..session import stage
from ..sources import read_delimited, read_multiline, read_parquet, stage_delimited


@dataclass(frozen=True)
class TerritoryPaths:
    transactions: str
    geography: str
    establishments: str
    warehouse: str
    documents: str | None = None
    database: str = "territory"
    table: str = "enriched_sales"


def enrich_sales(
    sales: DataFrame, geography: DataFrame, profile: DataFrame, creations: DataFrame,
    dedupe_geography: bool = False, exact: bool = False,
) -> DataFrame:
    """Clean sales with geography, active profile and creations of their year.

    The dimensions are computed once into staged tables. Their true sizes are
    then known when the joins are planned: small ones are broadcast and the
    sales are not shuffled for them at all; larger ones are joined by shuffle.
    """
    if dedupe_geography:
        geography = one_row_per_key(geography, ["code_commune"])
    return with_creation_rate(enrich_left(sales, [
        (stage(geography, "geography"), ["code_commune"]),
        (stage(profile, "profile"), ["code_commune"]),
        (stage(creations, "creations"), ["code_commune", "annee"]),
    ]), exact)


def build_warehouse(
    spark: SparkSession, paths: TerritoryPaths, rules: SaleRules = SaleRules(),
    code_mode: str = "reference", dedupe_geography: bool = False, exact: bool = False,
) -> DataFrame:
    """Clean, profile, join, write, register and index; returns the summary.

    Each raw file is parsed once: establishments are multi-line text, read by
    many tasks, and their few wanted columns are staged as Parquet before the
    two aggregates read them. The joined dimensions are staged too; their true
    sizes then decide how the joins run. ``dedupe_geography`` keeps one row of each
    area, so that repeated areas do not multiply sales.
    """
    sales = clean_transactions(
        read_delimited(spark, paths.transactions, sep="|", encoding="latin1"), rules, code_mode, exact
    )
    geography = clean_geography(read_delimited(spark, paths.geography))
    establishments = stage_delimited(
        clean_establishments(
            read_multiline(spark, paths.establishments)
        ),
        ["siret", "code_commune", "section_naf", "etat", "annee_creation"],
    )
    enriched = enrich_sales(
        sales, geography, active_profile(establishments), creations_by_year(establishments),
        dedupe_geography, exact,
    )
    written = write_partitioned(enriched.select(*ENRICHED.names), paths.warehouse, PARTITION_KEYS, fingerprint=True)
    audit = verify_write(spark, paths.warehouse, written.get, ENRICHED, PARTITION_KEYS)
    if not audit.first()["complete"]:
        raise RuntimeError(f"{paths.warehouse}: rows written and rows readable differ")
    create_database(spark, paths.database)
    table = register_table(
        spark, TableSpec(paths.database, paths.table, ENRICHED, PARTITION_KEYS, paths.warehouse)
    )
    if paths.documents:
        write_split_documents(sale_documents(table), paths.documents)
    return global_summary(table)


def build_labelled(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Second warehouse with quality, band and zone labels; returns the totals.

    The source is laid out by the same keys, so its rows are labelled and written where they are
    read. The totals come from the written files' flag column alone.
    """
    labelled = label_sales(read_parquet(spark, source, ENRICHED))
    write_partitioned(labelled.select(*ENRICHED_V2.names), target, PARTITION_KEYS, rebalance=False)
    return quality_totals(read_parquet(spark, target, ENRICHED_V2))
