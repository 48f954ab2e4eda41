"""Typed document collections."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from ..functions import geo_struct
from ..schemas import SALE_DOCUMENT, document_mapping
from ..session import stage
from .enrich import split_on_null

FILE_FORMATS = ("json", "parquet", "orc")


def _conformed(df: DataFrame, field) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    return F.col(f"`{field.name}`").try_cast(field.dataType)


def conform(df: DataFrame, mapping: StructType) -> DataFrame:
    """Exactly the mapped fields and types; missing or unfit values are NULL."""
    return df.select(*[_conformed(df, f).alias(f.name) for f in mapping.fields])


def _losses(df: DataFrame, mapping: StructType) -> dict[str, Column]:
    """For each mapped field, how many of its values the type does not hold."""
    return {
        f.name: F.count_if(F.col(f"`{f.name}`").isNotNull() & _conformed(df, f).isNull())
        for f in mapping.fields if f.name in df.columns
    }


def _statuses(df: DataFrame, mapping: StructType) -> dict[str, str]:
    mapped = {f.name: "mapped" if f.name in df.columns else "missing" for f in mapping.fields}
    return mapped | {c: "unmapped" for c in df.columns if c not in mapped}


def conformance(df: DataFrame, mapping: StructType) -> DataFrame:
    """One row per field: mapped, missing or unmapped, and values lost to typing."""
    lost = _losses(df, mapping)
    rows = [
        F.struct(
            F.lit(name).alias("field"), F.lit(status).alias("status"),
            lost.get(name, F.lit(0).cast("bigint")).alias("n_lost"),
        )
        for name, status in _statuses(df, mapping).items()
    ]
    return df.agg(F.array(*rows).alias("fields")).select(F.inline("fields"))


def sale_documents(enriched: DataFrame) -> DataFrame:
    """The fields a sale is searched by, with its location as one point."""
    fields = [name for name in SALE_DOCUMENT.names if name != "location"]
    return enriched.select(*fields, geo_struct("latitude", "longitude").alias("location"))


def union_documents(with_field: DataFrame, without_field: DataFrame) -> DataFrame:
    """Both halves of a split as one collection again."""
    return with_field.unionByName(without_field, allowMissingColumns=True)


def write_documents(
    df: DataFrame, path: str, mode: str = "overwrite", format: str = "json",
    batch_rows: int = 1000, batch_bytes: str = "5mb", **options: str,
) -> None:
    """Write documents as JSON files, or through a connector named by ``format``.

    ``overwrite`` makes a rerun replace rather than duplicate; ``ignore``
    creates the collection only if it is absent. The batch sizes reach a
    connector as its bulk limits.
    """
    writer = df.write.format(format).mode(mode)
    if format in FILE_FORMATS:
        writer.options(**{"ignoreNullFields": "true", **options}).save(path)
        return
    writer.options(**{
        f"{format}.resource": path,
        f"{format}.batch.size.entries": str(batch_rows),
        f"{format}.batch.size.bytes": batch_bytes,
        **options,
    }).save()


def replace_collection(
    df: DataFrame, path: str, mapping: StructType, format: str = "json", **how
) -> DataFrame:
    """Drop and recreate a collection under its mapping; returns what was mapped,
    missing or lost, as :func:`conformance` does.

    Losses are counted in the pass that writes: the input is computed once. Files
    get the mapping as JSON beside the data, in a file that readers of the
    collection pass over; a connector gets it as an option.
    """
    seen, lost = Observation(), _losses(df, mapping)
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(f"lost_{name}") for name, c in lost.items()])
    described = json.dumps(document_mapping(mapping))
    if format not in FILE_FORMATS:
        how = {f"{format}.mapping": described, **how}
    write_documents(conform(watched, mapping), path, mode="overwrite", format=format, **how)
    if format in FILE_FORMATS:
        df.sparkSession.range(1).select(F.lit(described)).coalesce(1).write.mode("overwrite").text(f"{path}/_mapping")
    counts = seen.get
    rows = [(name, status, counts.get(f"lost_{name}", 0)) for name, status in _statuses(df, mapping).items()]
    return df.sparkSession.createDataFrame(rows, "field string, status string, n_lost bigint")


def write_split_documents(
    df: DataFrame, path: str, field: str = "location", format: str = "json", **how
) -> None:
    """Index rows with and without ``field`` into one collection.

    JSON files leave NULL fields out, so one pass writes both halves. A
    connector gets two appends, read from a staged copy computed once.
    """
    if format == "json":
        write_documents(df, path, format=format, **how)
        return
    for half in split_on_null(stage(df, "documents"), field):
        write_documents(half, path, mode="append", format=format, **how)
