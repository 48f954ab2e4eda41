"""Partitioned Parquet tables, their catalog entries and write checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..schemas import TableSpec
from ..sources import read_parquet


SLOTS = 16


def _fingerprint(df: DataFrame, keys: Sequence[str], slots: int = SLOTS) -> list[Column]:
    """Order-independent sums of 64-bit row hashes, one for each slot of partitions.

    A row's hash covers all columns by name, so a value that moves to another row or
    partition changes the sums; the slot tells among which partitions.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(20,0)")
    slot = F.pmod(F.xxhash64(*keys), F.lit(slots)) if keys else F.lit(0)
    return [F.coalesce(F.sum(F.when(slot == k, row)), F.lit(0).cast("decimal(30,0)")).cast("string").alias(f"hash_{k}")
            for k in range(slots)]


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str] = (), mode: str = "overwrite",
    rows_per_file: int = 5_000_000, only_touched: bool = False, fingerprint: bool = False, rebalance: bool = True,
) -> Observation:
    """Write Parquet by partition folder; returns the row count observed.

    With ``fingerprint`` the same pass observes the sums of row hashes that
    :func:`verify_write` compares with those of what is read back.

    Rows are rebalanced on the partition columns, so small partitions share a
    task and write few files, while a partition holding much of the data is
    split over many tasks. Rows read from files already laid out by ``keys`` need no
    ``rebalance``: each task writes what it read, without a shuffle. ``only_touched`` replaces just the partitions that
    occur in ``df``; otherwise the whole data set is replaced.
    """
    written = Observation()
    sums = _fingerprint(df, keys) if fingerprint else []
    # counted behind the shuffle: what is observed before it is lost when there are no rows
    dealt = df.hint("rebalance", *keys) if keys and rebalance else df
    counted = dealt.observe(written, F.count(F.lit(1)).alias("rows"), *sums)
    writer = counted.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option(
        "partitionOverwriteMode", "dynamic" if only_touched else "static"
    )
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    return written


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    placed = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{placed}")


def register_table(spark: SparkSession, table: TableSpec, replace: bool = True) -> DataFrame:
    """Catalog entry over files already written, with all partitions found."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table.qualified}")
    spark.sql(table.ddl(if_absent=not replace))
    if table.keys:
        recover_partitions(spark, table.qualified)
    return spark.table(table.qualified)


def recover_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`")


def partition_inventory(
    df: DataFrame, keys: Sequence[str], first: int | None = None
) -> DataFrame:
    """Distinct partition values in order; ``first`` keeps a preview."""
    found = df.select(*keys).distinct().orderBy(*keys)
    return found.limit(first) if first is not None else found


def verify_write(
    spark: SparkSession, path: str, expected: int | Mapping[str, object], schema=None, keys: Sequence[str] = (),
) -> DataFrame:
    """One row: rows expected, rows read back, whether they agree.

    ``expected`` is a count, or all that :func:`write_partitioned` observed with
    ``fingerprint``: then the row hashes must agree too, in every slot of partitions.
    """
    seen = read_parquet(spark, path, schema)
    wanted = {"rows": expected} if isinstance(expected, int) else dict(expected)
    sums = _fingerprint(seen, keys) if len(wanted) > 1 else []
    read = seen.agg(F.count(F.lit(1)).alias("n_read"), *sums)
    alike = F.col("n_read") == F.lit(wanted["rows"])
    for name in (c for c in wanted if c != "rows"):
        alike &= F.col(name) == F.lit(wanted[name])
    return read.select(F.lit(wanted["rows"]).cast("bigint").alias("n_expected"), "n_read", alike.alias("complete"))


def differing_slots(spark: SparkSession, path: str, expected: Mapping[str, object], schema=None, keys: Sequence[str] = ()) -> DataFrame:
    """Partitions ``keys`` of a table whose slot's row hashes are not those observed on the write."""
    seen = read_parquet(spark, path, schema)
    sums = seen.agg(F.array(*_fingerprint(seen, keys)).alias("sums"))
    bad = [k for k, found in enumerate(sums.first()["sums"]) if found != expected[f"hash_{k}"]]  # a number for each slot
    return seen.select(*keys).distinct().filter(F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).isin(bad))


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None,
) -> DataFrame:
    """Catalog table dealt into ``buckets`` by its keys and sorted by them.

    Tables of equally many buckets by the same keys join without a shuffle of either.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


@contextmanager
def reused(df: DataFrame):
    """Persist for several uses, released at the end."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()
