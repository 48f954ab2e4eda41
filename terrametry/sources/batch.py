"""Batch scans and table profiles."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import stage


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | None = None,
    sep: str = ",",
    encoding: str = "utf-8",
    multiline: bool = False,
    header: bool = True,
    escape: str = "\\",
) -> DataFrame:
    """Delimited text as strings; a folder or list of files is one relation.

    Without ``schema`` the names come from the header and every column is a
    string. A given schema is matched against the header, not just applied by
    position. ``multiline`` keeps line breaks inside quotes, at the price of one
    task per file: :func:`read_multiline` reads one file in many tasks.
    """
    names = {"latin1": "iso-8859-1", "latin-1": "iso-8859-1"}
    reader = spark.read.options(
        sep=sep, header=header, encoding=names.get(encoding.lower(), encoding),
        multiLine=multiline, quote='"', escape=escape, inferSchema=False,
    )
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not header)
    return reader.csv(path if isinstance(path, str) else list(path))


def _inside(quotes: Column) -> Column:
    """Whether so many quotes leave a quoted value open."""
    return F.pmod(quotes, F.lit(2)) == 1


def _quoted_lines(spark: SparkSession, path: str | Sequence[str], encoding: str, escape: str) -> DataFrame:
    """Lines by file and block, with the quotes before and in each since its block began."""
    text = spark.read.options(lineSep="\n", encoding=encoding).text(path if isinstance(path, str) else list(path))
    value = F.col("value")
    plain = value if escape == '"' else F.regexp_replace(value, r"\\.", "")
    lines = text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))).alias("quotes"))
    so_far = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("after", F.sum("quotes").over(so_far)).withColumn("before", F.col("after") - F.col("quotes"))


def read_multiline(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, sep: str = ",",
    encoding: str = "utf-8", header: bool = True, escape: str = '"', null_value: str = "",
) -> DataFrame:
    """Delimited text whose quoted values hold line breaks, one file read by many tasks.

    A line begins inside a quoted value if an odd number of quotes precede it in its
    file. Quotes are counted per line and per file block; a running sum over a file's blocks, one
    row each, tells how each block begins. Lines that are whole records are parsed where they are; only
    the pieces of longer records are brought together.

    Quotes must stand around values alone, doubled or escaped inside, as every writer
    of such text puts them. Line breaks inside values stay as they are, and a carriage return
    before the break that ends a record is dropped. ``null_value`` reads as NULL; with another
    one than the default an empty value is the empty string. Names come from the
    header, or a given schema's if there is none; a schema's columns are
    found by name in the header. Records that do not parse give NULLs; empty lines are no records.
    """
    first = path if isinstance(path, str) else list(path)
    named = spark.read.options(sep=sep, header=header, encoding=encoding, quote='"', escape=escape, inferSchema=False).csv(first).columns
    names = named if header or schema is None else schema.names
    fields = StructType([StructField(n, StringType() if schema is None or n not in schema.names else schema[n].dataType) for n in names])
    lines = _quoted_lines(spark, path, encoding, escape)
    home = ("file", "block")
    starts = lambda open_: F.count_if(_inside(F.col("before")) == F.lit(open_)).alias(f"starts_{int(open_)}")
    blocks = lines.groupBy(*home).agg(F.sum("quotes").alias("quotes"), starts(False), starts(True))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("open", F.coalesce(_inside(F.sum("quotes").over(earlier)), F.lit(False))).withColumn(
        "starts", F.when(F.col("open"), F.col("starts_1")).otherwise(F.col("starts_0")))
    begun = F.when(F.col("starts") > 0, F.struct(F.col("block").alias("home"), F.col("starts").alias("number")))
    blocks = blocks.select(*home, "open", F.last(begun, True).over(earlier).alias("begun"))
    opened = F.col("open").cast("int")
    placed = lines.join(blocks, list(home)).withColumns({
        "starts": ~_inside(F.col("before") + opened), "ends": ~_inside(F.col("after") + opened)})
    in_block = Window.partitionBy(*home).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("number", F.count_if("starts").over(in_block)).select(
        "file", "block", "line", "value", (F.col("starts") & F.col("ends")).alias("whole"),
        F.when(F.col("number") > 0, F.struct(F.col("block").alias("home"), "number")).otherwise(F.col("begun")).alias("record"))
    whole = placed.filter("whole").select("record", "value")
    pieces = placed.filter(~F.col("whole")).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
    records = whole.unionByName(pieces.select("record", F.array_join(F.col("lines.value"), "\n").alias("value")))
    if header:
        records = records.filter((F.col("record.home") > 0) | (F.col("record.number") > 1))
    options = {"sep": sep, "quote": '"', "escape": escape, "multiLine": "true", "lineSep": "\n", "nullValue": null_value,
               "emptyValue": "", "mode": "PERMISSIVE"}
    ended = F.regexp_replace("value", r"\r\z", "")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parsed = records.filter(ended != "").select(F.from_csv(ended, columns, options).alias("r"))
    return parsed.select("r.*").select(*(schema.names if schema is not None else names))


def stage_delimited(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Parse text once into splittable columnar files for all later scans."""
    return stage(df.select(*columns) if columns else df, "delimited")


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """Parquet files or a partitioned folder.

    Give the schema of a partitioned folder: inferred partition types would
    turn the code ``'01'`` into the number 1.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_table(spark: SparkSession, name_or_query: str) -> DataFrame:
    """A catalog table by name, or any SQL over catalog tables."""
    if len(name_or_query.split()) > 1:
        return spark.sql(name_or_query)
    return spark.table(name_or_query)


def read_documents(
    spark: SparkSession, path: str, schema: StructType, format: str = "json", **options: str
) -> DataFrame:
    """Documents under their declared schema; other formats by connector name."""
    return spark.read.format(format).schema(schema).options(**options).load(path)


def read_daily_logs(
    spark: SparkSession, path: str, schema: StructType, first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Logs stored by ``day``, of the days ``first..last`` only (ISO dates). The
    bounds prune partitions: other days are not read."""
    logs = spark.read.schema(schema).parquet(path)
    if first:
        logs = logs.filter(F.col("day") >= F.lit(first).cast("date"))
    if last:
        logs = logs.filter(F.col("day") <= F.lit(last).cast("date"))
    return logs


def local_rows(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    return df.limit(n)


def profile_schema(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values.

    Default is one scan with sketch counts. ``exact`` unpivots to (column, text
    value) and counts each value once, so a column of one frequent value is
    folded map-side and no task sees a whole column.
    """
    names = df.columns
    types = F.create_map(*[F.lit(part) for pair in df.dtypes for part in pair])
    if exact:
        cells = df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names]).unpivot(
            [], names, "column_name", "cell"
        )
        return (
            cells.groupBy("column_name", "cell").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("column_name").agg(
                F.sum("n").alias("n_rows"),
                F.coalesce(F.sum(F.when(F.col("cell").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
                F.count("cell").alias("n_distinct"),
            )
            .select("column_name", types[F.col("column_name")].alias("data_type"),
                    "n_rows", "n_nulls", "n_distinct")
        )
    one_row = df.agg(F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(f"`{name}`").isNull()).alias("n_nulls"),
            F.approx_count_distinct(f"`{name}`").alias("n_distinct"),
        )
        for name, kind in df.dtypes
    ]).alias("columns"))
    return one_row.select(F.inline("columns"))
