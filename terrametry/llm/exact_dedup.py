"""Exact dedup through an extendible-hash index on shared files; built-in expressions only.

1. Each row's signature - its key of up to 63 hash bits, digest, size and row number - is
   written to the shared folder, so that texts are read twice in all.
2. The directory starts as deep as an even spread needs. While a bucket holds more than
   its capacity, the directory doubles and overfull buckets split by the next bit of the
   key; copies count once. At most ``SPLITS`` doublings follow: what does not fit then,
   one long text or texts under one key, stays in its bucket. Capacity follows the input
   beyond ``BUCKETS`` buckets, so the directory never has more than
   ``2 * BUCKETS << SPLITS`` slots and is broadcast.
3. Owner tasks take whole buckets, which are ranges of keys. Texts under one key form a
   chain: the bytes of each are compared with those of the others, and every different
   text becomes one entry. Entries are written to the shared folder, in order of their keys.
4. Each row finds its entry by key and digest. That two texts of a chain differ in their
   digests was checked when their bytes were compared; otherwise the job stops.

Keys with more than ``1 / SHARE`` of all rows are fewer than ``SHARE``. Their rows fold within each
input task before they are dealt out, and find their entries by broadcast.

Null texts count as empty, and empty texts are copies of one another. Of equal texts the row
with the largest id stays, any id before none; of repeated rows one, so that every group
keeps exactly one row. ``keep_id`` is null where no row of the group has an id. An empty
table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

#: Bytes of different texts that a bucket holds, as long as ``BUCKETS`` buckets are enough.
CAPACITY = 256 << 10
BUCKETS = 1 << 16
#: Doublings of the directory beyond an even spread.
SPLITS = 3
SHARE = 1024
#: Rows under one key that never count as many.
FEW = 64
#: Bytes of texts for each owner task, and bytes of an entry beside its text.
OWNED = 32 << 20
ENTRY = 64
KEY_BITS = 63


@dataclass(frozen=True)
class Index:
    """``directory`` (slot, bucket, local) of ``2 ** depth`` slots; ``entries``
    (bucket, key, place, digest, n_bytes, keep_id, group_size), one for each different text."""

    directory: DataFrame
    depth: int
    entries: DataFrame


def _key(text: Column, bits: int) -> Column:
    unused = KEY_BITS - bits
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 1 + unused), unused)


def _prefix(key: str, depth: int, bits: int = KEY_BITS) -> Column:
    return F.shiftrightunsigned(F.col(key), bits - depth) if depth else F.lit(0).cast("long")


def signatures(texts: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """(id, key, digest, n_bytes, row) of every row of ``texts`` (id, text), written once."""
    return stage(texts.select(
        "id", _key(F.col("text"), bits).alias("key"), F.sha2("text", 256).alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), "signatures")


def _directory(signed: DataFrame, n_bytes: int, capacity: int) -> tuple[DataFrame, int]:
    """(slot, bucket, local), and the depth; a bucket is the first slot that points to it."""
    most = math.ceil(math.log2(max(1, n_bytes / capacity)))
    finest = most + SPLITS
    load = (
        signed.groupBy("key").agg((F.max("n_bytes") + ENTRY).alias("n_bytes"))
        .groupBy(_prefix("key", finest).alias("prefix")).agg(F.sum("n_bytes").alias("n_bytes")))
    load = stage(load, "load")
    depth = max(0, math.floor(math.log2(max(1, (load.agg(F.sum("n_bytes")).first()[0] or 0) / capacity))))
    of = lambda rows, d: rows.groupBy(_prefix("prefix", d, finest).alias("bucket")).agg(F.sum("n_bytes").alias("n_bytes"))
    level, leaves = of(load, depth), []
    while True:
        level = stage(level.withColumn("local", F.lit(depth)), "buckets")
        full = (F.col("n_bytes") > capacity) & F.lit(depth < finest)
        leaves.append(level.where(~full))
        over = level.where(full).select(F.col("bucket").alias("prefix"))
        if over.isEmpty():
            break
        inside = load.withColumn("within", _prefix("prefix", depth, finest)).join(
            over.withColumnRenamed("prefix", "within"), "within", "left_semi")
        depth += 1
        level = of(inside, depth)
    held = leaves[0]
    for more in leaves[1:]:
        held = held.unionAll(more)
    unused = F.lit(depth) - F.col("local")
    first = F.call_function("shiftleft", F.col("bucket"), unused)
    last = F.call_function("shiftleft", F.col("bucket") + 1, unused) - 1
    return held.select(F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"), "local"), depth


def build_index(texts: DataFrame, signed: DataFrame, n_rows: int, n_bytes: int, bits: int = KEY_BITS,
                capacity: int = CAPACITY) -> Index:
    """Index of ``texts`` (id, text without nulls), whose :func:`signatures` are ``signed``."""
    capacity = max(capacity, math.ceil(n_bytes / BUCKETS))
    directory, depth = _directory(signed, n_bytes, capacity)
    directory = stage(directory, "directory")
    many = stage(signed.groupBy("key").count().where(F.col("count") > _limit(n_rows)).select("key"), "many")
    rows = texts.withColumn("key", _key(F.col("text"), bits)).withColumn("slot", _prefix("key", depth)).join(
        F.broadcast(directory.select("slot", "bucket")), "slot", "left").select("bucket", "key", "text", "id")
    chain = ("bucket", "key", "text")
    one = rows.select(*chain, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    if not many.isEmpty():
        folded = rows.join(F.broadcast(many), "key", "left_semi").groupBy(*chain).agg(
            F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        one = one.join(F.broadcast(many), "key", "left_anti").select(*one.columns).unionAll(folded)
    owned = one.repartition(max(1, math.ceil(n_bytes / OWNED)), "bucket")
    entries = owned.groupBy(*chain).agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")).select(
        "bucket", "key", F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"),
        "keep_id", "group_size")
    along = Window.partitionBy("bucket", "key").orderBy("digest")
    alike = F.lag("digest").over(along) == F.col("digest")
    entries = entries.select(
        "bucket", "key", F.row_number().over(along).alias("place"),
        F.when(alike, F.raise_error(F.lit("two different texts have one digest"))).otherwise(F.col("digest")).alias("digest"),
        "n_bytes", "keep_id", "group_size").sortWithinPartitions("bucket", "key", "place")
    return Index(directory, depth, stage(entries, "entries"))


def _limit(n_rows: int) -> int:
    return max(FEW, n_rows // SHARE)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 normal: Callable[[Column], Column] | None = None, bits: int = KEY_BITS, capacity: int = CAPACITY) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) for every row; ``normal`` may change texts before they are compared.

    ``digest`` is the SHA-256 of the normalised text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), (normal(text) if normal else text).alias("text"))
    signed = signatures(texts, bits)
    n_rows, n_bytes = signed.agg(F.count(F.lit(1)), F.sum(F.col("n_bytes") + ENTRY)).first()
    limit = _limit(n_rows)
    entries = build_index(texts, signed, n_rows, n_bytes or 0, bits, capacity).entries.select(
        "key", "digest", "keep_id", "group_size")
    found = ["id", "keep_id", "group_size", "kept", "digest"]
    text_of = ["key", "digest"]
    large = F.broadcast(entries.where(F.col("group_size") > limit))
    first = Window.partitionBy(*text_of).orderBy(F.desc_nulls_last("id"), F.desc("row"))
    cold = signed.join(large.select(*text_of), text_of, "left_anti").join(
        entries.where(F.col("group_size") <= limit), text_of).withColumn("kept", F.row_number().over(first) == 1).select(*found)
    hot = signed.join(large, text_of)
    stays = hot.groupBy(*text_of).agg(F.max(F.struct("id", "row"))["row"].alias("stays"))
    return cold.unionAll(hot.join(F.broadcast(stays), text_of).withColumn("kept", F.col("row") == F.col("stays")).select(*found))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row (id, text digest) of each group of equal texts."""
    return exact_groups(docs, id_col, text_col, **how).where("kept").select(F.col("id").alias(id_col), "digest")
