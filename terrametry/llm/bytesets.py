"""Vectorised words, hashes and packed key exchange for tasks that read whole texts.

Texts of one Arrow table are joined by line feeds into one byte buffer; words are
runs of bytes for which a table of 256 flags is true. A word's hash is a 64-bit
polynomial over random byte values, so equal words hash alike in every task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

_PIECE = 1 << 20
#: Batches, and buckets, that one task takes.
BATCHES = 3
_random = np.random.RandomState(20240229)
_BYTE = _random.randint(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 5)
_PLACE = _random.randint(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """One-to-one scrambling of 64-bit values (splitmix64's last steps)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def flags(allowed: Callable[[int], bool]) -> np.ndarray:
    """Table of 256 flags, one for each byte."""
    return np.array([allowed(b) for b in range(256)], bool)


#: Words as runs of anything but white space, and as runs of letters, digits and non-ASCII bytes.
NOT_SPACE = flags(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALPHANUMERIC = flags(lambda b: b >= 0x80 or chr(b).isalnum())
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def joined(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a line feed after each, and where each begins; one more entry ends the last."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    whole = pc.binary_join(pa.ListArray.from_arrays([0, len(texts)], texts), b"\n")[0].as_buffer()
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    buf = np.empty(starts[-1], np.uint8)
    buf[:-1] = np.frombuffer(whole, np.uint8)
    buf[-1] = 10
    return buf, starts


def word_spans(buf: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after its last."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = allowed[buf]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, a piece of the buffer at a time."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    lens = ends - starts
    done = np.cumsum(lens)
    power = powers(int(lens.max()) + 1)
    i = 0
    while i < len(starts):
        before = done[i] - lens[i]
        j = max(i + 1, int(np.searchsorted(done, before + _PIECE)))
        n, first = lens[i:j], done[i:j] - lens[i:j] - before
        within = np.arange(int(n.sum())) - np.repeat(first, n)
        at = within + np.repeat(starts[i:j], n)
        out[i:j] = np.add.reduceat(_BYTE[buf[at]] * power[within], first)
        i = j
    return mix(out + lens.astype(np.uint64) * _PLACE[63])


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbours (at most 62)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, width, np.uint64) * _PLACE[62]
    for k in range(width):
        total += h[k:k + n] * _PLACE[k]
    return mix(total)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def in_batches(docs: DataFrame, n_bytes: int, key: str = "id", text: str = "text", batch_bytes: int = 8 << 20) -> DataFrame:
    """Column ``batch``, alike for every run: rows dealt by key and text to batches of some 8 MB.

    Rows that share a key, or have none, are spread by their texts; only identical rows meet in
    one batch. Tasks follow the input in number: each takes some batches.
    """
    n = max(1, math.ceil(n_bytes / batch_bytes))
    dealt = docs.withColumn("batch", F.pmod(F.xxhash64(key, text), F.lit(n)).cast("long"))
    return dealt.repartition(max(1, math.ceil(n / BATCHES)), "batch")


def bucket_bits(n_bytes: int, bucket_bytes: int = 16 << 20) -> int:
    """Bits of a key that name its bucket: buckets grow in number, not in size."""
    return min(31, max(3, math.ceil(math.log2(max(1, n_bytes / bucket_bytes)))))


POSTINGS = "batch long, bucket long, keys binary, counts binary"
TOTALS = "batch long, bucket long, totals binary"


def postings(batch: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.Table:
    """One row for each bucket with the 32 bits of every key that follow the bucket's.

    ``keys`` are sorted and distinct; a key is sent once, however many rows of the
    batch have it, so a frequent key costs at most one entry for each batch.
    """
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    rest = (keys >> np.uint64(32 - bits)).astype(np.uint32)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cut[1:], len(keys))
    counts = np.minimum(counts, 65535).astype(np.uint16)
    return pa.table({
        "batch": pa.array([batch] * len(cut), pa.int64()),
        "bucket": pa.array(bucket[cut], pa.int64()),
        "keys": pa.array([rest[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
        "counts": pa.array([counts[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
    })


def _add_up(group: pa.Table) -> pa.Table:
    keys = [np.frombuffer(k, np.uint32) for k in group["keys"].to_pylist()]
    counts = np.concatenate([np.frombuffer(c, np.uint16) for c in group["counts"].to_pylist()])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(at, weights=counts)
    total = np.minimum(sums, 65535).astype(np.uint16)[at]
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({
        "batch": group["batch"], "bucket": group["bucket"],
        "totals": pa.array([total[b - len(k):b].tobytes() for k, b in zip(keys, ends)], pa.binary()),
    })


def totals(sent: DataFrame, bits: int) -> DataFrame:
    """For each batch's postings, how often each key occurs in all batches (65,535 and more alike).

    Two keys of a bucket that agree in 32 bits count together, so a total is never too small.
    """
    return sent.repartition(max(1, math.ceil((1 << bits) / BATCHES)), "bucket").groupBy("bucket").applyInArrow(_add_up, TOTALS)


def totals_of(mine: pa.Table, n: int) -> np.ndarray:
    """A batch's totals in the order of its sorted keys."""
    mine = mine.sort_by("bucket")
    out = np.frombuffer(b"".join(mine["totals"].to_pylist()), np.uint16)
    if len(out) != n:
        raise ValueError(f"a batch sent {n} keys and got {len(out)} totals")
    return out


def pieces(table: pa.Table | pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.Table]:
    """Consecutive rows with some 4 MB of text each (one longer text stays whole)."""
    if isinstance(table, pa.RecordBatch):
        table = pa.Table.from_batches([table])
    size = np.cumsum(pc.fill_null(pc.binary_length(table[column]), 0).to_numpy().astype(np.int64))
    i = 0
    while i < table.num_rows:
        before = size[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(size, before + most)))
        yield table.slice(i, j - i)
        i = j
