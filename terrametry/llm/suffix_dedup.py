"""Removal of long repeated byte strings, found in suffix arrays built by two-stage sorting.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else, in the same text or another. Strings never cross texts.

1. Every window of ``length`` bytes has an anchor: the smallest hash among its
   ``GRAM``-byte strings, the leftmost of equals. Equal windows have equal anchors.
   Neighbouring windows with one anchor are a run. Batches exchange how often each
   anchor value occurs; runs whose value occurs once have no repeated window.
2. Runs of a value too frequent for one task exchange hashes of whole windows
   likewise and go on as single windows, dealt by that hash.
3. The bytes below each remaining run, once for each batch and text of it, go to a
   task by their value. There a suffix array over the different segments of a value is
   built in two stages: suffixes smaller than their successor are sorted directly, the
   others are induced by scanning the buckets of first bytes. Window starts that are
   neighbours in it and share ``length`` bytes are repeated.
4. Each batch takes back the spans of its texts.

Null and empty texts, and those shorter than ``length``, lose nothing. Repeated
rows are different places: a text of at least ``length`` bytes that occurs twice
goes whole from both. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .bytesets import (
    BATCHES,
    _BYTE, POSTINGS, TOTALS, bucket_bits, in_batches, joined, mix, postings, text_bytes, totals, totals_of,
)

GRAM = 32
#: Runs of one anchor value that a task sorts together at most; more frequent values are dealt by windows.
FREQUENT = 4096
#: Bytes of segments sorted in one suffix array, more only for a single value.
PACK = 1 << 20
_SLICE = 1 << 16
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 | 1 for k in range(40)], np.uint64)

SEGMENTS = "batch long, task long, value long, segment binary, places array<long>"
SPANS = "batch long, starts binary, ends binary"
RESULT = "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>"


def string_hashes(buf: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes at each place: halves of powers of two, put together."""
    n = len(buf) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, bit = np.zeros(n, np.uint64), 0, 0
    h = _BYTE[buf]
    while True:
        if length >> bit & 1:
            out += h[at:at + n] * _ODD[20 + bit]
            at += 1 << bit
        if length >> (bit + 1) == 0:
            return mix(out)
        step = 1 << bit
        h = mix(h[:-step] * _ODD[bit] + h[step:]) if bit == 2 else h[:-step] * _ODD[bit] + h[step:]
        bit += 1


def _anchors(piece: np.ndarray, length: int) -> np.ndarray:
    """Smallest hash and its place (last 16 bits) for each window of a piece of less than 65,536 bytes."""
    h = string_hashes(piece, min(GRAM, length))
    h = (h & ~np.uint64(0xFFFF)) | np.arange(len(h), dtype=np.uint64)
    width, reach = length - min(GRAM, length) + 1, 1
    n = len(piece) - length + 1
    while reach * 2 <= width:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    return np.minimum(h[:n], h[width - reach:width - reach + n])


def runs(buf: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, window after the last, and anchor value of every run of all texts."""
    sizes = np.diff(begins) - 1
    found = []
    for d in np.flatnonzero(sizes >= length).tolist():
        lo, hi = int(begins[d]), int(begins[d + 1]) - 1
        while hi - lo >= length:
            piece = buf[lo:min(hi, lo + _SLICE)]
            h = _anchors(piece, length)
            change = np.flatnonzero(np.diff(h)) + 1
            first = np.concatenate([[0], change])
            place = (h[first] & np.uint64(0xFFFF)).astype(np.int64) + lo
            found.append((first + lo, np.append(change, len(h)) + lo, h[first] & ~np.uint64(0xFFFF), place))
            lo += len(h)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first, after, value, place = (np.concatenate(x) for x in zip(*found))
    new = np.ones(len(first), bool)  # a run goes on where a piece ended
    new[1:] = (first[1:] != after[:-1]) | (place[1:] != place[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(first)) - 1
    return first[new], after[last], mix(value[new])  # the smallest of many would share their first bits


def _ordered(docs: pa.Table) -> pa.Table:
    return docs.sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()


def _starts_of(first: np.ndarray, after: np.ndarray) -> np.ndarray:
    n = after - first
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def _frequent(buf, first, after, often, length):
    """All windows of frequent runs with their hashes."""
    at = _starts_of(first[often], after[often])
    h = np.zeros(len(at), np.uint64)
    for a, b, x in zip(first[often].tolist(), after[often].tolist(), np.cumsum(np.append(0, (after - first)[often]))):
        h[x:x + b - a] = string_hashes(buf[a:b - 1 + length], length)
    return at, h


def _seen_runs(docs: pa.Table, mine: pa.Table, length: int):
    buf, begins = joined(docs["text"])
    first, after, value = runs(buf, begins, length)
    keys, at = np.unique(value, return_inverse=True)
    return buf, begins, first, after, value, totals_of(mine, len(keys))[at]


def two_stage_order(text: bytes, size: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of the wanted suffixes of many segments, sorted by ``depth`` bytes at least.

    ``text`` holds the segments one after another, ``size`` their lengths; the first
    ``wanted`` suffixes of each are sorted. A segment's end is smaller than any byte.
    """
    raw = np.frombuffer(text, np.uint8)
    begin = np.cumsum(size) - size
    end = begin + size
    up = np.zeros(len(raw), bool)  # smaller than its successor
    step = np.zeros(len(raw), np.int8)
    step[:-1] = np.sign(raw[1:].astype(np.int16) - raw[:-1])
    step[end - 1] = -1
    decided = np.flatnonzero(step)
    up = step[decided[np.searchsorted(decided, np.arange(len(raw)))]] > 0
    # what the last wanted suffix is induced from belongs to the array too
    stops = np.append(np.flatnonzero(up), len(raw))
    reach = np.minimum(stops[np.searchsorted(stops, begin + wanted - 1)] + 1, end)
    needed = np.zeros(len(raw), bool)
    needed[_starts_of(begin, reach)] = True
    segment_end = np.repeat(end, size)

    direct = np.flatnonzero(needed & up)
    stop = np.minimum(segment_end[direct], direct + depth).tolist()
    keys = [text[a:b] for a, b in zip(direct.tolist(), stop)]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    by_byte = np.searchsorted(raw[direct], np.arange(257))

    waiting: dict[int, list[np.ndarray]] = defaultdict(list)

    def induce(at: np.ndarray, byte: int) -> np.ndarray:
        """Hands larger predecessors on to their buckets; returns those of this bucket."""
        before = at[at > 0] - 1
        before = before[needed[before] & ~up[before] & (segment_end[before] > before + 1)]
        own = raw[before]
        later = before[own > byte]
        order = np.argsort(raw[later], kind="stable")
        later, cut = later[order], np.flatnonzero(np.diff(raw[later][order], prepend=-1)) if len(later) else []
        for a, b in zip(cut, [*cut[1:], len(later)]):
            waiting[int(raw[later[a]])].append(later[a:b])
        return before[own == byte]

    ends = (end - 1)[needed[end - 1]]
    order = np.argsort(raw[ends], kind="stable")
    for at in np.split(ends[order], np.flatnonzero(np.diff(raw[ends[order]])) + 1) if len(ends) else []:
        waiting[int(raw[at[0]])].append(at)
    array = []
    for byte in range(256):
        level = np.concatenate([*waiting.pop(byte, []), np.zeros(0, np.int64)])
        while len(level):
            array.append(level)
            level = induce(level, byte)
        sorted_here = direct[by_byte[byte]:by_byte[byte + 1]]
        array.append(sorted_here)
        induce(sorted_here, byte)
    return np.concatenate(array)


def repeated_windows(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each of some different segments, which of its windows start elsewhere in them too."""
    size = np.array([len(s) for s in segments])
    text, begin = b"".join(segments), np.cumsum(size) - size
    order = two_stage_order(text, size, size - length + 1, length)
    start = np.zeros(len(text), bool)
    start[_starts_of(begin, begin + size - length + 1)] = True
    order = order[start[order]].tolist()
    again = np.zeros(len(text), bool)
    for a, b in zip(order, order[1:]):
        if text[a:a + length] == text[b:b + length]:
            again[a] = again[b] = True
    return [again[b:b + n - length + 1] for b, n in zip(begin.tolist(), size.tolist())]


def _judge(group: pa.Table, length: int) -> pa.Table:
    """Repeated spans below each segment of one task, at every place it was found."""
    value, segment = group["value"].to_pylist(), group["segment"].to_pylist()
    places = [np.array(p, np.int64) for p in group["places"].to_pylist()]
    where: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
    for i, (v, s) in enumerate(zip(value, segment)):
        where[v][s].append(i)
    again: dict[tuple[int, bytes], np.ndarray] = {}
    pack: list[tuple[int, bytes]] = []

    def sort_pack() -> None:
        again.update(zip(pack, repeated_windows([s for _, s in pack], length)) if pack else ())
        pack.clear()

    size = 0
    for v, different in where.items():
        if len(different) > 1:  # a segment alone under its value has no other to be sorted against
            if size + sum(map(len, different)) > PACK:
                sort_pack()
                size = 0
            pack.extend((v, s) for s in different)
            size += sum(map(len, different))
    sort_pack()
    batch, starts, ends = [], [], []
    all_batches = group["batch"].to_pylist()
    for v, different in where.items():
        for s, rows in different.items():
            if sum(len(places[i]) for i in rows) > 1:
                marks = np.ones(len(s) - length + 1, np.int8)
            else:
                marks = again.get((v, s), np.zeros(0, bool)).astype(np.int8)
            edge = np.diff(marks, prepend=0, append=0)
            a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1 + length
            if len(a):
                for i in rows:
                    batch.append(all_batches[i])
                    starts.append(np.add.outer(places[i], a).tobytes())
                    ends.append(np.add.outer(places[i], b).tobytes())
    return pa.table({"batch": pa.array(batch, pa.int64()), "starts": pa.array(starts, pa.binary()),
                     "ends": pa.array(ends, pa.binary())})


def _cut(docs: pa.Table, spans: pa.Table) -> pa.Table:
    docs = _ordered(docs)
    buf, begins = joined(docs["text"])
    edge = np.zeros(len(buf) + 1, np.int32)
    for column, by in (("starts", 1), ("ends", -1)):
        np.add.at(edge, np.frombuffer(b"".join(spans[column].to_pylist()), np.int64), by)
    gone = np.cumsum(edge[:-1]) > 0
    flip = np.diff(gone.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(flip == 1), np.flatnonzero(flip == -1)
    kept, per_doc = [], []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        i, j = np.searchsorted(first, (a, b - 1))
        per_doc.append([{"start": int(x) - a, "end": int(y) - a} for x, y in zip(first[i:j], last[i:j])])
        kept.append(buf[a:b - 1][~gone[a:b - 1]].tobytes())
    return pa.table({
        "doc_id": docs["id"], "n_bytes": pa.array(np.diff(begins) - 1, pa.int64()), "kept": pa.array(kept, pa.binary()),
        "spans": pa.array(per_doc, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    })


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """(doc_id, n_bytes, kept, spans) for every row: the bytes left and the maximal removed spans."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n_bytes = text_bytes(docs)
    bits = bucket_bits(n_bytes)
    dealt = in_batches(docs, n_bytes).select("id", "text", "batch").groupBy("batch")

    def send(key: tuple, group: pa.Table) -> pa.Table:
        buf, begins = joined(_ordered(group)["text"])
        keys, counts = np.unique(runs(buf, begins, length)[2], return_counts=True)
        return postings(key[0].as_py(), keys, counts, bits)

    def send_frequent(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        buf, _, first, after, _, seen = _seen_runs(_ordered(left), right, length)
        keys, counts = np.unique(_frequent(buf, first, after, seen > FREQUENT, length)[1], return_counts=True)
        return postings(key[0].as_py(), keys, counts, bits)

    def send_segments(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        of_runs, of_windows = (right.filter(pc.equal(right["round"], r)) for r in (1, 2))
        buf, _, first, after, value, seen = _seen_runs(_ordered(left), of_runs, length)
        at, h = _frequent(buf, first, after, seen > FREQUENT, length)
        keys, where = np.unique(h, return_inverse=True)
        shared = totals_of(of_windows, len(keys))[where] > 1
        usual = (seen > 1) & (seen <= FREQUENT)
        found: dict[tuple[int, bytes], list[int]] = defaultdict(list)
        a = np.concatenate([first[usual], at[shared]]).tolist()
        b = np.concatenate([after[usual], at[shared] + 1]).tolist()
        for v, x, y in zip(np.concatenate([value[usual], h[shared]]).view(np.int64).tolist(), a, b):
            found[v, buf[x:y - 1 + length].tobytes()].append(x)
        values = np.array([v for v, _ in found], np.int64)
        return pa.table({
            "batch": pa.array([key[0].as_py()] * len(found), pa.int64()),
            "task": pa.array((values.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)),
            "value": pa.array(values), "segment": pa.array([s for _, s in found], pa.binary()),
            "places": pa.array(list(found.values()), pa.list_(pa.int64())),
        })

    of_runs = totals(dealt.applyInArrow(send, POSTINGS), bits)
    of_windows = totals(dealt.cogroup(of_runs.groupBy("batch")).applyInArrow(send_frequent, POSTINGS), bits)
    both = of_runs.withColumn("round", F.lit(1)).unionAll(of_windows.withColumn("round", F.lit(2)))
    segments = dealt.cogroup(both.groupBy("batch")).applyInArrow(send_segments, SEGMENTS)
    n_tasks = max(1, math.ceil((1 << bits) / BATCHES))
    spans = segments.repartition(n_tasks, "task").groupBy("task").applyInArrow(lambda group: _judge(group, length), SPANS)
    return dealt.cogroup(spans.groupBy("batch")).applyInArrow(_cut, RESULT)
