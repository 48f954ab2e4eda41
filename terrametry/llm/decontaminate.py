"""Benchmark passages in documents, by suffix arrays over the documents.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A
benchmark item's windows are its runs of ``window`` words; an item with fewer
words, but not none, is one window.

The benchmark is read in slices of some ``SLICE_WORDS`` words, one after another, each sent to all
tasks. Every task makes suffix arrays over shards of some 4 MB of its documents, with
the slice's words as letters and anything else as a break, and looks every test suffix
up in them by binary search: the suffixes that begin with it are the locations of its
window. The longest match of a stretch of hit words is read off the prefix lengths of a suffix array over the
stretch and the items found in it. No row is shuffled, so neither a frequent passage nor a group of
copies gathers anywhere.

Null and empty texts have no words and no hit; null and empty items no window. An
item without id counts under the empty id, items that share an id count once, and
items with equal words all count. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .bytesets import ALPHANUMERIC, LOWER, joined, pieces, word_hashes, word_spans

#: Words of the benchmark that one broadcast holds on average; a longer item stays whole.
SLICE_WORDS = 2_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MATCH = "struct<start: long, end: long, longest: long>"
RESULT = f"doc_id long, n_words long, items array<string>, matches array<{MATCH}>"


def _hashed_words(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and where each text's begin."""
    buf, begins = joined(texts)
    buf = LOWER[buf]
    starts, ends = word_spans(buf, ALPHANUMERIC)
    return word_hashes(buf, starts, ends), np.searchsorted(starts, begins)


def suffix_array(letters: np.ndarray) -> np.ndarray:
    """Places of all suffixes in their order, by ranks of prefixes that double in length."""
    n = len(letters)
    rank = np.unique(letters, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.full(n, -1, np.int64)
        after[:max(0, n - width)] = rank[width:]
        order = np.lexsort((after, rank))
        a, b = rank[order], after[order]
        new = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or width >= n:
            return order
        width *= 2


def prefix_lengths(letters: np.ndarray, order: np.ndarray) -> list[int]:
    """Letters that each suffix, in order, has in common with the one before."""
    text, place = letters.tolist(), np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before = np.concatenate([[-1], order[:-1]])[place].tolist()
    rank, out, n, k = place.tolist(), [0] * len(order), len(order), 0
    for i in range(n):
        j = before[i]
        if j < 0:
            k = 0
            continue
        while i + k < n and j + k < n and text[i + k] == text[j + k]:
            k += 1
        out[rank[i]] = k
        k = max(0, k - 1)
    return out


def longest_common(letters: np.ndarray, n_left: int) -> int:
    """Longest run of letters before place ``n_left`` that also stands after it: the most
    that neighbouring suffixes of the two sides share."""
    order = suffix_array(letters)
    shared, left = prefix_lengths(letters, order), (order < n_left).tolist()
    return max((k for k, a, b in zip(shared[1:], left, left[1:]) if a != b), default=0)


class TestSlice:
    """Windows of some benchmark items, ready to be looked up in any shard."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        h, first = _hashed_words(pa.array([t for _, t in items], pa.string()))
        self.vocabulary, letters = np.unique(h, return_inverse=True)
        letters = letters.astype(np.int64) + 1
        self.bits = max(2, int(len(self.vocabulary) + 1).bit_length())
        self.window = window
        same: dict[bytes, int] = {}
        ids: list[set[str]] = []
        for (item, _), a, b in zip(items, first[:-1].tolist(), first[1:].tolist()):
            if b > a:
                n = same.setdefault(letters[a:b].tobytes(), len(ids))
                if n == len(ids):
                    ids.append(set())
                ids[n].add(item)
        self.ids = [sorted(i) for i in ids]
        known: dict[bytes, int] = {}
        of_window: list[list[int]] = []
        self.sequences = [np.frombuffer(sequence, np.int64) for sequence in same]
        for n, own in enumerate(self.sequences):
            for k in range(max(1, len(own) - window + 1)):
                key = own[k:k + window].tobytes()
                w = known.setdefault(key, len(of_window))
                if w == len(of_window):
                    of_window.append([])
                if not of_window[w] or of_window[w][-1] != n:
                    of_window[w].append(n)
        self.classes = of_window
        rows = [np.frombuffer(k, np.int64) for k in known]
        self.length = np.array([len(r) for r in rows], np.int64)
        low = np.zeros((len(rows), window), np.int64)
        high = np.full((len(rows), window), (1 << self.bits) - 1, np.int64)
        for i, r in enumerate(rows):
            low[i, :len(r)] = high[i, :len(r)] = r
        self.low, self.high = self._text(self._packed(low.T)), self._text(self._packed(high.T))
        self.shortest = int(self.length.min()) if len(rows) else 0

    def _packed(self, letters: np.ndarray) -> list[np.ndarray]:
        """Keys of 64 bits that order like the rows of letters."""
        per = 64 // self.bits
        out = []
        for k in range(0, self.window, per):
            key = np.zeros(letters.shape[1], np.uint64)
            for j in range(k, k + per):
                key <<= np.uint64(self.bits)
                if j < self.window:
                    key |= letters[j].astype(np.uint64)
            out.append(key)
        return out

    @staticmethod
    def _text(keys: list[np.ndarray]) -> np.ndarray:
        wide = np.ascontiguousarray(np.stack(keys, 1).astype(">u8"))
        return wide.view(f"S{8 * len(keys)}").ravel()

    def look_up(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place) of every occurrence in a shard; 0 is a letter of no word."""
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if not len(self.length) or not len(letters):
            return none
        breaks = np.append(np.flatnonzero(letters == 0), len(letters))
        suffix = np.flatnonzero(letters)
        suffix = suffix[breaks[np.searchsorted(breaks, suffix)] - suffix >= self.shortest]
        if not len(suffix):
            return none
        padded = np.append(letters, np.zeros(self.window, letters.dtype))
        rows = np.stack([padded[suffix + k] for k in range(self.window)])
        np.multiply(rows, np.minimum.accumulate(rows != 0, axis=0), out=rows)  # nothing beyond a break
        keys = self._packed(rows)
        order = np.lexsort(keys[::-1])
        array, text = suffix[order], self._text([k[order] for k in keys])
        lo, hi = np.searchsorted(text, self.low), np.searchsorted(text, self.high, "right")
        n = hi - lo
        window = np.repeat(np.arange(len(n)), n)
        return window, array[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]

    def _longest(self, stretch: np.ndarray, classes: tuple[int, ...]) -> int:
        """Words of the longest run that a stretch has in common with one of the items found in it."""
        items = [self.sequences[n] for n in classes]
        ends = np.arange(1, len(items) + 2) + int(max(map(np.max, items), default=0))  # a letter of its own ends each
        parts = [part for sequence, end in zip([stretch, *items], ends) for part in (sequence, [end])]
        letters = np.concatenate(parts).astype(np.int64)
        return longest_common(letters, len(stretch))

    def scan(self, texts: pa.ChunkedArray) -> tuple[np.ndarray, list[list[str]], list[list[tuple[int, int, int]]]]:
        """Of each text: its number of words, ids of items found, and (start, end, longest match) of hit stretches."""
        h, first = _hashed_words(texts)
        n_words = np.diff(first)
        at = np.searchsorted(self.vocabulary, h)
        at[at == len(self.vocabulary)] = 0
        letters = np.zeros(len(h) + len(n_words), np.int64)  # a break after each text
        spot = np.arange(len(h)) + np.repeat(np.arange(len(n_words)), n_words)
        if len(self.vocabulary):
            letters[spot] = np.where(self.vocabulary[at] == h, at + 1, 0)
        window, place = self.look_up(letters)
        items: list[list[str]] = [[] for _ in n_words]
        matches: list[list[tuple[int, int, int]]] = [[] for _ in n_words]
        if not len(place):
            return n_words, items, matches
        edge = np.bincount(place, minlength=len(letters) + 1) - np.bincount(
            place + self.length[window], minlength=len(letters) + 1)
        hit = np.diff((np.cumsum(edge) > 0).astype(np.int8), prepend=0)
        begins = first[:-1] + np.arange(len(n_words))
        order = np.argsort(place, kind="stable")
        window, place = window[order], place[order]
        ids_of: dict[tuple[int, ...], list[str]] = {}
        seen: dict[tuple[bytes, tuple[int, ...]], int] = {}
        found = defaultdict(set)
        for a, b in zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist()):
            doc = int(np.searchsorted(begins, a, "right")) - 1
            i, j = np.searchsorted(place, (a, b))
            here = np.unique(window[i:j]).tolist()
            stretch = letters[a:b].tobytes(), tuple(sorted({n for w in here for n in self.classes[w]}))
            if stretch not in seen:
                seen[stretch] = self._longest(letters[a:b], stretch[1])
            matches[doc].append((a - int(begins[doc]), b - int(begins[doc]), seen[stretch]))
            found[doc].update(here)
        for doc, windows in found.items():
            classes = tuple(sorted({n for w in windows for n in self.classes[w]}))
            if classes not in ids_of:
                ids_of[classes] = sorted(set(itertools.chain.from_iterable(self.ids[n] for n in classes)))
            items[doc] = ids_of[classes]
        return n_words, items, matches


def test_slices(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[TestSlice]:
    """The benchmark in slices of some ``SLICE_WORDS`` words, dealt by Spark; one at a time comes to the driver."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.coalesce(text_col, F.lit("")).alias("text"))
    n_words = rows.agg(F.sum(F.regexp_count(F.lower("text"), F.lit(WORD)))).first()[0] or 0
    n = max(1, math.ceil(n_words / SLICE_WORDS))
    for part in range(n):
        own = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == part).toArrow().sort_by([("item", "ascending"), ("text", "ascending")])
        if own.num_rows:
            yield TestSlice(list(zip(own["item"].to_pylist(), own["text"].to_pylist())), window)


test_slices.__test__ = False


def _merged(old: list[dict], new: list[tuple[int, int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b, n in sorted([*((m["start"], m["end"], m["longest"]) for m in old), *new]):
        if out and a <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(b, out[-1]["end"]), "longest": max(n, out[-1]["longest"])}
        else:
            out.append({"start": a, "end": b, "longest": n})
    return out


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, items, matches) for every row of ``docs``.

    ``items`` are the ids of items with a window in the text, as sorted strings;
    ``matches`` the stretches of hit words, each with the words of its longest match.
    """
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumns({
        "n_words": F.lit(0).cast("long"), "items": F.array().cast("array<string>"),
        "matches": F.array().cast(f"array<{MATCH}>")})
    spark = docs.sparkSession

    def scanning(shared):
        def scan(batches):
            for batch in batches:
                for table in pieces(batch, "text"):
                    n_words, items, matches = shared.value.scan(table["text"])
                    items = [sorted({*a, *b}) for a, b in zip(table["items"].to_pylist(), items)]
                    matches = [_merged(a, b) for a, b in zip(table["matches"].to_pylist(), matches)]
                    for column, values in (("n_words", pa.array(n_words, pa.int64())), ("items", items), ("matches", matches)):
                        at = table.schema.get_field_index(column)
                        kind = table.schema.field(column).type
                        table = table.set_column(at, column, pa.array(values, kind))
                    yield from table.to_batches()
        return scan

    shared = None
    for one in test_slices(benchmark, item_col, item_text, window):
        if shared is not None:  # the slice before is done with once its findings are written
            out = stage(out, "passages")
            shared.unpersist()
        shared = spark.sparkContext.broadcast(one)
        out = out.mapInArrow(scanning(shared), out.schema)
    if shared is None:
        out = out.mapInArrow(scanning(spark.sparkContext.broadcast(TestSlice([], window))), out.schema)
    return out.select("doc_id", "n_words", "items", "matches")


def without_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                     item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose text has no word in common with an occurring window."""
    def cleaning(shared):
        def clean(batches):
            for batch in batches:
                for table in pieces(batch, text_col):
                    matches = shared.value.scan(table[text_col])[2]
                    yield from table.filter(pa.array([not m for m in matches], pa.bool_())).to_batches()
        return clean

    shared = None
    for one in test_slices(benchmark, item_col, item_text, window):
        if shared is not None:
            docs = stage(docs, "cleaned")
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(one)
        docs = docs.mapInArrow(cleaning(shared), docs.schema)
    return docs
