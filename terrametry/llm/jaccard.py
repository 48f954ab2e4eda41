"""Jaccard self-join of documents on their word shingles by T-occurrence search.

Two documents are linked when their sets of distinct shingles have a Jaccard
similarity of at least ``percent`` / 100. Every link between different sets is
honoured; the result names each document's connected component.

1. Batches of documents exchange their distinct shingles by buckets of the hash
   and get back how often each occurs anywhere. A document with too few shingles
   that occur elsewhere has no partner and is done.
2. Documents with one set become one representative. Its rarest shingles - so
   many that a partner must share one of them - are its signature. Documents that
   share signature shingles form groups, and every link lies within a group.
3. A group of more than ``CONTRACT`` members is first contracted: members are compared with the
   smallest member of each of their signature shingles, and shingles whose members
   are all connected by then need no search.
4. What is left of a group is searched in blocks: members outside its largest
   component are the queries, all members the index. A query takes the index's
   inverted lists of its shingles, leaves the longest aside (DivideSkip), merges the
   short ones by a heap, keeps documents met often enough, and looks these up in the
   long lists by binary search until the required overlap is reached or out of reach.

Documents without words, or with null text, have no shingle and no link. A row
without id is returned with a null component and links nothing. Rows with equal
ids are one node. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .bytesets import (
    LOWER, NOT_SPACE, POSTINGS, bucket_bits, in_batches, joined, postings, text_bytes,
    totals, totals_of, window_hashes, word_hashes, word_spans,
)
from .components import components

SETS = "id long, n_shingles long, set_key binary, shingles binary, signature array<long>"
#: Members of a group that one task indexes or queries at most.
BLOCK = 1000
#: Members of a group beyond which most links are found through its smallest members, before the search.
CONTRACT = 50
#: DivideSkip's weight of a binary search against merging, as its authors chose it.
_MU = 0.0085


def shingle_sets(texts: pa.ChunkedArray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle."""
    buf, begins = joined(texts)
    buf = LOWER[buf]
    starts, ends = word_spans(buf, NOT_SPACE)
    h = word_hashes(buf, starts, ends)
    first = np.searchsorted(starts, begins)
    all_windows = window_hashes(h, width)
    out = []
    for a, b in itertools.pairwise(first.tolist()):
        if b - a >= width:
            out.append(np.unique(all_windows[a:b - width + 1]))
        else:
            out.append(window_hashes(h[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def _distinct(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)


def required(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with every partner at least."""
    return -(-percent * n // 100)


def _signed(docs: pa.Table, mine: pa.Table, width: int, percent: int) -> pa.Table:
    sets = shingle_sets(docs["text"], width)
    keys, at, _ = _distinct(sets)
    seen = totals_of(mine, len(keys))[at]
    rows = {"n_shingles": [], "set_key": [], "shingles": [], "signature": []}
    i = 0
    for s in sets:
        n, total = len(s), seen[i:i + len(s)]
        i += n
        rows["n_shingles"].append(n)
        alone = int((total == 1).sum())
        if not n or n - alone < required(n, percent):
            for c in ("set_key", "shingles", "signature"):
                rows[c].append(None)
            continue
        rarest = np.lexsort((s, total))[alone:n - required(n, percent) + 1]
        rows["set_key"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
        rows["shingles"].append(s.tobytes())
        rows["signature"].append(s[rarest].view(np.int64))
    return pa.table({"id": docs["id"]} | {c: pa.array(v, t) for (c, v), t in zip(
        rows.items(), (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())))})


def document_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, n_shingles, set_key, shingles, signature); the last three null where no partner is possible."""
    n_bytes = text_bytes(docs)
    bits = bucket_bits(n_bytes)
    dealt = in_batches(docs, n_bytes).select("id", "text", "batch")

    def send(key: tuple, group: pa.Table) -> pa.Table:
        keys, _, counts = _distinct(shingle_sets(group["text"], width))
        return postings(key[0].as_py(), keys, counts, bits)

    def sign(left: pa.Table, right: pa.Table) -> pa.Table:
        return _signed(left, right, width, percent)

    back = totals(dealt.groupBy("batch").applyInArrow(send, POSTINGS), bits)
    return dealt.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(sign, SETS)


def linked(shared: int, n: int, m: int, percent: int) -> bool:
    return 100 * shared >= percent * (n + m - shared)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough."""
    a = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["of_a"].to_pylist(), batch["of_b"].to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(linked(shared, len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").mapInArrow(check, "a long, b long")


class ListIndex:
    """Inverted lists of one block's sets."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = [len(s) for s in sets]
        shingles = np.concatenate([*sets, np.zeros(0, np.uint64)])
        order = np.argsort(shingles, kind="stable")
        self.keys = shingles[order]
        self.docs = np.repeat(np.arange(len(sets)), self.sizes)[order].tolist()

    def search(self, query: np.ndarray, percent: int) -> list[int]:
        """Positions of all sets similar to ``query``, itself included if it is there."""
        least, n = required(len(query), percent), len(query)
        a, b = np.searchsorted(self.keys, query), np.searchsorted(self.keys, query, "right")
        lists = sorted(((int(y - x), int(x), int(y)) for x, y in zip(a, b) if y > x), reverse=True)
        if len(lists) < least:
            return []
        aside = min(least - 1, int(least / (_MU * math.log2(max(2, lists[0][0])) + 1)))
        long, short = lists[:aside], lists[aside:]
        found = []
        for doc, run in itertools.groupby(heapq.merge(*(self.docs[x:y] for _, x, y in short))):
            shared = sum(1 for _ in run)
            if shared < least - aside:
                continue
            need = max(least, -(-percent * (n + self.sizes[doc]) // (100 + percent)))
            for k, (_, x, y) in enumerate(long):
                if shared + aside - k < need:
                    break
                p = bisect_left(self.docs, doc, x, y)
                shared += p < y and self.docs[p] == doc
            if linked(shared, n, self.sizes[doc], percent):
                found.append(doc)
        return found


def _search_block(queries: pa.Table, members: pa.Table, percent: int) -> pa.Table:
    own, comp = members["rep"].to_pylist(), members["component"].to_pylist()
    index = ListIndex([np.frombuffer(s, np.uint64) for s in members["shingles"].to_pylist()])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    a, b = [], []
    for rep, mine, s in zip(*(queries[c].to_pylist() for c in ("rep", "component", "shingles"))):
        for at in index.search(np.frombuffer(s, np.uint64), percent):
            x, y = root(mine), root(comp[at])
            if x != y:
                parent[x] = y
                a.append(rep)
                b.append(own[at])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _groups(postings_: DataFrame) -> DataFrame:
    """Signature shingles of two components or more, as edges between components."""
    lead = postings_.groupBy("sh").agg(F.min("component").alias("b"), F.max("component").alias("last")).where("b <> last")
    return postings_.join(lead.drop("last"), "sh")


def find_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between representatives that connect just what all links connect.

    ``sets``: (rep, shingles, signature), one row for each set.
    """
    signs = sets.select("rep", F.explode("signature").alias("sh"))
    shared = signs.groupBy("sh").agg(F.min("rep").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n")
    signs = stage(signs.join(shared, "sh"), "signatures")
    stars = signs.where("rep <> lead").select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct()
    group = components(stars, "groups")
    size = group.groupBy("component").agg(F.count("*").alias("n"))
    large = group.join(size.where(F.col("n") > CONTRACT), "component").select(F.col("node").alias("a"))
    stars = stage(_verified(stars.join(large, "a", "left_semi"), sets, percent), "stars")

    known = components(stars, "contracted").select(F.col("node").alias("rep"), "component")
    signs = signs.select("rep", "sh").join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    active = stage(_groups(signs), "active")
    edges = active.where("component <> b").select(F.col("component").alias("a"), "b").distinct()
    group = components(edges, "groups").select(F.col("node").alias("component"), F.col("component").alias("grp"))
    members = active.select("rep", "component").distinct().join(group, "component")
    members = stage(members.join(sets.select("rep", "shingles"), "rep"), "members")

    per = members.groupBy("grp", "component").agg(F.count("*").alias("n"))
    per = per.groupBy("grp").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main"))
    shards = F.lit(max(1, math.ceil(members.count() / BLOCK)))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(BLOCK))).cast("int")
    per = per.select(
        "grp", F.col("main.component").alias("main"),
        F.when(F.col("n") > BLOCK, F.col("grp")).otherwise(-1 - F.pmod(F.xxhash64("grp"), shards)).alias("task"),
        blocks(F.col("n")).alias("n_index"), blocks(F.col("n") - F.col("main.n")).alias("n_query"))
    placed = members.join(per, "grp")
    deal = lambda n, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = placed.where("component <> main").select(
        "task", deal("n_query", 1).alias("q"), spread("n_index").alias("i"), "rep", "component", "shingles")
    index = placed.select(spread("n_query").alias("q"), deal("n_index", 2).alias("i"),
                          *(F.col(c).alias(c) for c in ("task", "rep", "component", "shingles")))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search_block(left, right, percent)

    found = queries.groupBy("task", "q", "i").cogroup(index.groupBy("task", "q", "i")).applyInArrow(search, "a long, b long")
    return stars.unionAll(found)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = 5, percent: int = 75) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``; see the module for how."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = stage(document_sets(docs, width, percent), "sets")
    same = sets.where("set_key is not null and id is not null").groupBy("set_key").agg(
        F.min("id").alias("rep"), F.first("shingles").alias("shingles"), F.first("signature").alias("signature"))
    same = stage(same, "same_sets")
    links = find_links(same.select("rep", "shingles", "signature"), percent)
    # rows that share an id are one node, whatever their texts
    ids = sets.where("set_key is not null and id is not null").select("id", "set_key").join(
        same.select("set_key", "rep"), "set_key")
    links = links.unionAll(ids.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    found = components(links, "components").select(F.col("node").alias("id"), "component")
    return sets.select("id", "n_shingles").join(found, "id", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"))


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without those whose component has a smaller id; rows without id stay."""
    found = jaccard_components(docs, **options)
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, docs[options.get("id_col", "doc_id")] == gone["doc_id"], "left_anti")
