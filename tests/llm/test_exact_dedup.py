import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrametry.llm import exact_dedup

from .conftest import sha


def expected(rows):
    groups = {}
    for i, text, _ in rows:
        groups.setdefault(text or "", []).append(i)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda i: (i is not None, i), reverse=True):
            out[i, keep, len(ids), first, sha(text)] += 1
            first = False
    return out


def found(df):
    return Counter((r.id, r.keep_id, r.group_size, r.kept, r.digest) for r in df.collect())


@pytest.mark.parametrize("few", [64, 2])
@pytest.mark.parametrize("bits", [63, 2])
def test_groups_equal_brute_force(spark, odd_docs, odd_rows, monkeypatch, few, bits):
    """Also where many texts chain under one key and where most groups count as large."""
    monkeypatch.setattr(exact_dedup, "FEW", few)
    assert found(exact_dedup.exact_groups(odd_docs, bits=bits, capacity=2000)) == expected(odd_rows)


def test_one_group_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FEW", 5)
    rows = [(None if i % 50 == 0 else i // 2, "same" if i % 3 else f"t{i}", None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert found(exact_dedup.exact_groups(docs)) == expected(rows)


def test_directory_splits_only_overfull_buckets(spark):
    rng = random.Random(5)
    texts = spark.createDataFrame([(i, rng.randbytes(rng.choice([5, 40, 400])).hex()) for i in range(600)], "id long, text string")
    signed = exact_dedup.signatures(texts)
    n_bytes = signed.agg(F.sum(F.col("n_bytes") + exact_dedup.ENTRY)).first()[0]
    index = exact_dedup.build_index(texts, signed, 600, n_bytes, capacity=7_000)
    slots = index.directory.collect()
    assert len(slots) <= 2 ** index.depth and len({s.slot for s in slots}) == len(slots)
    assert len({s.local for s in slots}) > 1
    shared = Counter(s.bucket for s in slots)
    assert all(shared[s.bucket] == 2 ** (index.depth - s.local) for s in slots)
    held = index.entries.groupBy("bucket").agg(F.sum(F.col("n_bytes") + exact_dedup.ENTRY).alias("n")).collect()
    deepest = max(s.local for s in slots)
    local = {s.bucket: s.local for s in slots}
    assert sum(1 for _ in held) == len(shared) and all(r.n <= 7_000 or local[r.bucket] == deepest for r in held)
    owners = index.entries.select("bucket", F.spark_partition_id().alias("p")).distinct().groupBy("bucket").count()
    assert index.entries.count() == 600 and owners.where("count > 1").isEmpty()


def test_normalised_texts(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id long, text string")
    out = {r.id: (r.keep_id, r.kept) for r in exact_dedup.exact_groups(docs, normal=F.lower).collect()}
    assert out == {1: (2, False), 2: (2, True), 3: (3, True)}


def test_empty_table(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0 and exact_dedup.without_copies(no_docs).columns == ["doc_id", "digest"]
