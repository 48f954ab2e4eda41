import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terrametry.llm import lexical

from .conftest import lowered


def terms(text):
    return re.findall(lexical.TERM, lowered(text))


def expected(rows, queries, k):
    counts = [(i, Counter(terms(t))) for i, t, *_ in rows if terms(t)]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for q, text in queries:
        wanted[q] |= set(terms(text))
    out = set()
    for q, own in wanted.items():
        scored = []
        for i, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in own if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out |= {(q, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])}
    return out


@pytest.fixture
def queries(odd_rows):
    long = [t for _, t, _ in odd_rows if t and len(t) > 50]
    return [(1, long[1]), (2, long[5][:200]), (3, "one, ONE; TWO"), (4, None), (5, "..."), (None, "ab é"), (6, long[-1]),
            (6, "x y z"), (7, " ".join(long[3:9])), (8, "l'ê\tIT'S 12345"), (9, "\u0000nul\u0001back")]


@pytest.mark.parametrize("slice_bytes,block", [(1 << 20, 4 << 20), (300, 2000)])
def test_ranks_equal_brute_force(spark, odd_docs, odd_rows, queries, monkeypatch, slice_bytes, block):
    monkeypatch.setattr(lexical, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(lexical, "BLOCK", block)
    items = spark.createDataFrame(queries, "item_id long, text string").withColumn("query", F.lit("other"))
    found = lexical.best_documents(odd_docs, items, 4).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == expected(odd_rows, queries, 4)


def test_only_whole_terms(spark):
    docs = spark.createDataFrame([(1, "cat cat,cat concat cats CAT"), (2, "concatenate"), (3, "é cat cat dog"), (4, "dog")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "Cat")], "item_id string, text string")
    found = lexical.best_documents(docs, items).collect()
    assert [(r.query, r.rank, r.doc_id) for r in found] == [("a", 1, 1)]


def test_nothing_to_search(spark, no_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.best_documents(no_docs, items).count() == 0
    docs = spark.createDataFrame([(1, None), (2, "...")], "doc_id long, text string")
    assert lexical.best_documents(docs, items).count() == 0
    assert lexical.best_documents(docs, items.where("item_id > 1")).columns == ["query", "rank", "doc_id", "score"]
