import random
from collections import Counter

import pytest

from terrametry.llm import jaccard
from terrametry.llm.components import components

from .conftest import lowered, prose


def brute(rows, width=5, percent=75):
    sets = []
    for _, text in rows:
        words = lowered(text).replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        windows = [tuple(words[k:k + width]) for k in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        sets.append(set(windows))
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, _), s in zip(rows, sets):
        for (j, _), t in zip(rows, sets):
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return Counter((i, len(s), root(i) if i is not None else None) for (i, _), s in zip(rows, sets))


@pytest.mark.parametrize("block", [1000, 3])
def test_components_equal_brute_force(spark, odd_docs, odd_rows, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "CONTRACT", block)
    found = jaccard.jaccard_components(odd_docs.select("doc_id", "text", "id", "batch"))
    assert Counter(map(tuple, found.collect())) == brute([r[:2] for r in odd_rows])


def test_chains_of_near_copies(spark, monkeypatch):
    """Each text is near the next only, so that a group's smallest member links few."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "CONTRACT", 4)
    rng = random.Random(5)
    words, rows = prose(rng, 60).split(" "), []
    for k in range(16):
        words = words[4:] + prose(rng, 4).split(" ")
        rows.append((k, " ".join(words)))
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_list_index_finds_just_the_similar_sets():
    import numpy as np

    rng = random.Random(9)
    sets = []
    for _ in range(60):
        if sets and rng.random() < 0.6:
            s = set(rng.choice(sets))
            for _ in range(rng.randint(0, 6)):
                s.discard(rng.randint(0, 80))
                s.add(rng.randint(0, 80))
        else:
            s = set(rng.sample(range(80), rng.randint(1, 40)))
        sets.append(sorted(s))
    index = jaccard.ListIndex([np.array(s, np.uint64) for s in sets])
    for s in sets:
        want = [k for k, t in enumerate(sets) if 100 * len({*s} & {*t}) >= 75 * len({*s} | {*t})]
        assert sorted(index.search(np.array(s, np.uint64), 75)) == want


def test_one_of_each_group_stays(spark, odd_docs, odd_rows):
    kept = jaccard.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    want = Counter(i for (i, _, c), n in brute([r[:2] for r in odd_rows]).items() for _ in range(n) if i is None or c == i)
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_empty_table(no_docs):
    assert jaccard.jaccard_components(no_docs).count() == 0


def test_components_of_paths_and_loops(spark):
    edges = [(k, k + 1) for k in range(20)] + [(30, 30), (40, 41), (41, 40), (50, 45), (45, 47)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{k: 0 for k in range(21)}, 40: 40, 41: 40, 45: 45, 47: 45, 50: 45}
