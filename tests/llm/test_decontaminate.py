import random
import re
import time
from collections import Counter, defaultdict

import pytest

from terrametry.llm import decontaminate

from .conftest import lowered

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(lowered(text))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[k:k + window])].add("" if item is None else str(item))
    out = []
    for i, text in rows:
        words, hit, found = WORD.findall(lowered(text)), set(), set()
        for k in range(len(words)):
            for n in {len(w) for w in windows}:
                if k + n <= len(words) and tuple(words[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(words[k:k + n])]
        out.append((i, len(words), len(hit), tuple(sorted(found))))
    return Counter(out)


@pytest.fixture
def items(odd_rows):
    texts = [r[1] for r in odd_rows if r[1]]
    part = lambda k, a, b: " ".join(texts[k].split(" ")[a:b])
    return [(10, part(-20, 5, 40)), (2, part(9, 3, 30).upper()), (None, part(9, 3, 30)), (2, part(12, 100, 106)), (7, "one"),
            (8, None), (9, " .. "), (11, "no such words " * 10), (12, part(5, 70, 90) + ", " + part(9, 0, 12)), (7, "one")]


@pytest.mark.parametrize("slice_words", [2_000_000, 20])
def test_hits_equal_brute_force(spark, odd_docs, odd_rows, items, monkeypatch, slice_words):
    monkeypatch.setattr(decontaminate, "SLICE_WORDS", slice_words)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_passages(odd_docs, bench)
    got = Counter((r.doc_id, r.n_words, sum(m["end"] - m["start"] for m in r["matches"]), tuple(r["items"])) for r in found.collect())
    assert got == brute([r[:2] for r in odd_rows], items)
    left = decontaminate.without_passages(odd_docs, bench)
    assert left.columns == odd_docs.columns
    clean = Counter(i for i, n, hit, _ in got.elements() if not hit)
    assert Counter(r.doc_id for r in left.collect()) == clean


def test_longest_match_goes_on_through_windows(spark, odd_rows):
    text = odd_rows[9][1]
    bench = spark.createDataFrame([(1, " ".join(text.split(" ")[20:57]))], "item_id long, text string")
    row = decontaminate.find_passages(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).first()
    assert [(m["start"], m["end"], m["longest"]) for m in row["matches"]] == [(20, 57, 37)]


def test_empty_tables(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_passages(no_docs, none).count() == 0
    assert {len(r["items"]) for r in decontaminate.find_passages(odd_docs, none).collect()} == {0}
    assert decontaminate.without_passages(odd_docs, none).count() == odd_docs.count()


def test_longest_matches_equal_brute_force(spark):
    """On few different words, where many windows chain and many runs nearly do."""
    rng = random.Random(8)
    items = [(i, " ".join(rng.choices("ab", k=rng.randint(3, 60)))) for i in range(12)]
    docs = [(i, " ".join(rng.choices("abc", weights=(8, 8, 1), k=rng.randint(1, 120)))) for i in range(40)]
    found = decontaminate.find_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                                        spark.createDataFrame(items, "item_id long, text string"), window=6).collect()
    texts = dict(items)
    for r in found:
        words = dict(docs)[r.doc_id].split(" ")
        for m in r["matches"]:
            part, own = words[m["start"]:m["end"]], [texts[int(i)].split(" ") for i in r["items"]]
            best = 0
            for item in own:
                for a in range(len(part)):
                    for b in range(len(item)):
                        k = 0
                        while a + k < len(part) and b + k < len(item) and part[a + k] == item[b + k]:
                            k += 1
                        best = max(best, k)
            assert m["longest"] == best


def test_a_long_item_of_one_word_takes_seconds(spark):
    same = " ".join(["same"] * 20_000)
    started = time.time()
    row = decontaminate.find_passages(spark.createDataFrame([(1, same + " x"), (2, "same")], "doc_id long, text string"),
                                      spark.createDataFrame([(1, same)], "item_id long, text string")).where("doc_id = 1").first()
    assert [tuple(m) for m in row["matches"]] == [(0, 20_000, 20_000)] and time.time() - started < 30
