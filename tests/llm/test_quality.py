import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrametry.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {p for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for p in range(k, k + 5)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def exact_tail(n, k, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


@pytest.mark.parametrize("n, k, p", [(1, 0, 0.02), (200, 0, 0.02), (200, 3, 0.02), (1000, 12, 0.02), (1000, 19, 0.02), (5000, 10, 0.01)])
def test_binomial_tail(spark, n, k, p):
    row = spark.range(1).select(quality.binomial_tail(F.lit(n), F.lit(k), p).alias("x")).first()
    assert row.x == pytest.approx(exact_tail(n, k, p), rel=1e-9)


def test_counts_equal_brute_force(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (5, None), (999, 1)], "doc_id long, quality int")
    found = quality.judge(odd_docs, labels).collect()
    assert Counter((r.doc_id, *(r[c] for c in quality.COUNTS)) for r in found) == Counter((r[0], *counts(r[1])) for r in odd_rows)
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed)


def test_levels_hold_the_promised_rate(spark):
    """Level 2 catches all bad; level 5 would catch no more; a stratum with few labels certifies nothing."""
    rows = [("en", 2, 0, 300), ("en", 5, 40, 0), ("en", 8, 960, 0), ("de", 1, 0, 5), ("de", 8, 20, 0), ("fr", 0, 300, 5), ("fr", 8, 300, 0)]
    counted = spark.createDataFrame(rows, "stratum string, strictness int, n_good long, n_bad long")
    assert dict(map(tuple, quality.certify(counted).collect())) == {"en": 2, "de": -1, "fr": -1}
    least = math.ceil(math.log(0.05 / 3) / math.log(0.98))  # good texts that certify a level at which none is rejected
    for n, level in ((least, 0), (least - 1, -1)):
        few = spark.createDataFrame([("a", 0, 0, 9), ("a", 8, n, 0), ("b", 8, 1, 0), ("c", 8, 1, 0)], counted.schema)
        assert dict(map(tuple, quality.certify(few).collect()))["a"] == level


def test_rejected_rows_go(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality.keep_good(odd_docs, labels)
    judged = quality.judge(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in judged.where("kept").collect())
    assert quality.judge(no_docs, labels).count() == 0 and quality.keep_good(no_docs, labels).count() == 0


@pytest.mark.parametrize("times", [1, 400])
def test_a_repeated_labelled_text_is_one_observation(spark, times):
    """One good text, however often it occurs, certifies no level."""
    good, bad = " ".join(f"word{k}" for k in range(30)), "### $$$ " * 3 + " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, good, "en")] * times + [(2, bad, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert {r.level for r in quality.judge(docs, labels).collect()} == {-1}


def test_kept_with_certified_levels_equals_brute_force(spark):
    """400 good and 60 bad labelled texts, each row present twice: cutoffs, levels and decisions by hand."""
    rng = random.Random(4)
    rows = []
    for i in range(520):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(40)]
        symbols = rng.choice([0, 1]) if i < 430 else rng.randint(8, 60)
        rows.append((i, " ".join(words) + " " + "#" * symbols, "en"))
    labels = [(i, int(i < 430)) for i in range(500)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string")
    judged = quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    strict = {r.doc_id: r.strictness for r in judged}
    n_good = sum(g for _, g in labels)
    certified, gains = [], []
    for level in range(quality.N_LEVELS):
        out = [sum(strict[i] <= level for i, g in labels if g == want) for want in (1, 0)]
        if out[0] >= n_good * quality.ALPHA or exact_tail(n_good, out[0], quality.ALPHA) > quality.DELTA:
            break
        certified.append(level)
        gains.append(out[1] - quality.GOOD_WEIGHT * out[0])
    best = certified[gains.index(max(gains))] if certified and max(gains) > 0 else -1
    assert best >= 0 and {r.level for r in judged} == {best}
    assert all(r.kept == (not r.base_failed and r.strictness > best) for r in judged) and not all(r.kept for r in judged)
    kept = quality.keep_good(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in judged if r.kept)
