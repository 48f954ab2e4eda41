import random
from collections import Counter

import pytest

from terrametry.llm import suffix_dedup

from .conftest import sha


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = [k for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])]
        out.append((i, len(b), sum(gone), len(spans), sha(bytes(c for c, g in zip(b, gone) if not g))))
    return Counter(out)


def answer(df):
    return Counter((r.doc_id, r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), len(r.spans), sha(bytes(r.kept))) for r in df.collect())


@pytest.mark.parametrize("frequent", [4096, 1])
@pytest.mark.parametrize("length", [200, 40])
def test_removal_equals_brute_force(odd_docs, odd_rows, monkeypatch, frequent, length):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    assert answer(suffix_dedup.remove_repeats(odd_docs, length=length)) == brute([r[:2] for r in odd_rows], length)


def test_short_strings_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SLICE", 64)
    rng = random.Random(4)
    rows = [(k, "".join(rng.choices("ab", k=rng.randint(0, 300)))) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(suffix_dedup.remove_repeats(docs, length=12)) == brute(rows, 12)


def test_two_stage_order_is_the_sorted_order():
    import numpy as np

    rng = random.Random(2)
    for _ in range(100):
        segments = [bytes(rng.choices(range(rng.choice([1, 2, 3, 256])), k=rng.randint(5, 30))) for _ in range(6)]
        size = np.array([len(s) for s in segments])
        order = suffix_dedup.two_stage_order(b"".join(segments), size, size, 50).tolist()
        ends = np.cumsum(size)
        suffix = lambda i: b"".join(segments)[i:ends[np.searchsorted(ends, i, "right")]]  # noqa: B023, E731
        assert sorted(order) == list(range(ends[-1]))
        assert [suffix(i) for i in order] == sorted(map(suffix, order))


def test_repeated_windows_equal_counts():
    rng = random.Random(1)
    for _ in range(100):
        length = rng.choice([3, 5, 8])
        segments = list({bytes(rng.choices(range(rng.choice([1, 2, 4, 256])), k=rng.randint(length, 40))) for _ in range(8)})
        counts = Counter(s[k:k + length] for s in segments for k in range(len(s) - length + 1))
        want = [[counts[s[k:k + length]] > 1 for k in range(len(s) - length + 1)] for s in segments]
        assert [w.tolist() for w in suffix_dedup.repeated_windows(segments, length)] == want


def test_empty_table(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
