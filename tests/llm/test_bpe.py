import time
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from terrametry.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("chunk", [4 << 20, 500])
def test_ids_and_texts_equal_the_library(spark, odd_docs, odd_rows, monkeypatch, chunk):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "CHUNK", chunk)
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text, _ in odd_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[i, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    found = bpe.decode(bpe.encode(odd_docs, PATH), PATH)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found.collect()) == want
    at_once = bpe.encode(odd_docs, PATH, decoded="again").collect()
    assert Counter((r.doc_id, tuple(r.ids), r.again) for r in at_once) == want


def test_decoding_of_broken_ids(spark):
    from tokenizers import Tokenizer

    rows = [(1, [160, 50256]), (2, []), (3, None), (4, [99999, 64])]
    found = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()
    text = {r.doc_id: r.decoded for r in found}
    assert text[1] == Tokenizer.from_file(PATH).decode([160, 50256], skip_special_tokens=False)
    assert text[2] == text[3] == "" and text[4] == "a"


def test_empty_table(no_docs):
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0


def test_other_rows_on_the_second_reading_stop_the_job(spark):
    """As many rows and words, but other ones: each reading sees texts of its own."""
    changing = F.udf(lambda i: str(time.time_ns() % 10**7 + i).zfill(8)).asNondeterministic()
    docs = spark.range(0, 300, 1, 2).select(F.col("id").alias("doc_id"), changing("id").alias("text"))
    with pytest.raises(Exception, match="another order"):
        bpe.encode(docs, PATH).collect()
