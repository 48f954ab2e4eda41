import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F, types as T

VOWELS = ["th", "re", "an", "on", "er", "in", "es", "ou", "ti", "ha", "ê", "ß"]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n):
    return " ".join("".join(rng.choices(VOWELS, k=rng.randint(1, 4))) for _ in range(n))


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(3)
    passage, base = prose(rng, 60), prose(rng, 120)
    texts = [None, "", "  \n\t ", "one", "One", "a b c d", prose(rng, 30_000), "ab" * 400, "x" * 5000]
    texts += [base] * 4 + [base.replace("th", "TH", k) for k in range(3)]
    for k in range(12):
        words = base.split(" ")
        words[10 * k] = f"new{k}"
        texts.append(" ".join(words))
    texts += [prose(rng, rng.randint(5, 200)) + " " + passage + "\n" + prose(rng, 40) for _ in range(8)]
    texts += [prose(rng, rng.randint(10, 80)) for _ in range(30)]
    texts += ["### <b>$$$ " * 20, "I'm  here\n\n it's 'll <|endoftext|>  x   12345 \U0001F600!!", "\u0000 nul \\ back"]
    rows = [(i, t, rng.choice(["en", "fr", None])) for i, t in enumerate(texts)]
    return rows + [(None, base, "en"), (None, None, None), rows[3], rows[12]]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with further columns named like inner ones."""
    clash = ("id", "batch", "size", "words", "matches", "items", "n_words", "stratum", "text_hash", "score", "rep", "spans", "kept")
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3, F.xxhash64("text")).withColumns({c: F.lit("other") for c in clash})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
