"""Ranked lexical search: a document scan by an Aho-Corasick automaton of all query terms.

Terms are runs of digits, letters and non-ASCII characters, only A-Z lower-cased. Texts
are read once and never indexed: other characters become blanks, and the automaton's
words are the query terms between two blanks as guards, so that only whole terms match.
What it puts out counts each term's occurrences, and is kept per block of documents beside
the sums over the corpus. A second, small pass weighs the counts once these sums
are known; each task keeps the best ``k`` documents of every query, and the best of
those of all tasks remain.

Queries come in slices of some ``SLICE_BYTES`` of terms (a longer query stays whole); a slice
is broadcast, its results are written to the shared folder, and the next slice follows.

    m     = 100 - 90 + (90 n N) div L        n terms in the document, L in all N that have terms
    w     = floor(1000 ln((2 N + 2) / (2 df + 1)))
    score = sum of w ((10^9 tf) div (1000 tf + 8 m)) over the query's different terms

Null and empty texts hold no term: such documents do not count and match nothing, such
queries have no rows. Queries that share an id, or have none, are one query with the terms of
all. Repeated document rows are ranked one by one. Equal scores come by ascending document
id, none last. Without documents or queries there are no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import stage
from .bytesets import ALPHANUMERIC, LOWER, pieces

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms, guards included, that one broadcast holds on average.
SLICE_BYTES = 1 << 20
#: Bytes of text whose counts make one row.
BLOCK = 4 << 20

_GUARDED = np.where(ALPHANUMERIC, LOWER, np.uint8(0x20)).astype(np.uint8).tobytes()
#: Stands between documents; no term and no blank.
_BREAK = "\x01"
BLOCKS = ("ids array<long>, lengths array<long>, sizes array<int>, terms binary, tfs binary, "
          "n_docs long, n_terms long, df_terms array<int>, dfs array<long>")


def terms_of(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(TERM), F.lit(0))


class Queries:
    """A slice of queries: their terms, and the places of each query's terms."""

    def __init__(self, rows: pa.Table) -> None:
        coded = rows["term"].combine_chunks().dictionary_encode()
        self.terms: list[str] = coded.dictionary.to_pylist()
        query = rows["query"].combine_chunks().dictionary_encode(null_encoding="encode")
        self.ids = query.dictionary
        of = query.indices.to_numpy()
        order = np.argsort(of, kind="stable")
        self.places = np.split(coded.indices.to_numpy()[order], np.flatnonzero(np.diff(of[order])) + 1)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for place, term in enumerate(self.terms):
            found.add_word(f" {term} ", place)
        found.add_word(_BREAK, -1)
        found.make_automaton()
        return found


def _counted(automaton, texts: pa.ChunkedArray) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of each text; number of its different query terms; these, and how often each occurs."""
    guarded = [(t or "").encode("utf-8", "surrogatepass").translate(_GUARDED) for t in texts.to_pylist()]
    whole = b" " + f" {_BREAK} ".encode().join([*guarded, b""])
    out = np.fromiter((place for _, place in automaton.iter(whole.decode("utf-8", "replace"))), np.int64)
    ends = out < 0
    doc = np.cumsum(ends) - ends
    n = max(1, len(automaton))
    keys, tfs = np.unique((doc * n + out)[~ends], return_counts=True)
    return [len(t.split()) for t in guarded], np.bincount(keys // n, minlength=len(guarded)), keys % n, tfs


def _scan(shared):
    def scan(batches):
        automaton = shared.value.automaton()
        n_docs = n_terms = 0
        df = np.zeros(len(shared.value.terms), np.int64)
        for batch in batches:
            for table in pieces(batch, "text", BLOCK):
                lengths, sizes, terms, tfs = _counted(automaton, table["text"])
                df += np.bincount(terms, minlength=len(df))
                n_docs += sum(n > 0 for n in lengths)
                n_terms += sum(lengths)
                yield pa.RecordBatch.from_pylist([{
                    "ids": table["id"].to_pylist(), "lengths": lengths, "sizes": sizes.tolist(),
                    "terms": terms.astype(np.uint32).tobytes(), "tfs": tfs.astype(np.uint32).tobytes()}], schema=_ARROW)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_pylist([{
            "n_docs": n_docs, "n_terms": n_terms, "df_terms": seen.tolist(), "dfs": df[seen].tolist()}], schema=_ARROW)
    return scan


_ARROW = pa.schema([
    ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("terms", pa.binary()),
    ("tfs", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("df_terms", pa.list_(pa.int32())), ("dfs", pa.list_(pa.int64()))])


class _Best:
    """The best documents of one query so far, best first."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.absent, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, absent: np.ndarray, ids: np.ndarray) -> None:
        least = self.score[-1] if len(self.score) == self.k else 1
        new = np.flatnonzero(score >= max(1, least))
        if not len(new):
            return
        score, absent, ids = (np.concatenate(two) for two in (
            (self.score, score[new]), (self.absent, absent[new]), (self.id, ids[new])))
        order = np.lexsort((ids, absent, -score))[:self.k]
        self.score, self.absent, self.id = score[order], absent[order], ids[order]


def _impacts(row: dict, weights: np.ndarray, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, impact) of all counts of a block by term, and where each term's begin."""
    terms, tfs = np.frombuffer(row["terms"], np.uint32).astype(np.int64), np.frombuffer(row["tfs"], np.uint32).astype(np.int64)
    m = 100 - 90 + (90 * np.array(row["lengths"], np.int64) * n_docs) // max(1, n_terms)
    doc = np.repeat(np.arange(len(m)), row["sizes"])
    impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc]))
    order = np.argsort(terms, kind="stable")
    return doc[order], impact[order], np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(weights)))])


def _scores(places: np.ndarray, doc: np.ndarray, impact: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    size = begin[places + 1] - begin[places]
    at = np.arange(int(size.sum())) + np.repeat(begin[places] - (np.cumsum(size) - size), size)
    high, low = impact[at] >> 24, impact[at] & 0xFFFFFF  # sums of doubles are exact this way
    return (np.bincount(doc[at], high, n).astype(np.int64) << 24) + np.bincount(doc[at], low, n).astype(np.int64)


def _rank(shared, weights, n_docs: int, n_terms: int, k: int, kind: pa.DataType):
    def rank(batches) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best = [_Best(k) for _ in queries.places]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                doc, impact, begin = _impacts(row, weights.value, n_docs, n_terms)
                ids = np.array([0 if x is None else x for x in row["ids"]], np.int64)
                absent = np.array([x is None for x in row["ids"]], bool)
                for one, places in zip(best, queries.places):
                    one.add(_scores(places, doc, impact, begin, len(ids)), absent, ids)
        for place, one in enumerate(best):
            n = len(one.score)
            yield pa.RecordBatch.from_arrays([
                queries.ids.take(pa.array([place] * n, pa.int64())).cast(kind),
                pa.array(one.id, pa.int64(), mask=one.absent), pa.array(one.score, pa.int64())], ["query", "doc_id", "score"])
    return rank


def _slices(wanted: DataFrame) -> Iterator[DataFrame]:
    n_bytes = wanted.agg(F.sum(F.octet_length("term") + 2)).first()[0] or 0
    n = math.ceil(n_bytes / SLICE_BYTES)
    for part in range(n):
        yield wanted.where(F.pmod(F.xxhash64("query"), F.lit(n)) == part)


def best_documents(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   query_col: str = "item_id", query_text: str = "text") -> DataFrame:
    """(query, rank, doc_id, score): the ``k`` best documents of each query, from rank 1 on."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = stage(queries.select(F.col(query_col).alias("query"), F.explode(terms_of(F.col(query_text))).alias("term")).distinct(), "terms")
    schema = T.StructType([wanted.schema["query"], T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = spark.createDataFrame([], schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for part in _slices(wanted):
        rows = part.toArrow()  # bounded by the slice
        if not rows.num_rows:
            continue
        chosen = Queries(rows)
        shared = spark.sparkContext.broadcast(chosen)
        blocks = stage(texts.mapInArrow(_scan(shared), BLOCKS), "term_counts")
        n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        pairs = blocks.select(F.explode(F.arrays_zip("df_terms", "dfs")).alias("p"))
        df = pairs.groupBy("p.df_terms").agg(F.sum("p.dfs").alias("df")).toArrow()  # one row for each term of the slice
        weight = np.zeros(len(chosen.terms), np.int64)
        weight[df["df_terms"].to_numpy()] = [
            math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df["df"].to_pylist()]
        weights = spark.sparkContext.broadcast(weight)
        scored = blocks.where("ids IS NOT NULL").select(*BLOCK_COLUMNS).mapInArrow(
            _rank(shared, weights, n_docs or 0, n_terms or 0, k, rows.schema.field("query").type), schema)
        best = stage(scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank"), "ranked")
        found = found.unionAll(best)
        for sent in (shared, weights):
            sent.unpersist()
    return found.select("query", F.row_number().over(order).alias("rank"), "doc_id", "score")


BLOCK_COLUMNS = ("ids", "lengths", "sizes", "terms", "tfs")
