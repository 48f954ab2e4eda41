"""Toxicity scores by a small convolutional network over hashed words.

A text's words (A-Z lower-cased) are hashed to rows of an embedding table, and so are their
first 4 and 6 bytes, since inflected words share their stem; a word is the sum of its rows. Filters of
widths 1, 2 and 3 run over the words, each filter's largest value over the whole text is
kept, and a logistic layer scores these. Every labelled text takes part. Three quarters train,
dealt by a hash of their id into shards of some ``SHARD`` texts: in each epoch every shard trains on
from the common network in a task of its own, and the shards' networks are averaged by a shuffle, an
embedding row over the shards that touched it. One shard is plain training. The last quarter
sets one threshold for each language, the exact best over all its texts. The language of a text is
read off its words (``FUNCTION_WORDS``), never from a column; a language with too few
labelled texts takes the threshold of all.

Scores are probabilities moved so that 0.5 is the language's threshold. Null and empty
texts have no words and score as such. Repeated rows score alike. Labels without id or
value, or without document, are ignored; of an id's labels the largest counts. Without labels of both kinds every text
scores below 0.5. An empty table gives no rows.
"""

from __future__ import annotations

import copy
import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path, stage
from .bytesets import ALPHANUMERIC, LOWER, joined, pieces, word_hashes, word_spans

BUCKETS, STEM_BUCKETS, STEMS = 1 << 15, 1 << 14, (4, 6)
WIDTH, FILTERS, WIDTHS = 12, 12, (1, 2, 3)
#: Training texts that one task takes.
SHARD = 9_000
#: Training texts that one row packs, and rows that an Arrow batch brings to a task: neither grows with the shard.
PIECE, SENT = 250, 4
#: Embedding rows averaged together, and slices of a logit between whose ends one window runs.
ROWS, SLICES = 1 << 10, 64
#: Words of 64 bits by which documents without a label are told before their texts move.
MARKS = 1 << 20
EPOCHS, BATCH, SEED = 6, 32, 7
LEAST_LABELLED = 60
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BITS = 20
_PLACES = np.arange(0, _BITS * (1 + len(STEMS)), _BITS)
_PAD, _GAP, _BLOCK = BUCKETS + len(STEMS) * STEM_BUCKETS, max(WIDTHS) - 1, 1 << 15

# Frequent function words by which the languages of the texts are told apart.
FUNCTION_WORDS = {
    "en": "the of and to is that it for with was this by are be as he",
    "fr": "le les des et dans du une qui est au sur pas il par pour aux",
    "de": "der die das und von zu den mit ist ein eine nicht im auf dem sich",
    "es": "el los las del y por con para se su como una lo al sus más",
}


def fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5))


def word_buckets(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of every word - its own and those of its stems - and where each text's words begin."""
    buf, begins = joined(texts)
    buf = LOWER[buf]
    starts, ends = word_spans(buf, ALPHANUMERIC)
    rows = np.full((len(starts), 1 + len(STEMS)), _PAD, np.int32)
    rows[:, 0] = word_hashes(buf, starts, ends) % np.uint64(BUCKETS)
    for k, n in enumerate(STEMS):
        long = np.flatnonzero(ends - starts >= n)
        stem = word_hashes(buf, starts[long], starts[long] + n) % np.uint64(STEM_BUCKETS)
        rows[long, k + 1] = stem.astype(np.int32) + BUCKETS + k * STEM_BUCKETS
    return rows, np.searchsorted(starts, begins)


def _language_of_bucket() -> np.ndarray:
    out = np.zeros(BUCKETS, np.int64)
    for i, words in enumerate(FUNCTION_WORDS.values()):
        out[word_buckets(pa.array([words]))[0][:, 0]] = i + 1
    return out


def languages(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of each text's language from 1, 0 if none of its words tells."""
    n, kinds = len(first) - 1, len(FUNCTION_WORDS) + 1
    doc = np.repeat(np.arange(n), np.diff(first))
    counts = np.bincount(doc * kinds + _language_of_bucket()[rows[:, 0]], minlength=n * kinds).reshape(n, kinds)
    counts[:, 0] = 0
    return counts.argmax(1)


def _padded(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with gaps after them, which no filter sees beyond; where each begins."""
    n = len(first) - 1
    out = np.full((len(rows) + n * _GAP, rows.shape[1]), _PAD, np.int32)
    out[np.arange(len(rows)) + np.repeat(np.arange(n), np.diff(first)) * _GAP] = rows
    return out, first[:-1] + np.arange(n) * _GAP


def _with_gap(ids: np.ndarray) -> np.ndarray:
    return np.concatenate([ids, np.full((_GAP, ids.shape[1]), _PAD, ids.dtype)])


@dataclass
class Network:
    """Parameters; filter ``w`` words wide has one matrix for each of its words."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    constant: float
    thresholds: np.ndarray

    @classmethod
    def fresh(cls) -> Network:
        random = np.random.RandomState(SEED)
        embedding = random.normal(0, 0.05, (_PAD + 1, WIDTH)).astype(np.float32)
        embedding[_PAD] = 0
        filters = [random.normal(0, 0.5 / np.sqrt(w), (w, WIDTH, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return cls(embedding, filters, np.zeros(n, np.float32), random.normal(0, 0.3, n).astype(np.float32), 0.0,
                   np.zeros(len(FUNCTION_WORDS) + 1))

    def word_table(self) -> np.ndarray:
        """What each word adds to each place of each filter; with it a text is scored by look-ups alone."""
        return np.concatenate([self.embedding @ m for f in self.filters for m in f], 1)

    def pooled(self, rows: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Largest value of every filter over each text, a block of words at a time."""
        ids, begin = _padded(rows, first)
        n, ids = len(ids), _with_gap(ids)
        out = np.full((len(begin), len(self.bias)), -np.inf, np.float32)
        for lo in range(0, n, _BLOCK):
            hi = min(n, lo + _BLOCK)
            part = table[ids[lo:hi + _GAP, 0]]
            for k in range(1, ids.shape[1]):
                part += table[ids[lo:hi + _GAP, k]]
            a = int(np.searchsorted(begin, lo, "right")) - 1
            cut = np.maximum(begin[a:int(np.searchsorted(begin, hi))], lo) - lo
            column = 0
            for i, w in enumerate(WIDTHS):
                value = part[:hi - lo, column:column + FILTERS].copy()
                for j in range(1, w):
                    at = column + j * FILTERS
                    value += part[j:j + hi - lo, at:at + FILTERS]
                column += w * FILTERS
                best, own = np.maximum.reduceat(value, cut, axis=0), slice(i * FILTERS, (i + 1) * FILTERS)
                out[a:a + len(cut), own] = np.maximum(out[a:a + len(cut), own], best)
        return np.maximum(out + self.bias, 0)

    def logits(self, rows: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
        return self.pooled(rows, first, table) @ self.weights + self.constant

    def scores(self, rows: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
        x = self.logits(rows, first, table) - self.thresholds[languages(rows, first)]
        return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -50, 50)))


def _gradient(net: Network, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray):
    """Gradients of the weighted logistic loss; only the places that hold a largest value take part."""
    first = np.cumsum([0, *map(len, texts)])
    ids, begin = _padded(np.concatenate(texts), first)
    ends = np.append(begin[1:], len(ids))
    n, ids = len(ids), _with_gap(ids)
    x = net.embedding[ids].sum(1)
    top, place = [], []
    for f in net.filters:
        value = sum(x[j:j + n] @ m for j, m in enumerate(f))
        at = np.stack([value[a:b].argmax(0) + a for a, b in zip(begin, ends)])
        place.append(at)
        top.append(np.take_along_axis(value, at, 0))
    raw = np.concatenate(top, 1) + net.bias
    features = np.maximum(raw, 0)
    p = 1 / (1 + np.exp(-np.clip(features @ net.weights + net.constant, -30, 30)))
    d = ((p - labels) * weight / len(labels)).astype(np.float32)
    back = d[:, None] * net.weights * (raw > 0)
    of_filters, of_words, rows = [], [], []
    for i, (f, at) in enumerate(zip(net.filters, place)):
        g = back[:, i * FILTERS:(i + 1) * FILTERS]
        of_filters.append(np.stack([np.einsum("df,dfe->ef", g, x[at + j]) for j in range(len(f))]))
        for j, m in enumerate(f):
            own = (g[:, :, None] * m.T[None]).reshape(-1, WIDTH)
            for k in range(ids.shape[1]):
                rows.append(ids[at + j, k].ravel())
                of_words.append(own)
    return of_filters, back.sum(0), features.T @ d, float(d.sum()), np.concatenate(rows), np.concatenate(of_words)


@dataclass
class Training:
    """A network and the sums of squared gradients by which Adagrad shortens its steps."""

    net: Network
    seen: list[np.ndarray]
    words: np.ndarray

    @classmethod
    def fresh(cls) -> Training:
        net = Network.fresh()
        seen = [np.full_like(v, 1e-6) for v in (*net.filters, net.bias, net.weights)] + [np.full(1, 1e-6)]
        return cls(net, seen, np.full(_PAD + 1, 1e-6, np.float32))

    def _dense(self) -> list[np.ndarray]:
        return [*self.net.filters, self.net.bias, self.net.weights, *self.seen]

    def parts(self, touched: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """(part, ids, values): touched embedding rows with their sums by blocks of ``ROWS``, all else as part -1."""
        dense = np.concatenate([np.array([self.net.constant]), *(v.ravel().astype(np.float64) for v in self._dense())])
        yield -1, np.zeros(1, np.int32).tobytes(), dense.tobytes()
        for own in np.split(touched, np.flatnonzero(np.diff(touched // ROWS)) + 1):
            if len(own):
                values = np.concatenate([self.net.embedding[own], self.words[own, None]], 1)
                yield int(own[0]) // ROWS, own.astype(np.int32).tobytes(), values.astype(np.float32).tobytes()

    def take(self, ids: np.ndarray, values: np.ndarray, part: int) -> None:
        """Put averaged values in their places."""
        if part >= 0:
            values = values.reshape(len(ids), WIDTH + 1)
            self.net.embedding[ids], self.words[ids] = values[:, :WIDTH], values[:, WIDTH]
            return
        self.net.constant, at = float(values[0]), 1
        for v in self._dense():
            v[...] = values[at:at + v.size].reshape(v.shape)
            at += v.size


def _kind(part: int) -> type:
    return np.float32 if part >= 0 else np.float64


def train_epoch(now: Training, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, positive: np.float32, epoch: int) -> np.ndarray:
    """One pass of Adagrad in place; positives and negatives weigh alike in sum. Embedding rows that it touched."""
    net, seen, sums = now.net, now.seen, now.words
    weight = np.where(labels == 1, 0.5 / positive, 0.5 / (1 - positive))
    random = np.random.RandomState(SEED)
    for _ in range(epoch + 1):
        order = random.permutation(len(texts))
    touched = np.zeros(_PAD + 1, bool)
    for i in range(0, len(order), BATCH):
        own = order[i:i + BATCH]
        of_filters, of_bias, of_weights, of_constant, rows, of_words = _gradient(
            net, [kinds[words] for words, kinds in (texts[k] for k in own)], labels[own], weight[own])
        for f, g, s in zip(net.filters, of_filters, seen):
            s += g * g
            f -= 0.03 * g / np.sqrt(s)
        for value, g, s in ((net.bias, of_bias, seen[-3]), (net.weights, of_weights, seen[-2])):
            s += g * g
            value -= 0.03 * g / np.sqrt(s)
        seen[-1] += of_constant ** 2
        net.constant -= float(0.03 * of_constant / np.sqrt(seen[-1][0]))
        different, at = np.unique(rows, return_inverse=True)
        g = np.zeros((len(different), WIDTH), np.float32)
        np.add.at(g, at, of_words)
        sums[different] += (g * g).sum(1)
        net.embedding[different] -= 0.1 * g / np.sqrt(sums[different])[:, None]
        net.embedding[_PAD] = 0
        touched[different] = True
    return np.flatnonzero(touched)


def _numbered(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word rows as one number each, and each word's place among them in as few bytes as do."""
    kinds, at = np.unique(rows.astype(np.int64) @ (np.int64(1) << _PLACES), return_inverse=True)
    return kinds, at.astype(_number(len(kinds)))


def _number(kinds: int) -> type:
    return np.uint16 if kinds <= 1 << 16 else np.uint32


_PACKED = "fitting boolean, shard int, piece int, n long, n_positive double, least int, most int, ids binary, labels binary, ends binary, kinds binary, words binary"
_ARRAYS = ("ids", "labels", "ends", "kinds", "words")


def _pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the texts of a piece, or for each 4 MB of them."""
    for batch in batches:
        for part in pieces(batch, "text"):
            words, first = word_buckets(part["text"])
            kinds, number = _numbered(words)
            ids, labels = part["id"].to_numpy(), part["label"].to_numpy()
            row = {"fitting": key[0].as_py(), "shard": key[1].as_py(), "piece": key[2].as_py(), "n": len(ids),
                   "n_positive": float(labels.sum()), "least": int(labels.min()), "most": int(labels.max()),
                   "ids": ids.astype(np.int64).tobytes(), "labels": labels.astype(np.int32).tobytes(),
                   "ends": first[1:].astype(np.int64).tobytes(), "kinds": kinds.tobytes(), "words": number.tobytes()}
            yield from pa.Table.from_pylist([row], pa.schema([
                ("fitting", pa.bool_()), ("shard", pa.int32()), ("piece", pa.int32()), ("n", pa.int64()), ("n_positive", pa.float64()),
                ("least", pa.int32()), ("most", pa.int32()), *((c, pa.binary()) for c in _ARRAYS)])).to_batches()


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Ids, labels and numbered words of a row's texts, in order of ids, and the word rows by number."""
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int32).astype(np.float32)
    kinds, ends = np.frombuffer(row["kinds"], np.int64), np.frombuffer(row["ends"], np.int64)
    words = np.frombuffer(row["words"], _number(len(kinds)))
    begins, order = np.concatenate([[0], ends[:-1]]), np.argsort(ids)
    kinds = (kinds[:, None] >> _PLACES & (1 << _BITS) - 1).astype(np.int32)
    return ids[order], labels[order], [words[begins[k]:ends[k]] for k in order], kinds


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(len(batch)):
            yield {c: batch.column(c)[k].as_buffer() for c in _ARRAYS}


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Ids and labels of all texts, and each text's numbered words with the word rows by number, in order of ids."""
    ids, labels, texts = [], [], []
    for some, own, words, kinds in map(_unpacked, _rows(batches)):
        ids.append(some)
        labels.append(own)
        texts += [(w, kinds) for w in words]
    ids = np.concatenate(ids)
    order = np.argsort(ids)
    return ids[order], np.concatenate(labels)[order], [texts[k] for k in order]


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of some ``SENT`` rows for the jobs run inside, as the rows are large."""
    old = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, SENT)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, old)


def _labelled_shards(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """All labelled texts outside the held-out fold, a row for each piece of a shard.

    They are files in buckets by shard, so that an epoch brings a shard's rows together without a shuffle. Their
    table's name serves to read them as such and is dropped at once; the files stay in the scratch folder.
    """
    key = F.col(id_col).cast("long").alias("id")
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col) != 0)).groupBy(key).agg(
        F.max(label_col).cast("int").alias("label"))
    shards = max(1, math.ceil(known.where(fold("id") != 4).count() / SHARD))
    # a bit for each labelled id, of bounded size: it keeps most other texts out of the shuffle, and the join is exact
    mark, bit = F.pmod(F.xxhash64("id"), F.lit(MARKS)).alias("mark"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id, {MARKS}), 64) AS int))")
    marks = known.groupBy(mark).agg(F.bit_or(bit).alias("bits"))
    texts = docs.select(key, F.col(text_col).alias("text")).where("id IS NOT NULL").withColumn("mark", mark)
    texts = texts.join(F.broadcast(marks), "mark").where(F.col("bits").bitwiseAND(bit) != 0)
    # one text for each id, folded in the input tasks, so that a repeated id does not gather its rows
    texts = texts.groupBy("id").agg(F.min("text").alias("text"))
    fitting = fold("id") != 4
    many = F.when(fitting, math.ceil(SHARD / PIECE)).otherwise(math.ceil(SHARD / 3 / PIECE))
    rows = texts.join(known, "id").select(
        fitting.alias("fitting"), F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        F.pmod(F.xxhash64("id", F.lit("piece")), many).cast("int").alias("piece"), "id", "label", "text")
    packed = rows.repartition(2 * shards, "fitting", "shard").groupBy("fitting", "shard", "piece").applyInArrow(_pack, _PACKED)
    spark, name = docs.sparkSession, f"labelled_shards_{uuid.uuid4().hex}"
    # pages of few rows, as the rows are large
    packed.write.format("parquet").bucketBy(2 * shards, "fitting", "shard").option("path", scratch_path(spark, "labelled-shards")).option(
        "parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 1).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def _averaged(table: pa.Table) -> pa.Table:
    """Mean of one part over the shards that hold it, weighted by their texts; of an embedding row, over those that touched it."""
    part, rows = table["part"][0].as_py(), sorted(table.to_pylist(), key=lambda r: r["shard"])
    width = WIDTH + 1 if part >= 0 else len(rows[0]["own"]) // 8
    ids, at = np.unique(np.concatenate([np.frombuffer(r["ids"], np.int32) for r in rows]), return_inverse=True)
    weight = np.repeat([float(r["n"]) for r in rows], [len(r["ids"]) // 4 for r in rows])
    total, weights = np.zeros((len(ids), width)), np.zeros(len(ids))
    np.add.at(total, at, np.concatenate([np.frombuffer(r["own"], _kind(part)).reshape(-1, width) for r in rows]) * weight[:, None])
    np.add.at(weights, at, weight)
    return pa.table({"part": pa.array([part], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
                     "own": pa.array([(total / weights[:, None]).astype(_kind(part)).tobytes()], pa.binary())})


def train(shards: DataFrame, positive: np.float32) -> Network:
    """A network fitted to all rows of :func:`_labelled_shards`; a job for each epoch."""
    now, context = Training.fresh(), shards.sparkSession.sparkContext
    for epoch in range(EPOCHS):
        shared = context.broadcast(now)

        def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, labels, texts = _gathered(batches)
            mine = copy.deepcopy(shared.value)
            touched = train_epoch(mine, texts, labels, positive, epoch)
            found = [(key[1].as_py(), len(texts), *part) for part in mine.parts(touched)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*found), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                ["shard", "n", "part", "ids", "own"])

        trained = shards.select("fitting", "shard", *_ARRAYS).groupBy("fitting", "shard").applyInArrow(
            run, "shard int, n long, part int, ids binary, own binary")
        with _small_batches(shards.sparkSession):
            table = trained.groupBy("part").applyInArrow(_averaged, "part int, ids binary, own binary").toArrow()  # one network
        for part, ids, own in zip(*(table[c].to_pylist() for c in ("part", "ids", "own"))):
            now.take(np.frombuffer(ids, np.int32), np.frombuffer(own, _kind(part)), part)
        shared.destroy()
    return now.net


def best_thresholds(scored: DataFrame) -> DataFrame:
    """(spoken, threshold, n, least, most) of rows ``(spoken, id, logit, label)``, for each ``spoken``.

    The threshold lies midway between the neighbours, in order of logit and id, where fewest texts fall on
    the wrong side; of several such places, midway between those of the first and the last. Sums run
    within slices of the logits and over the slices, so no task holds all texts of a language.
    """
    logit = F.col("logit").cast("double")
    rows = scored.select("spoken", "id", logit.alias("logit"), "label", F.floor(logit * SLICES).alias("slice"),
                         F.when(F.col("label") == 1, 1).when(F.col("label") == 0, -1).otherwise(0).cast("long").alias("step"))
    over = Window.partitionBy("spoken").orderBy("slice")
    slices = rows.groupBy("spoken", "slice").agg(F.sum("step").alias("steps"), F.min("logit").alias("low")).select(
        "spoken", "slice", (F.sum("steps").over(over.rowsBetween(Window.unboundedPreceding, 0)) - F.col("steps")).alias("before"),
        F.lead("low").over(over).alias("next"))
    inside = Window.partitionBy("spoken", "slice").orderBy("logit", "id")
    place = lambda low, high: F.struct(F.col("wrong"), F.col("logit"), F.col("id"), ((low + high) / 2).alias("middle"))
    after = rows.join(slices, ["spoken", "slice"]).withColumns({
        "wrong": F.col("before") + F.sum("step").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "high": F.coalesce(F.lead("logit").over(inside), "next", F.col("logit") + 1)})
    cuts = after.select("spoken", "label", place(F.col("logit"), F.col("high")).alias("cut"))
    # the place before all texts, where no step has been taken
    none = rows.groupBy("spoken").agg((F.min("logit") - 0.5).alias("middle")).select(
        "spoken", F.lit(None).cast("int").alias("label"),
        F.struct(F.lit(0).cast("long").alias("wrong"), F.lit(float("-inf")).alias("logit"), F.lit(0).cast("long").alias("id"), "middle").alias("cut"))
    latest = F.struct(-F.col("cut.wrong"), F.col("cut.logit"), F.col("cut.id"), F.col("cut.middle").alias("middle"))
    return cuts.unionByName(none).groupBy("spoken").agg(
        ((F.min("cut")["middle"] + F.max(latest)["middle"]) / 2).alias("threshold"), F.count("label").alias("n"),
        F.min("label").alias("least"), F.max("label").alias("most"))


def _logits(shards: DataFrame, net: Network) -> DataFrame:
    """(spoken, id, logit, label) of every text of the shards."""
    shared = shards.sparkSession.sparkContext.broadcast((net, net.word_table()))

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, table = shared.value
        ids, labels, texts = _gathered(batches)
        for lo in range(0, len(ids), BATCH):
            own = [kinds[words] for words, kinds in texts[lo:lo + BATCH]]
            first, words = np.cumsum([0, *map(len, own)]), np.concatenate(own)
            yield pa.RecordBatch.from_arrays([
                pa.array(languages(words, first), pa.int32()), pa.array(ids[lo:lo + BATCH]),
                pa.array(net.logits(words, first, table).astype(np.float32)), pa.array(labels[lo:lo + BATCH].astype(np.int32)),
            ], ["spoken", "id", "logit", "label"])

    return shards.select("fitting", "shard", *_ARRAYS).groupBy("fitting", "shard").applyInArrow(
        run, "spoken int, id long, logit float, label int")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network:
    """Trains and calibrates on all labelled rows outside the held-out fold."""
    shards = _labelled_shards(docs, labels, id_col, text_col, label_col)
    totals = shards.groupBy("fitting").agg(F.sum("n").alias("n"), F.sum("n_positive").alias("positive"),
                                           (F.min("least") < F.max("most")).alias("both"))
    found = {r.fitting: r for r in totals.collect()}  # two rows
    if True not in found or not found[True].both:
        net = Network.fresh()
        net.weights[:] = 0
        net.thresholds[:] = 1
        return net
    net = train(shards.where("fitting"), np.float32(found[True].positive / found[True].n))
    check = not (False in found and found[False].both)
    with _small_batches(docs.sparkSession):
        scored = stage(_logits(shards.where(F.col("fitting") == check), net), "logits")
    best = {r.spoken: r for r in best_thresholds(scored.unionAll(scored.withColumn("spoken", F.lit(-1)))).collect()}  # one a language
    net.thresholds[:] = best[-1].threshold
    for k, r in best.items():
        if k >= 0 and r.n >= LEAST_LABELLED and r.least < r.most:
            net.thresholds[k] = r.threshold
    return net


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((net, net.word_table()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, table = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                scores = pa.array(net.scores(*word_buckets(part["text"]), table))
                yield from pa.table({"doc_id": part["doc_id"], "score": scores}).to_batches()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
