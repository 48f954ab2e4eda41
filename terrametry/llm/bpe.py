"""Byte-level BPE encoding by a table of distinct words, and decoding by a table of pieces.

Encoding: Spark splits every text into the tokenizer's words. Each chunk of some
4 MB of text lists its distinct words by buckets of their hash; a bucket encodes each of
its distinct words once, whatever the number of chunks that have it, and hands the
ids back. The chunk's words, kept as places in its list, then take their ids by
position. A frequent word costs one entry for each chunk.

Decoding: each id is looked up in the vocabulary's piece table, and the pieces' bytes are
put together; bytes that are no UTF-8 become U+FFFD. Ids outside the vocabulary have no piece.

Special tokens of the vocabulary are found in texts and stay single ids. Null and
empty texts have no ids and decode to the empty text. Repeated rows are encoded alike;
null document ids are kept. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .bytesets import bucket_bits, joined, text_bytes, word_hashes

#: Fixed value: the public pattern by which byte-level BPE splits words; (?U) gives \s its Unicode meaning.
WORDS = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHUNK = 4 << 20
_STEP = 1 << 19
LISTED = "chunk long, seal binary, bucket long, n long, n_bytes long, sizes binary, words binary"
CODED = "chunk long, seal binary, bucket long, n long, n_ids long, sizes binary, ids binary"
PLACED = "chunk long, seal binary, doc_ids array<long>, sizes array<int>, places binary, n long, n_listed long"


def special_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


def words_of(text: Column, specials: list[str]) -> Column:
    """All words of a text in order; together they are the text."""
    found = lambda part: F.regexp_extract_all(part, F.lit(WORDS), F.lit(0))
    if not specials:
        return found(text)
    any_of = "|".join("\\Q" + s + "\\E" for s in sorted(specials, key=len, reverse=True))
    cut = F.zip_with(
        F.split(text, any_of, -1), F.regexp_extract_all(text, F.lit(any_of), F.lit(0)),
        lambda part, special: F.concat(found(part), F.when(special.isNull(), F.array().cast("array<string>")).otherwise(F.array(special))))
    return F.when(text.rlike(any_of), F.flatten(cut)).otherwise(found(text))


def _pack(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _unpack(data: bytes, n: int) -> bytes:
    return pa.Codec("zstd").decompress(data, decompressed_size=n, asbytes=True)


def _pack_numbers(a: np.ndarray) -> bytes:
    """32-bit numbers; bytes of one rank after another pack better."""
    return _pack(np.ascontiguousarray(a, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes())


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unpack(data, 4 * n), np.uint8).reshape(4, n).T).view(np.uint32).ravel()


def _listed(words: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of distinct words by bucket, and each bucket in that order; neighbours begin alike where they can."""
    buf, begins = joined(words)
    h = word_hashes(buf, begins[:-1], begins[1:] - 1)
    padded = np.append(buf, np.zeros(8, np.uint8))
    head = padded[begins[:-1, None] + np.arange(8)].view(">u8").ravel()
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((h, head, bucket))
    return order, bucket[order]


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer, once in each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _seal(own: pa.RecordBatch, places: np.ndarray, words: pa.Array) -> bytes:
    """Digest of a chunk's ids and texts in their order."""
    digest = hashlib.blake2b(digest_size=16)
    for numbers in (pc.fill_null(own["doc_id"], -1), pc.is_null(own["doc_id"]).cast(pa.int8()), pc.list_value_length(own["words"]),
                    pc.binary_length(words)):
        digest.update(np.ascontiguousarray(numbers.to_numpy(zero_copy_only=False)))
    digest.update(places)
    if len(words):
        digest.update(pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "")[0].as_buffer())
    return digest.digest()


def _chunks(batches, bits: int):
    """(number, seal, docs, place of each word in the chunk's list, the list, its buckets)."""
    at, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        size = pc.fill_null(pc.cast(batch["size"], pa.int64()), 0).to_numpy()
        total, i = np.cumsum(size), 0
        while i < batch.num_rows:
            before = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, before + CHUNK)))
            own = batch.slice(i, j - i)
            i = j
            coded = pc.list_flatten(own["words"]).dictionary_encode()
            order, bucket = _listed(coded.dictionary, bits)
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            places = rank[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.uint32)
            words = coded.dictionary.take(pa.array(order))
            yield part << 32 | at, _seal(own, places, words), own, places, words, bucket
            at += 1
            del own, coded, places, words
            pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: str | None = None) -> DataFrame:
    """(doc_id, ids) for every row; ``path`` is a tokenizer file that every machine can open.

    ``decoded`` names a further column: the ids decoded again, as :func:`decode` does, in the same task.

    The input is read twice in the same order, as files are. A chunk's ids and texts are
    sealed by a digest in both readings, and one that differs stops the job.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bits = bucket_bits(text_bytes(docs))
    split = docs.select("doc_id", F.octet_length("text").alias("size"), words_of(F.col("text"), special_tokens(path)).alias("words"))

    def list_words(batches):
        for chunk, seal, _, _, words, bucket in _chunks(batches, bits):
            buf, begins = joined(words)
            begins = begins - np.arange(len(begins))  # without the line feeds between
            raw = b"".join(words.cast(pa.binary()).to_pylist())
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)]):
                own = raw[begins[a]:begins[b]]
                yield pa.RecordBatch.from_pylist([{
                    "chunk": chunk, "seal": seal, "bucket": int(bucket[a]), "n": b - a, "n_bytes": len(own),
                    "sizes": _pack_numbers(np.diff(begins[a:b + 1])), "words": _pack(own)}])

    def encode_words(group: pa.Table) -> pa.Table:
        tokenizer, rows = _tokenizer(path), []
        for n, size, sizes, words in zip(*(group[c].to_pylist() for c in ("n", "n_bytes", "sizes", "words"))):
            ends = np.concatenate([[0], np.cumsum(_numbers(sizes, n))]).astype(np.int32)
            rows.append(pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(_unpack(words, size))))
        coded = pa.concat_arrays(rows).dictionary_encode()
        different, flat, size = coded.dictionary, [], []
        for i in range(0, len(different), 20_000):
            for e in tokenizer.encode_batch(different.slice(i, 20_000).to_pylist(), add_special_tokens=False):
                flat.append(np.array(e.ids, np.uint32))
                size.append(len(flat[-1]))
        ids, size = np.concatenate(flat), np.array(size, np.int64)
        begin = np.cumsum(size) - size
        at, out, i = coded.indices.to_numpy(zero_copy_only=False), [], 0
        for chunk, seal, bucket, n in zip(*(group[c].to_pylist() for c in ("chunk", "seal", "bucket", "n"))):
            own = at[i:i + n]
            k = size[own]
            spot = np.repeat(begin[own] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
            out.append({"chunk": chunk, "seal": seal, "bucket": bucket, "n": n, "n_ids": len(spot), "sizes": _pack_numbers(k), "ids": _pack_numbers(ids[spot])})
            i += n
        return pa.Table.from_pylist(out)

    def place_words(batches):
        for chunk, seal, own, places, words, _ in _chunks(batches, bits):
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([chunk], pa.int64()), "seal": pa.array([seal], pa.binary()), "doc_ids": pa.array([own["doc_id"].to_pylist()], pa.list_(pa.int64())),
                "sizes": pa.array([pc.list_value_length(own["words"]).to_pylist()], pa.list_(pa.int32())),
                "places": pa.array([_pack_numbers(places)], pa.binary()), "n": pa.array([len(places)], pa.int64()),
                "n_listed": pa.array([len(words)], pa.int64())})

    def put_back(left: pa.Table, right: pa.Table) -> pa.Table:
        listed = left.num_rows == 1 and left["n_listed"][0].as_py() == (pc.sum(right["n"]).as_py() or 0)
        if not listed or {*right["seal"].to_pylist()} - {left["seal"][0].as_py()}:
            raise ValueError("the documents came in another order when they were read again")
        right = right.sort_by("bucket")
        none = [np.zeros(0, np.uint32)]
        size, ids = (np.concatenate([*(_numbers(x, n) for x, n in zip(right[c].to_pylist(), right[m].to_pylist())), *none])
                     for c, m in (("sizes", "n"), ("ids", "n_ids")))
        size, ids = size.astype(np.int64), ids.astype(np.int32)
        begin = np.cumsum(size) - size
        places = _numbers(left["places"][0].as_py(), left["n"][0].as_py())
        parts = [np.zeros(0, np.int32)]
        for i in range(0, len(places), _STEP):
            at = places[i:i + _STEP]
            k = size[at]
            parts.append(ids[np.repeat(begin[at] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))])
        n_words = left["sizes"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(size[places])])[np.concatenate([[0], np.cumsum(n_words)])]
        out = {"doc_id": left["doc_ids"].combine_chunks().flatten(),
               "ids": pa.ListArray.from_arrays(before.astype(np.int32), pa.array(np.concatenate(parts)))}
        return pa.table(out | {decoded: _texts_of(out["ids"], pieces.value)} if decoded else out)

    pieces = docs.sparkSession.sparkContext.broadcast(piece_table(path)) if decoded else None
    coded = split.mapInArrow(list_words, LISTED).groupBy("bucket").applyInArrow(encode_words, CODED)
    placed = split.mapInArrow(place_words, PLACED)
    return placed.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(
        put_back, "doc_id long, ids array<int>" + (f", `{decoded}` string" if decoded else ""))


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a visible character: itself, or the next from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces by id, and where each begins; the vocabulary is a fixed file."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    byte_of = _byte_of()
    pieces = {i: bytes(byte_of[c] for c in p) for p, i in described["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"].encode() for t in described["added_tokens"]}
    listed = [pieces.get(i, b"") for i in range(max(pieces) + 1)] + [b""]  # the last is for ids that have no piece
    return np.frombuffer(b"".join(listed), np.uint8), np.cumsum([0, *map(len, listed)])


def _texts_of(rows: pa.Array, table: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """The text of each list of ids, from the pieces' bytes."""
    data, begin = table
    length, begin = np.diff(begin), begin[:-1]
    ends = np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)).tolist()
    ids = pc.list_flatten(rows).to_numpy(zero_copy_only=False)
    ids = np.where((ids >= 0) & (ids < len(length)), ids, len(length) - 1)
    out, a = [], 0
    for b in ends:
        text = []
        for i in range(a, b, _STEP):
            own = ids[i:min(b, i + _STEP)]
            k = length[own]
            text.append(data[np.repeat(begin[own] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))].tobytes())
        out.append(b"".join(text).decode("utf-8", "replace"))
        a = b
    return pa.array(out, pa.string())


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each row's ids; null ids give the empty text."""
    table = encoded.sparkSession.sparkContext.broadcast(piece_table(path))
    schema = encoded.select("*", F.lit("").alias(text_col)).schema

    def join_pieces(batches):
        for batch in batches:
            total, i = np.cumsum(pc.fill_null(pc.list_value_length(batch[ids_col]), 0).to_numpy(zero_copy_only=False)), 0
            while i < batch.num_rows:  # some rows at a time, to bound what is held
                j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + 2 * _STEP)))
                rows = batch.slice(i, j - i)
                i = j
                yield pa.RecordBatch.from_arrays([*rows.columns, _texts_of(rows[ids_col], table.value)], [*rows.schema.names, text_col])

    return encoded.mapInArrow(join_pieces, schema)
