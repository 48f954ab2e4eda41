"""Web archives in WARC form with a two-level capture index.

Writing: every page is a record, gzipped by itself. Of pages with equal payloads of
at least ``LEAST_SHARED`` bytes, that with the largest id is a response and the others
revisit it: their record has the HTTP headers alone. Tasks write archive files into the shared
folder under names of their own and report where each record lies; only what a
successful task reports is ever read.

Index: captures are sorted by reversed-host key and id into parts, each an index file
of compressed blocks of lines; a directory keeps the first line of every block. A
lookup finds the part and the block by binary search, reads that block alone, finds the
line in it by binary search, and then reads the record's range of its archive.

Null urls have the empty key, null payloads are empty, null page ids stay null and
sort first. Repeated rows are records of their own; rows that share the largest id of
their payload are all responses. A lookup gives every record of its key and id. An
empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path, stage

LEAST_SHARED = 1000
BLOCK_LINES, PART_LINES, READ_BYTES, FILE_BYTES = 500, 50_000, 4 << 20, 1 << 30
NO_ID = -(1 << 63)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "key string, id long, file string, offset long, length long, url string, digest string, kind string"
DIRECTORY = "part long, file string, offset long, length long, n long, key string, id long, last_key string, last_id long"
LOCATED = "key string, id long, file string, offset long, length long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def reversed_host_key(url: Column) -> Column:
    """``http://a.b.org:80/x?y#z`` becomes ``org,b,a)/x?y``; blanks and control characters are %20."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"#.*$", "")
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.", -1)), ","), F.lit(")"), rest)
    return F.when(url == "", "").otherwise(F.regexp_replace(key, r"[\x00-\x20]", "%20"))


def record_name(page_id: int | None, digest: str) -> str:
    number = (1 << 64 | int(digest[:15], 16)) if page_id is None else page_id % (1 << 64)
    return f"<urn:uuid:{uuid.UUID(int=number)}>"


def page_of(name: str | None) -> int | None:
    if not name:
        return None
    number = uuid.UUID(name.strip("<>").removeprefix("urn:uuid:")).int
    return None if number >> 64 else number - (1 << 64) * (number >> 63)


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    digest = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_name(page_id, digest.hexdigest()), "WARC-Date": date,
        "WARC-Target-URI": quote(url, safe="%:/?#[]@!$&'()*+,;=~|^`{}\"<>\\-._"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest.digest()).decode(),
        **({"WARC-Profile": PROFILE, "WARC-Refers-To": record_name(refers_to, "0")} if revisit else {}),
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """One row of :data:`RECORDS` from a record's bytes."""
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, payload = rest[:int(fields["Content-Length"])].split(b"\r\n\r\n", 1)
    said = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    whole = fields["WARC-Type"] == "response"
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    return {
        "page_id": page_of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
        "refers_to": page_of(fields.get("WARC-Refers-To")),
        "payload_digest": hashlib.sha1(payload).hexdigest() if whole else digest,
        "payload_bytes": len(payload) if whole else int(said["Content-Length"]), "payload": payload if whole else None,
    }


def _file_system(uri: str) -> tuple[FileSystem, str]:
    """Arrow's file system of a folder as Spark names it, and the path there."""
    scheme, found, rest = uri.partition("://")
    return FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}" if found else uri)


#: Hadoop's names of an object store, and Arrow's.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


class _Output:
    """Files of one task, each under a new name."""

    def __init__(self, folder: str, suffix: str) -> None:
        self.files, path = _file_system(folder)
        self.files.create_dir(path, recursive=True)
        self.path, self.folder, self.suffix = path, folder, suffix
        self.stream, self.name, self.size = None, "", 0

    def write(self, data: bytes) -> tuple[str, int, int]:
        """Where the bytes went: file, offset, length."""
        if self.stream is None or self.size >= FILE_BYTES:
            self.close()
            name = f"{uuid.uuid4().hex}{self.suffix}"
            self.stream, self.name, self.size = self.files.open_output_stream(
                f"{self.path}/{name}", compression=None), f"{self.folder}/{name}", 0
        self.stream.write(data)
        self.size += len(data)
        return self.name, self.size - len(data), len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for every page below ``folder``; returns the captures, written out."""
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn(
        "digest", F.sha1("payload"))
    shared = rows.where(F.octet_length("payload") >= LEAST_SHARED).groupBy("digest").agg(
        F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    rows = rows.join(stage(shared, "shared_payloads"), "digest", "left").select(
        reversed_host_key(F.col("url")).alias("key"), "id", F.coalesce("url", F.lit("")).alias("url"), "payload", "digest", "first",
        (F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Output(folder, ".warc.gz")
        for batch in batches:
            lines = []
            for row in batch.to_pylist():
                data = record(row["id"], row["url"], row["payload"], row["first"], row["revisit"], date)
                file, offset, length = out.write(_gzip(data))
                lines.append({"key": row["key"], "id": NO_ID if row["id"] is None else row["id"], "file": file, "offset": offset,
                              "length": length, "url": row["url"], "digest": row["digest"],
                              "kind": "revisit" if row["revisit"] else "response"})
            yield pa.RecordBatch.from_pylist(lines, pa.schema([
                (n, pa.string() if t == "string" else pa.int64()) for n, t in (c.split() for c in CAPTURES.split(", "))]))
        out.close()

    return stage(rows.mapInArrow(write, CAPTURES), "captures")


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes index files below ``folder``; returns the directory of blocks, written out."""
    parts = max(1, math.ceil(captures.count() / PART_LINES))
    dealt = captures.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, part = _Output(folder, ".cdx.gz"), [], int(uuid.uuid4()) >> 65
        schema = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (c.split() for c in DIRECTORY.split(", "))])

        def block(lines: list[dict]) -> dict:
            text = "".join(f"{x['key']} {x['id']} {json.dumps(x)}\n" for x in lines)
            file, offset, length = out.write(_gzip(text.encode()))
            return {"part": part, "file": file, "offset": offset, "length": length, "n": len(lines), "key": lines[0]["key"],
                    "id": lines[0]["id"], "last_key": lines[-1]["key"], "last_id": lines[-1]["id"]}

        for batch in batches:
            held += batch.to_pylist()
            whole = len(held) // BLOCK_LINES * BLOCK_LINES
            yield pa.RecordBatch.from_pylist([block(held[i:i + BLOCK_LINES]) for i in range(0, whole, BLOCK_LINES)], schema)
            held = held[whole:]
        if held:
            yield pa.RecordBatch.from_pylist([block(held)], schema)
        out.close()

    return stage(dealt.mapInArrow(write, DIRECTORY), "directory")


class _Input:
    """Ranges of files, the last file kept open."""

    def __init__(self) -> None:
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            files, path = _file_system(name)
            self.name, self.file = name, files.open_input_file(path)
        return self.file.read_at(length, offset)


def _lines(data: bytes) -> list[tuple[str, int, str]]:
    split = (line.split(" ", 2) for line in zlib.decompress(data, 47).decode().split("\n")[:-1])
    return [(key, int(number), rest) for key, number, rest in split]


def _find(queries: pa.Table, directory: pa.Table) -> pa.Table:
    blocks = sorted(directory.to_pylist(), key=lambda b: (b["key"], b["id"], b["last_key"], b["last_id"]))
    firsts, source = [(b["key"], b["id"]) for b in blocks], _Input()
    held: tuple[int, list] = (-1, [])
    found = []
    for wanted in sorted(zip(queries["key"].to_pylist(), queries["id"].to_pylist())):
        # the last block that begins before, and all that begin with, the wanted line
        for at in range(max(0, bisect.bisect_left(firsts, wanted) - 1), bisect.bisect_right(firsts, wanted)):
            if held[0] != at:
                b = blocks[at]
                held = (at, _lines(source.read(b["file"], b["offset"], b["length"])))
            lines = held[1]
            i = bisect.bisect_left(lines, (*wanted, ""))
            while i < len(lines) and lines[i][:2] == wanted:
                line = json.loads(lines[i][2])
                found.append({c: line[c] for c in ("key", "id", "file", "offset", "length")})
                i += 1
    return pa.Table.from_pylist(found, pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (
        c.split() for c in LOCATED.split(", "))]))


def look_up(queries: DataFrame, directory: DataFrame) -> DataFrame:
    """(key, id, file, offset, length) of every record of the queries' (key, id)."""
    bounds = sorted(map(tuple, directory.groupBy("part").agg(  # one row for each index file
        F.min(F.struct("key", "id")).alias("a"), F.max(F.struct("last_key", "last_id")).alias("b")).select(
        "a.key", "a.id", "b.last_key", "b.last_id", "part").collect()))
    starts = [(b[0], b[1]) for b in bounds]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for wanted in zip(batch["key"].to_pylist(), batch["id"].to_pylist()):
                at = bisect.bisect_right(starts, wanted) - 1
                while at >= 0 and (bounds[at][2], bounds[at][3]) >= wanted:  # a repeated line may span parts
                    out.append({"part": bounds[at][4], "key": wanted[0], "id": wanted[1]})
                    at -= 1
            yield pa.RecordBatch.from_pylist(out, pa.schema([("part", pa.int64()), ("key", pa.string()), ("id", pa.int64())]))

    asked = queries.select("key", "id").distinct().mapInArrow(place, "part long, key string, id long")
    return asked.groupBy("part").cogroup(directory.groupBy("part")).applyInArrow(_find, LOCATED)


def read_records(located: DataFrame) -> DataFrame:
    """The records at the given ranges; neighbouring ranges are read together."""
    located = stage(located, "located")
    total = located.agg(F.sum("length")).first()[0] or 0
    near = located.repartitionByRange(max(1, math.ceil(total / (8 * READ_BYTES))), "file", "offset").sortWithinPartitions("file", "offset")
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in RECORDS.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = _Input()
        for batch in batches:
            run: list[tuple[str, int, int]] = []

            def records() -> pa.RecordBatch:
                start = run[0][1]
                data = source.read(run[0][0], start, run[-1][1] + run[-1][2] - start)
                return pa.RecordBatch.from_pylist(
                    [parsed(zlib.decompress(data[o - start:o - start + n], 47)) for _, o, n in run], schema)

            for row in zip(*(batch[c].to_pylist() for c in ("file", "offset", "length"))):
                if run and (row[0] != run[-1][0] or row[1] != run[-1][1] + run[-1][2] or row[1] - run[0][1] >= READ_BYTES):
                    yield records()
                    run = []
                run.append(row)
            if run:
                yield records()

    return near.mapInArrow(read, RECORDS)


def archive_and_read(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                     payload_col: str = "html") -> DataFrame:
    """Archives all pages, then looks each up in the index and reads its record back."""
    folder = scratch_path(spark, "archives")
    captures = write_archives(pages, f"{folder}/warc", id_col, url_col, payload_col)
    directory = build_index(captures, f"{folder}/index")
    queries = pages.select(reversed_host_key(F.col(url_col)).alias("key"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"))
    return read_records(look_up(queries, directory))
