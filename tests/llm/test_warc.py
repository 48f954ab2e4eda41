import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from terrametry.llm import warc
from terrametry.session import scratch_path

BIG = "<p>" + "é" * 600
PAGES = [
    (1, "http://A.b.org:8080/x y?q#z", BIG), (2, "https://b.org", BIG), (7, None, BIG), (3, "ftp://x/\r\n", "small"), (4, "", "small"),
    (5, "http://a.b.org/", None), (6, "http://a.b.org/", ""), (None, "http://n/", BIG), (None, None, None), (2, "https://b.org", BIG),
    (-9, "http://c.org/\U0001F600", "line\r\n\r\nend " * 200), (-8, "http://c.org/\U0001F600", "line\r\n\r\nend " * 200),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"key": F.lit(1), "id": F.lit(2), "digest": F.lit(3)})


@pytest.mark.parametrize("lines", [500, 2])
def test_round_trip(spark, pages, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    monkeypatch.setattr(warc, "PART_LINES", 2 * lines)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_and_read(spark, pages).collect()]
    first = {BIG: 7, PAGES[-1][2]: -8}
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and page != first[html]
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None))
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_files_are_archives(spark, pages):
    folder = scratch_path(spark, "warc")
    captures = warc.write_archives(pages, folder).collect()
    for c in captures:
        with open(c.file.removeprefix("file:"), "rb") as file:
            file.seek(c.offset)
            data = gzip.decompress(file.read(c.length))
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: " + c.kind.encode()) and data.endswith(b"\r\n\r\n")


def test_keys(spark):
    urls = [("http://A.b.org:8080/x y?q#z", "org,b,a)/x%20y?q"), ("https://b.org", "org,b)"), (None, ""), ("", ""), ("no scheme", ")no%20scheme")]
    rows = spark.createDataFrame(urls, "url string, want string").select(warc.reversed_host_key(F.col("url")).alias("got"), "want").collect()
    assert [r.got for r in rows] == [r.want for r in rows]


def test_empty_table(spark, pages):
    assert warc.archive_and_read(spark, pages.limit(0)).count() == 0


def test_object_stores_are_opened_under_arrows_name():
    files, path = warc._file_system("s3a://bucket/folder?region=eu-west-1")
    assert files.type_name == "s3" and path == "bucket/folder"
    assert warc._file_system("file:///tmp/x")[1] == "/tmp/x"
