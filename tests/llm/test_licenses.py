import re
import textwrap

import duckdb
import pytest

from terrametry.llm import licenses
from terrametry.llm.queries import LICENSES_SQL

from .conftest import SCHEMA


def noticed(line):
    """Python's form of what is deleted."""
    notice, body = (re.compile(p.replace(r"\p{L}\p{N}", r"\w").replace(r"(?-i:\p{Lu})", "(?-i:[A-Z])"))
                    for p in (licenses.NOTICE_LINE, licenses.BODY_LINE))
    return bool(notice.search(line)) and not body.search(line)


def wrapped(text, width):
    """The text at another width; its own copyright lines stay lines."""
    return "\n".join(line if noticed(line) else "\n".join(textwrap.wrap(line, width, break_long_words=False, break_on_hyphens=False))
                     for line in text.split("\n"))


def test_known_texts_are_found_however_they_are_wrapped(spark):
    texts = {name: text for name, text in licenses.KNOWN[:4]}
    for entry in licenses.license_entries():
        if entry["names"] == ["MPL-1.1"]:
            continue  # quotes a notice in mid-sentence
        texts[entry["names"][0], entry["parts"][0][:40]] = next(t for n, t in licenses.whole_texts() if n == entry["names"][0] and t.startswith(entry["parts"][0][:30]))
    rows, want = [], {}
    for key, text in texts.items():
        n_notices = sum(map(noticed, text.split("\n")))
        for width in range(40, 101, 4):
            if sum(map(noticed, wrapped(text, width).split("\n"))) > n_notices:
                continue  # a notice that the text quotes within a line now begins one
            rows.append((len(rows), "Copyright (c) 2001-2020 The Some Authors. All rights reserved.\n\n" + wrapped(text, width), None))
            want[len(rows) - 1] = key if isinstance(key, str) else key[0]
    found = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [i for i in want if want[i] not in found[i]] == [] and len(want) > 400


@pytest.mark.parametrize("line, notice", [
    ("Copyright 2020 A. Person", True), ("  * Copyright (c) <year> <owner>", True), ("(c) 2019 Foo", True), ("© Foo", True),
    ("Copyright Jane Doe", True), ("All rights reserved.", True), ("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", False),
    ("(c) You must retain, in the Source form", False), ("copyright notice and this permission notice", False), ("copyright", False),
    ("Copyright Law of the land", False), ("copyright on the software, and", False), ("All rights reserved for the king are", False)])
def test_copyright_lines(spark, line, notice):
    found = licenses.with_forms(spark.createDataFrame([(line,)], "text string"), "text").first()
    assert (found.whole == "") == notice


def test_sql_knows_the_same_texts(spark):
    rows = [(1, "SPDX-License-Identifier: MIT"), (2, "x\nThis file is made available under the terms of the GNU General Public License v3.0 or later\ny"),
            (3, "Released under the Boost Software License 1.0"), (4, None), (5, licenses.whole_texts()[-1][1]), (6, "licensed under the law"),
            (7, licenses.whole_texts()[700][1].replace("\n", "\r\n")), (8, "MIT Licensed\nLicense: ISC"), (9, licenses.KNOWN[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = {(r.doc_id, r.text_digest, ",".join(r.licenses), ",".join(r.notices)) for r in licenses.scan(docs).collect()}
    assert found == set(con.execute(LICENSES_SQL).fetchall())
    named = {r[0]: r[2] or r[3] for r in found}
    assert named[1] == "MIT" and named[2] == "GPL-3.0-or-later" and named[3] == "BSL-1.0" and named[5] and named[7] and named[6] == ""


def test_no_known_texts(spark):
    docs = spark.createDataFrame([(1, licenses.KNOWN[0][1])], "doc_id long, text string")
    none = spark.createDataFrame([], "license_id string, text string")
    assert [(r.licenses, r.notices) for r in licenses.scan(docs, none).collect()] == [([], [])]


def test_known_texts_and_notices(spark, odd_docs, odd_rows):
    mit, bsd = licenses.KNOWN[0][1], licenses.KNOWN[2][1]
    rows = [(1000, "Copyright (c) 2020 A. Person\n" + mit.upper().replace(" ", "  "), None),
            (1001, "text\nreleased under the MIT licence\nmore\nLicensed under CC BY-NC 4.0", None),
            (1002, bsd.replace("MERCHANTABILITY", "merchantability").replace("\n", "\r\n") + "\nAll rights reserved.", None),
            (1003, mit[:-1] + " x", None), (1004, "Copyright 2020", None), (None, mit, None), (1000, mit, None)]
    docs = odd_docs.unionByName(spark.createDataFrame(rows, SCHEMA), allowMissingColumns=True)
    found = licenses.scan(docs).collect()
    assert len(found) == len(odd_rows) + len(rows)
    named = {(r.doc_id, tuple(r.licenses), tuple(r.notices)) for r in found if r.licenses or r.notices}
    assert named == {(1000, ("MIT",), ()), (1001, (), ("CC-BY-NC-4.0", "MIT")), (1002, ("BSD-2-Clause",), ()), (None, ("MIT",), ())}


def test_empty_table_and_no_python(no_docs):
    found = licenses.scan(no_docs)
    assert found.count() == 0 and "Python" not in found._jdf.queryExecution().executedPlan().toString()
