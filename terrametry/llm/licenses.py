"""Licence scans by digests of canonical texts.

A text's canonical form is lower-case, without copyright lines and punctuation, with
equivalent spellings made one and words a blank apart. Its digest is looked up among
those of known licences, and so is the digest of every line, for one-line notices.

The default known texts are ``KNOWN``, the longer table of ``license_texts.json`` (each
licence with and without its usual titles, appendices and wordings) and lines that name a
licence in their own way; the SQL twin is built from the same tables. A notice like
"released under the terms of the ..." is two look-ups, its opening words by a pattern and the
name after them by digest. A text that several identifiers share has them all, as
GPL-3.0-only and GPL-3.0-or-later do.

A line is a copyright notice if a sign, a year, a place for either or a capitalised name follows the
word, and not where a licence's own words do ("copyright holders", "copyright notice"), so that
a licence is found however its lines are wrapped.

Built-in expressions only. Null and empty texts, and those of copyright lines alone,
have the empty form, which no licence has. Repeated rows are found alike. A known text
listed under several names gives them all. An empty table gives no rows.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage

# Spellings that count as one, as whole words of the form without punctuation.
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "authorisation": "authorization", "authorised": "authorized",
    "centre": "center", "colour": "color", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "licence": "license",
    "licenced": "licensed", "licences": "licenses", "modelled": "modeled",
    "organisation": "organization", "per cent": "percent", "recognise": "recognize", "sub license": "sublicense",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "http": "https",
}
#: Lines that may be copyright notices: the word followed by a sign, a year, a place for either or a name; a sign first.
NOTICE_LINE = (r"(?i)^[^\p{L}\p{N}©]*(?:copyright(?:[^\p{L}\p{N}]*(?:\(c\)|[©<\[{\d])|[^\p{L}\p{N}]+(?-i:\p{Lu}))"
               r"|\(c\)[^\p{L}\p{N}]*(?:copyright|\d)|©|all rights reserved[^\p{L}\p{N}]*$)")
#: Lines of a licence's body that begin like one, where it happens to be wrapped there.
BODY_LINE = (r"(?i)^[^\p{L}\p{N}©]*copyright[^\p{L}\p{N}]+(?:holders?|owners?|notices?|laws?|licen[sc](?:es?|ors?)|statements?|disclaimers?"
             r"|acts?|and|or|in|is)(?:[^\p{L}\p{N}]|$)")
_ANY_EQUIVALENT = "(?<![^ ])(?:" + "|".join(EQUIVALENT) + ")(?![^ ])"

_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.\n")
# Public licence texts and usual one-line notices, by their public identifiers.
KNOWN = (
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to "
     "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
     "Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice "
     "shall be included in all copies or substantial portions of the Software.\n\n" + _DISCLAIMER),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "
     "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
     "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
     "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
     "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD_TERMS + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_TERMS + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission.\n" + _BSD_DISCLAIMER),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
# Licences by the names that notices call them, and the words before those names.
_NAMED = (
    ("MIT", ("MIT License", "MIT License (MIT)", "MIT")), ("ISC", ("ISC License", "ISC")), ("0BSD", ("Zero-Clause BSD License", "0BSD License")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License, Version 2.0 (the \"License\")", "Apache License 2.0", "Apache 2.0 License",
                    "Apache License v2.0", "Apache-2.0 License", "Apache Software License, Version 2.0", "Apache 2.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License")),
    ("MPL-2.0", ("Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License, Version 2.0", "MPL 2.0", "MPL-2.0")),
    ("Unlicense", ("Unlicense",)), ("Zlib", ("zlib License", "zlib/libpng License")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0")),
    ("CC0-1.0", ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0")),
) + tuple(
    (f"{short}-{number}{kind}", tuple(form + later for form in (
        f"{name} License, version {version}", f"{name} License version {version}", f"{name} License v{version}", f"{name} License {version}",
        f"{name} License ({short}) version {version}", f"{short} version {version}", f"{short} v{version}", f"{short}v{version}")))
    for short, name, versions in (
        ("GPL", "GNU General Public", ("2", "2.0", "3", "3.0")), ("LGPL", "GNU Lesser General Public", ("2.1", "3", "3.0")),
        ("AGPL", "GNU Affero General Public", ("3", "3.0")))
    for version in versions for number in (version if "." in version else version + ".0",)
    for kind, later in (("-only", ""), ("-only", " only"), ("-or-later", " or later"), ("-or-later", " or any later version"),
                        ("-or-later", " or (at your option) any later version"))
) + tuple(
    (f"CC-{kind}-{version}", (f"CC {kind} {version}", f"CC-{kind}-{version}", f"Creative Commons {name} {version} International License",
                              f"Creative Commons {name} {version} International", f"Creative Commons {name} {version} License"))
    for kind, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                       ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
    for version in ("4.0",)
)
#: Words of the canonical form before a licence's name; the name follows.
BEFORE_NAME = (
    "^(?:(?:this (?:work|project|software|program|library|package|code|file|document|repository)|the code) is )?"
    "(?:licensed|released|distributed|available|made available) under (?:the terms of )?(?:(?:the|a) )?(.+)$")
#: Stands before the form of a name in the table of known digests; no form has it.
NAMED = "+"
_SPECIAL = (
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "License, v. 2.0. If a copy of the MPL was not distributed with this"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
     "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", "MIT Licensed"), ("MIT", "License: MIT"), ("ISC", "License: ISC"), ("Apache-2.0", "License: Apache-2.0"), ("Apache-2.0", "License: Apache 2.0"),
)


def license_names() -> list[tuple[str, str]]:
    """(license_id, name): what notices call the licences, after the words of ``BEFORE_NAME``."""
    return [(name, called) for name, calls in _NAMED for called in calls]


def notice_lines() -> list[tuple[str, str]]:
    """(license_id, line): tags and other one-line notices that name their licence in their own way."""
    tags = {name for name, _ in _NAMED} | {f"{n}{k}" for n in ("GPL-1.0", "LGPL-2.0") for k in ("-only", "-or-later")}
    tagged = [(name, f"SPDX-License-Identifier: {name}") for name in sorted(tags)]
    old = [(name, f"SPDX-License-Identifier: {name.removesuffix('-only')}") for name in sorted(tags) if name.endswith("-only")]
    return tagged + old + list(_SPECIAL)


def license_entries() -> list[dict]:
    """The longer table: of each text its parts, the wordings of its marks and its usual titles."""
    return json.loads(Path(__file__).with_name("license_texts.json").read_text(encoding="utf-8"))


def whole_texts() -> list[tuple[str, str]]:
    """(license_id, text): the longer table in full, every licence in its usual forms.

    A licence's parts (terms, closing line, appendix) may end after any of them; each mark
    of ``swaps`` stands for one of several wordings; a title may come before.
    """
    out = []
    for entry in license_entries():
        forms = ["".join(entry["parts"][:k + 1]) for k in range(len(entry["parts"]))]
        for mark, wordings in entry["swaps"].items():
            forms = list(dict.fromkeys(form.replace(mark, wording) for form in forms for wording in wordings))
        out += [(name, text) for name in entry["names"] for form in forms for text in (form, *(f"{t}\n\n{form}" for t in entry["titles"]))]
    return out


def _one_spelling(form: Column) -> Column:
    out = form
    for spelling, one in EQUIVALENT.items():
        out = F.regexp_replace(out, rf"(?<![^ ]){spelling}(?![^ ])", one)
    return F.when(form.rlike(_ANY_EQUIVALENT), out).otherwise(form)


def with_forms(texts: DataFrame, text_col: str, forms: str = "forms", whole: str = "whole") -> DataFrame:
    """``texts`` with the canonical forms of its lines that have one, and of the whole text."""
    plain = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1), lambda line: F.when(
        line.rlike(NOTICE_LINE) & ~line.rlike(BODY_LINE), "").otherwise(F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))))
    out = texts.withColumn(forms, F.filter(F.transform(plain, _one_spelling), lambda form: form != ""))
    return out.withColumn(whole, F.array_join(forms, " ")).withColumn(whole, _one_spelling(F.col(whole)))


def known_digests(known: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(digest, license_id) of a table (license_id, text), and of names (license_id, name) that follow ``BEFORE_NAME``."""
    listed = known.select("license_id", "text", F.lit("").alias("mark"))
    if names is not None:
        listed = listed.unionAll(names.select("license_id", F.col("name").alias("text"), F.lit(NAMED).alias("mark")))
    listed = with_forms(listed, "text").where("whole <> ''")
    return listed.select(F.md5(F.concat("mark", "whole")).alias("digest"), "license_id").distinct()


def _look_ups(form: Column) -> Column:
    """Digests of a form, and of the name that it ends with after the words of a notice."""
    name = F.regexp_extract(form, BEFORE_NAME, 1)
    return F.array_compact(F.array(F.md5(form), F.when(name != "", F.md5(F.concat(F.lit(NAMED), name)))))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         names: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_digest, licenses, notices) for every row: names of the whole text and of its lines, sorted.

    Without ``known`` and ``names`` the default tables are looked up.
    """
    spark = docs.sparkSession
    if known is None:
        known = spark.createDataFrame([*KNOWN, *notice_lines(), *whole_texts()], "license_id string, text string")
        names = names if names is not None else spark.createDataFrame(license_names(), "license_id string, name string")
    known = stage(known_digests(known, names), "known_licenses")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    rows = with_forms(rows, "text").select(
        "doc_id", "text_hash", F.md5("whole").alias("text_digest"), _look_ups(F.col("whole")).alias("whole_digests"),
        F.array_distinct(F.flatten(F.transform("forms", _look_ups))).alias("digests"))
    rows = stage(rows, "digests")
    key = ["doc_id", "text_hash"]
    of = lambda digests, whole: F.transform(digests, lambda d: F.struct(F.lit(whole).alias("whole"), d.alias("digest")))
    each = rows.select(*key, F.explode(F.concat(of("whole_digests", True), of("digests", False))).alias("e")).select(*key, "e.*")
    names = lambda whole: F.array_sort(F.collect_set(F.when(F.col("whole") == whole, F.col("license_id"))))
    found = each.join(known, "digest").groupBy(*key).agg(names(True).alias("licenses"), names(False).alias("notices"))
    found = stage(found.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("with"), "licenses", "notices"), "licensed")
    none = F.array().cast("array<string>")
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("with")), "left").select(
        "doc_id", "text_digest", F.coalesce("licenses", none).alias("licenses"), F.coalesce("notices", none).alias("notices"))
