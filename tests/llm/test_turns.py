import itertools
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from terrametry.llm import turns

from .conftest import sha

SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def faults(rows):
    seen = set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        yield "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
        seen.add((role, text))


def least_edits(rows, found):
    """Cheapest edits, then ASCII-least, by trying every edit at every row."""
    said = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def rest(i, last, inserted):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, ""))
        if inserted < 3:
            cost, audit = rest(i, said[last], inserted + 1)
            options.append((cost + 3, "I" + audit))
        if i < len(rows):
            cost, audit = rest(i + 1, last, 0)
            options.append((cost + 4, "D" + audit))
            if found[i] in ("", "truncated"):
                more = 3 * (found[i] == "truncated")
                cost, audit = rest(i + 1, said[last], 0)
                options.append((cost + 3 + more, "R" + audit))
                own = rows[i][1][:1]
                if own in "sua" and own and (own == said[last] or own == "s" and last == ""):
                    cost, audit = rest(i + 1, own, 0)
                    options.append((cost + more, "K" + audit))
        return min(options, default=(10**9, ""))

    sys.setrecursionlimit(20_000)
    return rest(0, "", 0)


def repaired_text(rows, audit):
    out, last, i = [], "", 0
    for edit in audit:
        name = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        if edit != "I":
            _, role, text = rows[i]
            i += 1
        if edit == "D":
            continue
        out.append((role if edit == "K" else name) + ":" + ("" if edit == "I" else text))
        last = out[-1][0]
    return "\n".join(out)


def expected(rows):
    out = {}
    left = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r, x) for c, t, r, x in left if c == conv), key=lambda r: (r[0] is not None, r))
        found = [*faults(own)]
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = least_edits(own, found)
        out[conv] = (gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     sha(repaired_text(own, audit)))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for conv in range(120):
        start, last = rng.randint(-3, 30), "assistant"
        if rng.random() < 0.4:
            out.append((conv, start, "system", "Be kind."))
        for k in range(rng.choice([1, 2, 4, 7, 12])):
            last = rng.choice(["user", "assistant", "system", "tool", None]) if rng.random() < 0.2 else "user" if last == "assistant" else "assistant"
            text = rng.choice(["Yes.", "No!", "why? ", "cut off", " \n\t", "", None, f"text {k}.", f"t {conv} {k}　é.\n"])
            turn = None if rng.random() < 0.05 else start + 1 + k + (rng.random() < 0.1)
            out.append((conv, turn, last, text))
    out += [(200, k, "user", f"alone {k}.") for k in range(150)] + [(201, k, "assistant", "same") for k in range(300)]
    out += [(None, k, ("user", "assistant")[k % 2], f"q {k}?") for k in range(40)] + [(202, None, "user", "a."), (202, None, "assistant", "b.")]
    out += [(203, k, "", "x" * 5000) for k in range(3)]
    out += out[:20]
    gone = next(c for c in range(300, 900) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return out + [(gone, 0, "user", "dropped.")]


def test_equals_trying_every_edit(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in ("conv", "pos", "gone", "pass", "nth")})
    found = turns.repair(turns.damaged(df), gone="gone").collect()
    assert {r[0]: tuple(r)[1:] for r in found} == expected(rows) and len(found) == len({r[0] for r in rows})


def test_repaired_rows_have_legal_roles(spark, rows):
    df = turns.damaged(spark.createDataFrame(rows, SCHEMA))
    out = {}
    for r in turns.repaired(df, gone="gone").orderBy("place").collect():
        out.setdefault(r.conv, []).append(r)
    for own in out.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own)) and [r.place for r in own] == [*range(1, len(own) + 1)]
    digests = {r.conv_id: r.repaired_sha256 for r in turns.repair(df, gone="gone").collect()}
    assert all(digests[c] == sha("\n".join(f"{r.role}:{r.text}" for r in own)) for c, own in out.items())


def test_long_runs_in_logarithmic_steps():
    runs = [(("u", turns.NONE), 1_000_000), (("a", turns.CUT), 999_999), (("?", turns.BLANK), 5)]
    cost, audit = turns.cheapest(runs)
    small = [(s, min(n, 40 - n % 2)) for s, n in runs]
    rows = [(0, s[0], "") for s, n in small for _ in range(n)]
    found = [{turns.NONE: "", turns.CUT: "truncated", turns.BLANK: "blank"}[s[1]] for s, n in small for _ in range(n)]
    assert turns.cheapest(small) == least_edits(rows, found)
    assert sum(len(audit) - audit.count("I") for _ in [0]) == 2_000_004
    assert cost == sum({"D": 4, "I": 3, "K": 0, "R": 3}[e] * n for e, n in ((e, audit.count(e)) for e in "DIKR")) + 3 * sum(
        e != "D" for e in [x for x in audit if x != "I"][1_000_000:1_999_999])


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turns.repair(turns.damaged(none), gone="gone").count() == 0 and turns.repaired(none).count() == 0
