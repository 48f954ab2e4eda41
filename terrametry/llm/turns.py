"""Conversation structure repair by a run-length dynamic program.

A conversation's rows, by turn, are symbols of role initial and fault. Equal neighbours
collapse to runs. The cost of the rest of a conversation, by the state its roles have
reached, is a vector; a symbol is a min-plus matrix on it, and a run applies the matrix's
cached binary powers. From the vectors between runs the choices of each run are unrolled,
halving long runs, so that the audit is the ASCII-least of the cheapest edits:

    K  keep a row (0)             R  give it the role user or assistant (3)
    D  delete it (4)              I  insert an empty user or assistant turn (3)

Blank and duplicate rows must be deleted, and truncated ones cost 3 more unless they are. The
roles' initials then read ``(s?(ua)+)?``.

All rows of a conversation go to one task, as the digest of its repaired text is sequential.
There they pass twice in one sorted stream, first as symbols alone and then with their
texts, so that a task holds a conversation's runs and audit but never its rows; Spark sorts
and spills. Repeated work after a lost executor gives the same rows.

Null role or text counts as one space. Rows come by turn, null turns first, rows of one
turn by role and text. Rows without conversation id are one conversation. A row marked as
gone only names its conversation. A conversation without rows has zeros, an empty audit
and the digest of the empty text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, KEEP, RENAME, TRUNCATED = 4, 3, 0, 3, 3
INITIALS = "sua"
LEGAL = ("su", "ua", "au")
NONE, CUT, DUPLICATE, BLANK = range(4)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_NEVER = 1 << 60
#: Rows of a run that are unrolled one by one.
_SHORT = 16
Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + y for x, y in zip(row, column)) for column in zip(*b)) for row in a)


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


def _inserts() -> Matrix:
    """Cost of reaching one state from another by inserted turns alone."""
    out = [[_NEVER] * 4 for _ in range(4)]
    for state in range(4):
        at, cost = state, 0
        while out[state][at] == _NEVER:
            out[state][at] = cost
            at, cost = _NEXT[at], cost + INSERT
    return tuple(map(tuple, out))


_INSERTS = _inserts()
#: Cost of ending a conversation in each state.
END = _apply(_INSERTS, (0, _NEVER, _NEVER, 0))


def _choices(symbol: tuple[str, int], state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state after it) for a row that comes next, in the order of the edits' initials."""
    initial, fault = symbol
    yield "D", DELETE, state
    if fault <= CUT:
        more = TRUNCATED if fault == CUT else 0
        if state in _KEPT.get(initial, {}):
            yield "K", KEEP + more, _KEPT[initial][state]
        yield "R", RENAME + more, _NEXT[state]


@lru_cache(maxsize=None)
def _power(symbol: tuple[str, int], k: int) -> Matrix:
    """Matrix of ``2 ** k`` rows of a symbol; there are some 16 symbols."""
    if k:
        half = _power(symbol, k - 1)
        return _times(half, half)
    row = [[_NEVER] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, after in _choices(symbol, state):
            row[state][after] = min(row[state][after], cost)
    return _times(_INSERTS, tuple(map(tuple, row)))


@lru_cache(maxsize=1 << 16)
def _before_small(symbol: tuple[str, int], n: int, v: Vector) -> Vector:
    k = 0
    while n:
        if n & 1:
            v = _apply(_power(symbol, k), v)
        n >>= 1
        k += 1
    return v


def before(symbol: tuple[str, int], n: int, v: Vector) -> Vector:
    """Cost vector before ``n`` rows of a symbol, given that after them."""
    least = min(v)
    return tuple(x + least for x in _before_small(symbol, n, tuple(x - least for x in v)))


@lru_cache(maxsize=1 << 16)
def _unrolled(symbol: tuple[str, int], n: int, state: int, v: Vector) -> tuple[str, int]:
    """Least edits of a run, and the state after them; ``v`` is the cost vector after the run, its minimum 0."""
    if n > _SHORT:
        half = n // 2
        middle = _before_small(symbol, n - half, v)
        first, state = _unrolled(symbol, half, state, tuple(x - min(middle) for x in middle))
        second, state = _unrolled(symbol, n - half, state, v)
        return first + second, state
    vectors = [v]
    for _ in range(n):
        vectors.append(_apply(_power(symbol, 0), vectors[-1]))
    out = []
    for after in vectors[n - 1::-1]:
        here = _apply(_power(symbol, 0), after)
        while True:
            edit, reached = next(
                (edit, reached) for edit, cost, reached, costs in sorted(
                    [*((e, c, s, after) for e, c, s in _choices(symbol, state)), ("I", INSERT, _NEXT[state], here)], key=lambda x: x[0])
                if cost + costs[reached] == here[state])
            out.append(edit)
            state = reached
            if edit != "I":
                break
    return "".join(out), state


def cheapest(runs: list[tuple[tuple[str, int], int]]) -> tuple[int, str]:
    """Cost of the cheapest edits of a conversation's runs, and their initials."""
    after = [END]
    for symbol, n in reversed(runs):
        after.append(before(symbol, n, after[-1]))
    cost, state, out = after.pop()[START], START, []
    for symbol, n in runs:
        v = after.pop()
        least = min(v)
        edits, state = _unrolled(symbol, n, state, tuple(x - least for x in v))
        out.append(edits)
    return cost, "".join(out) + "I" * (END[state] // INSERT)


class _Conversation:
    """What a task knows of the conversation that is passing."""

    def __init__(self, key) -> None:
        self.key = key
        self.runs: list[list] = []
        self.n = dict.fromkeys(COUNTS, 0)
        self.turns = [0, None, None]
        self.initial: str | None = None
        self.audit: str | None = None
        self.at = self.place = 0
        self.state = START
        self.digest = hashlib.sha256()

    def see(self, turn: int | None, initial: str, fault: int) -> None:
        symbol = (initial, NONE if fault == NONE else fault if fault == CUT else BLANK)
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])
        for name, one in (("truncated", CUT), ("duplicate", DUPLICATE), ("blank", BLANK)):
            self.n[name] += fault == one
        self.n["illegal"] += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        distinct, first, last = self.turns
        if turn is not None and turn != last:
            self.turns = [distinct + 1, turn if first is None else first, turn]

    def decide(self) -> None:
        if self.audit is None:
            self.n["cost"], self.audit = cheapest(self.runs)
            distinct, first, last = self.turns
            self.n["gaps"] = last - first + 1 - distinct if distinct else 0

    def _say(self, role: str, text: str, edit: str, turn: int | None) -> tuple:
        self.digest.update(("\n" * (self.place > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.place += 1
        return self.key, self.place, role, text, edit, turn

    def _inserted(self) -> Iterator[tuple]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.state = _NEXT[self.state]
            yield self._say(_ROLE[self.state], "", "I", None)

    def repair(self, turn: int | None, initial: str, role: str, text: str) -> Iterator[tuple]:
        """Repaired rows up to this one."""
        self.decide()
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.state = _KEPT[initial][self.state] if edit == "K" else _NEXT[self.state]
            yield self._say(role if edit == "K" else _ROLE[self.state], text, edit, turn)

    def close(self) -> Iterator[tuple]:
        self.decide()
        yield from self._inserted()

    def summary(self) -> tuple:
        return self.key, *(self.n[c] for c in COUNTS), self.audit, self.digest.hexdigest()


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by a checksum of conversation and turn; those it drops stay, marked in ``gone``."""
    shown = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn))), F.lit(20))
    chosen = rows.select(conv, turn, shown(role).alias(role), shown(text).alias(text), fate.alias("gone"))
    return chosen.withColumns({
        text: F.when(F.col("gone") == 1, "").when(F.col("gone") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text)),
        role: F.when(F.col("gone") == 4, "user").otherwise(F.col(role)),
    }).withColumn("gone", F.explode(
        F.when(F.col("gone") == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(F.col("gone") == 0))))


def _stream(rows: DataFrame, conv: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    """Each conversation's rows in order: first without, then with their texts."""
    one = lambda name: F.coalesce(F.col(name), F.lit(" "))
    said = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), one(role).alias("role"), one(text).alias("text"),
        (F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).alias("gone")).repartition("conv")
    by_turn = F.asc_nulls_first("turn")
    seen = Window.partitionBy("conv", "gone", "role", "text").orderBy(by_turn)
    order = Window.partitionBy("conv").orderBy(by_turn, "role", "text", "nth")
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("nth") > 1, DUPLICATE)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(NONE))
    initial = F.substring("role", 1, 1)
    placed = said.withColumn("nth", F.row_number().over(seen)).select(
        "conv", "turn", "role", "text", "gone", F.row_number().over(order).alias("pos"), fault.alias("fault"),
        F.when(initial.isin(*INITIALS), initial).otherwise("?").alias("initial"))
    hidden = lambda name: F.lit(None).cast("string").alias(name)
    passes = F.array(F.struct(F.lit(0).alias("pass"), hidden("role"), hidden("text")), F.struct(F.lit(1).alias("pass"), "role", "text"))
    return placed.withColumn("p", F.explode(F.when(F.col("gone"), F.slice(passes, 1, 1)).otherwise(passes))).select(
        "conv", "turn", "gone", "pos", "fault", "initial", "p.*").sortWithinPartitions("conv", "pass", "pos")


def _repairing(schema: T.StructType, rows_wanted: bool):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def events(batches) -> Iterator[tuple]:
        now = None
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("conv", "turn", "gone", "fault", "initial", "pass", "role", "text"))
            for key, turn, gone, fault, initial, again, role, text in zip(*columns):
                if now is None or now.key != key:
                    if now is not None:
                        yield from closed(now)
                    now = _Conversation(key)
                if again:
                    for row in now.repair(turn, initial, role, text):
                        if rows_wanted:
                            yield row
                elif not gone:
                    now.see(turn, initial, fault)
        if now is not None:
            yield from closed(now)

    def closed(conversation: _Conversation) -> Iterator[tuple]:
        rest = [*conversation.close()]
        yield from rest if rows_wanted else [conversation.summary()]

    def repairing(batches):
        found = events(batches)
        while rows := [*itertools.islice(found, 500)]:
            yield batch_of(rows)

    return repairing


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           gone: str | None = None) -> DataFrame:
    """One row for each conversation: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
    schema = T.StructType([
        T.StructField("conv", rows.schema[conv].dataType), *[T.StructField(c, T.LongType()) for c in COUNTS],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    out = _stream(rows, conv, turn, role, text, gone).mapInArrow(_repairing(schema, False), schema)
    return out.withColumnRenamed("conv", conv)


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             gone: str | None = None) -> DataFrame:
    """The repaired conversations: (conv, place, role, text, edit, turn), ``turn`` null for inserted rows."""
    schema = T.StructType([
        T.StructField("conv", rows.schema[conv].dataType), T.StructField("place", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("edit", T.StringType()), T.StructField("turn", T.LongType())])
    return _stream(rows, conv, turn, role, text, gone).mapInArrow(_repairing(schema, True), schema)
