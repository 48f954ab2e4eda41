"""Secrets in texts, found with an inverted index of trigrams.

From each rule's pattern follows a Boolean query: clauses that must all hold, each a
choice of strings of which one must occur, each string all its trigrams. The index
lists, for every trigram of some query, the documents whose folded text has it.
Intersecting the lists gives each rule's candidates, and only they are searched with
the pattern. A rule from which no trigram follows searches every document.

Built-in expressions only. Places are code points, ends exclusive. Null and empty
texts have no secrets. Repeated rows, with or without id, each get their spans. An
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import IGNORECASE, _constants as op, _parser

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage


@dataclass(frozen=True)
class Rule:
    """A pattern, and the group that must have some length for a match to count."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    ignore_case: bool = False

    @property
    def regex(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


# Patterns and least lengths, in the order of kinds. The first three are the base rules.
# {12,} and {32,} find just those matches of + that are long enough, since no match of theirs can begin inside a shorter one.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}", 40),
    Rule("google", r"AIza[0-9A-Za-z_-]{35,}", 39),
    Rule("slack", r"xox[abp]-[0-9A-Za-z-]{10,}", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 27),
)
BASE = ("assign", "access", "hex")
SPANS = "array<struct<start: long, end: long, kind: string>>"
_MOST_STRINGS = 64


def _literal_runs(items, strings: set[str], runs: list[set[str]]) -> set[str]:
    """Follows a pattern; ``strings`` are what the current stretch can read, finished stretches go to ``runs``."""
    def end() -> set[str]:
        runs.append(strings)
        return {""}

    for code, arg in items:
        choices: set[str] | None = None
        if code is op.LITERAL:
            choices = {chr(arg)}
        elif code is op.IN and all(c is op.LITERAL for c, _ in arg):
            choices = {chr(a) for _, a in arg}
        elif code is op.SUBPATTERN:
            strings = _literal_runs(arg[-1], strings, runs)
            continue
        elif code is op.BRANCH:
            inner: list[set[str]] = []
            ways = [_literal_runs(way, {""}, inner) for way in arg[1]]
            choices = None if inner else set().union(*ways)
        elif code is op.MAX_REPEAT and arg[1] == 1:
            inner = []
            way = _literal_runs(arg[2], {""}, inner)
            choices = None if inner else way | ({""} if arg[0] == 0 else set())
        if choices is None or len(strings) * len(choices) > _MOST_STRINGS:
            strings = end()
        else:
            strings = {s + c for s in strings for c in choices}
    return strings


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def trigram_query(rule: Rule) -> list[list[frozenset[str]]]:
    """Clauses that all hold for a match; of each, one set of trigrams is there in full. Empty: nothing follows."""
    runs: list[set[str]] = []
    runs.append(_literal_runs(_parser.parse(rule.pattern, IGNORECASE if rule.ignore_case else 0), {""}, runs))
    clauses = []
    for strings in runs:
        sets = {trigrams(s.lower()) for s in strings}
        if frozenset() not in sets:
            clauses.append(sorted((a for a in sets if not any(b < a for b in sets)), key=sorted))
    return clauses


def trigram_index(docs: DataFrame, wanted: list[str], key: tuple[str, ...], text: str = "text") -> DataFrame:
    """(trigram, *key): each wanted trigram's documents, written out in the order of trigrams."""
    folded = docs.select(*key, F.lower(text).alias("folded"))
    has = F.array_compact(F.array(*(F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in wanted)))
    return stage(folded.select(F.explode(has).alias("trigram"), *key).sortWithinPartitions("trigram"), "trigrams")


def candidates(index: DataFrame, rules: tuple[Rule, ...], key: tuple[str, ...]) -> DataFrame:
    """(*key, kinds): for each document the rules whose trigram query it meets."""
    spark = index.sparkSession
    rows = [(r.kind, c, a, t, len(way), len(trigram_query(r)))
            for r in rules for c, clause in enumerate(trigram_query(r)) for a, way in enumerate(clause) for t in sorted(way)]
    query = spark.createDataFrame(rows, "kind string, clause int, way int, trigram string, n_trigrams int, n_clauses int")
    # the rules bound this table; the index is what must not be shuffled by a frequent trigram
    met = index.join(F.broadcast(query), "trigram").distinct().groupBy(*key, "kind", "clause", "way", "n_trigrams", "n_clauses").count()
    met = met.where("count = n_trigrams").select(*key, "kind", "clause", "n_clauses").distinct()
    met = met.groupBy(*key, "kind", "n_clauses").count().where("count = n_clauses")
    return met.groupBy(*key).agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule) -> Column:
    """Matches of one rule: the lengths of what lies between and of the matches add up to places."""
    regex = F.lit(rule.regex)
    found = F.arrays_zip(
        F.split(text, rule.regex, -1).alias("gap"), F.regexp_extract_all(text, regex, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, regex, F.lit(rule.group)).alias("part"))

    def add(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(
            F.length(x["part"]) >= rule.least, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(found, zero, add, lambda acc: acc["spans"])


def in_order(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans by start, then in the order of the rules."""
    rank = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)))
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
               spans_col: str = "spans") -> DataFrame:
    """``docs`` with the spans of all rules; working columns begin with ``_s_``."""
    key = ("_s_id", "_s_hash")
    keyed = docs.withColumns({"_s_id": F.col(id_col), "_s_hash": F.xxhash64(text_col)})
    queries = {r.kind: trigram_query(r) for r in rules}
    indexed = tuple(r for r in rules if queries[r.kind])
    wanted = sorted({t for r in indexed for clause in queries[r.kind] for way in clause for t in way})
    if indexed:
        index = trigram_index(keyed.select(*key, F.col(text_col).alias("text")), wanted, key)
        found = stage(candidates(index, indexed, key), "candidates")
        found = found.select(F.col("_s_id").alias("_s_of"), F.col("_s_hash").alias("_s_with"), F.col("kinds").alias("_s_kinds"))
        keyed = keyed.join(found, F.col("_s_id").eqNullSafe(F.col("_s_of")) & (F.col("_s_hash") == F.col("_s_with")), "left")
    else:
        keyed = keyed.withColumn("_s_kinds", F.lit(None).cast("array<string>"))
    text, none = F.coalesce(F.col(text_col), F.lit("")), F.array().cast(SPANS)
    per_rule = [F.when(F.array_contains("_s_kinds", r.kind) if queries[r.kind] else text.rlike(r.regex), _spans(text, r))
                .otherwise(none) for r in rules]
    all_spans = reduce(lambda a, b: F.concat(a, b), per_rule)
    return keyed.withColumn(spans_col, in_order(all_spans, rules)).drop("_s_id", "_s_hash", "_s_of", "_s_with", "_s_kinds")


def spans_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of overlapping spans replaced by a mark."""
    def put(acc, s):
        between = F.substring(text, acc["end"] + 1, F.greatest(s["start"] - acc["end"], F.lit(0)))
        new = F.when(s["start"] >= acc["end"], F.concat(acc["out"], between, F.lit(mark))).otherwise(acc["out"])
        return F.struct(new.alias("out"), F.greatest(acc["end"], s["end"].cast("int")).alias("end"))

    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("end"))
    return F.aggregate(spans, zero, put, lambda acc: F.concat(acc["out"], F.substring(text, acc["end"] + 1, F.length(text))))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs``, same columns, with secrets in the text replaced; texts without stay as they are, null too."""
    found = with_spans(docs, id_col, text_col, rules, "_s_spans")
    new = F.when(F.size("_s_spans") > 0, redacted(F.col(text_col), F.col("_s_spans"))).otherwise(F.col(text_col))
    return found.withColumn(text_col, new).select(*docs.columns)
