"""Quality rules with risk-controlled cutoffs.

Each rule compares one statistic of a text with a cutoff. ``LEVELS`` lists sets of
cutoffs from lenient to strict, fixed beforehand; a text rejected at one level is
rejected at every stricter one. Labelled documents are the holdout: for each stratum
and level, the good ones rejected are counted, and the exact binomial probability of so
few or fewer, were the true rate of false rejection ``ALPHA``, is the level's p-value.

Multiple tests: within a stratum levels are tested in order and testing stops at the
first that fails (fixed sequence, no further correction); across strata the error
``DELTA`` is divided by their number (Bonferroni). So with probability 1 - DELTA no
stratum's certified level rejects more than ALPHA of its good documents. Of the
certified levels the one with most bad documents rejected counts, a good one
weighing ``GOOD_WEIGHT`` bad ones, the most lenient of equals; where none gains, no
level is used.

Built-in expressions only. Null text has no words. Null strata are one stratum of
their own (the empty name). A document labelled twice counts as good if one label
says so; labels without document, id or value are ignored; documents that share an
id each take its label. A stratum without labels rejects nothing beyond the base
rules. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

WHITE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Cutoffs by rule, lenient to strict; a text beyond one is rejected at that level.
LEVELS = {
    "symbols_per_word": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02),
    "duplicate_lines": (0.9, 0.7, 0.6, 0.55, 0.5, 0.45, 0.4, 0.35),
    "capitals": (0.9, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "word_length": (30.0, 20.0, 16.0, 14.0, 13.0, 12.0, 11.0, 10.0),
}
N_LEVELS = 8
ALPHA, DELTA, GOOD_WEIGHT = 0.02, 0.05, 5
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _length_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, "")).cast("long")


def _repeated(places: Column) -> Column:
    """Words covered by windows at the given sorted places."""
    step = lambda acc, p: F.struct(
        (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).cast("long").alias("n"), (p + WINDOW).cast("long").alias("end"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(places, zero, step, lambda acc: acc["n"])


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with :data:`COUNTS`, ``n_lines`` and ``n_capitals``; working columns begin with ``_q_``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+", -1))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    out = docs.withColumns({"_q_words": words, "_q_lines": lines})
    out = out.withColumns({
        "_q_hashes": F.transform("_q_words", lambda w: F.xxhash64(w)),
        "n_words": F.size("_q_words").cast("long"), "n_lines": F.size("_q_lines").cast("long"),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "word_chars": _length_without(text, WHITE),
        "n_symbols": F.length(text) - _length_without(text, SYMBOLS),
        "n_capitals": F.length(text) - _length_without(text, CAPITALS),
    })
    at = lambda i, k: F.get("_q_hashes", i + k)
    starts = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")))
    out = out.withColumn("_q_windows", F.transform(starts, lambda i: F.xxhash64(*(at(i, k) for k in range(WINDOW)))))
    out = out.withColumn("_q_sorted", F.when(
        F.size("_q_windows") > F.size(F.array_distinct("_q_windows")),
        F.sort_array(F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = lambda x, j: F.when(
        F.get("_q_sorted", j - 1)["h"].eqNullSafe(x["h"]) | F.get("_q_sorted", j + 1)["h"].eqNullSafe(x["h"]), x["i"])
    places = F.sort_array(F.filter(F.transform("_q_sorted", twice), lambda i: i.isNotNull()))
    out = out.withColumn("n_repeat_words", F.coalesce(_repeated(places), F.lit(0).cast("long")))
    return out.drop("_q_words", "_q_lines", "_q_hashes", "_q_windows", "_q_sorted")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def strictness() -> Column:
    """The most lenient level that rejects a text, ``N_LEVELS`` if none does."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    value = {
        "symbols_per_word": F.col("n_symbols") / words,
        "duplicate_lines": F.col("n_dup_lines") / lines,
        "capitals": F.col("n_capitals") / F.greatest("word_chars", F.lit(1)),
        "word_length": F.col("word_chars") / words,
    }
    passed = [sum((value[rule] <= cut).cast("int") for cut in cuts) for rule, cuts in LEVELS.items()]
    return F.least(*passed)


def _log_gamma(x: Column) -> Column:
    """Stirling's series ten places up, good to some 13 digits."""
    y = x + 10
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (
        1260 * F.pow(y, F.lit(5)))
    product = x
    for k in range(1, 10):
        product = product * (x + k)
    return series - F.log(product)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """Exact probability of at most ``k`` successes in ``n``; 1 from the mean on, where no test could pass.

    Terms fall geometrically below the mean; those left out add less than 1e-17 of the sum.
    """
    n, k = n.cast("double"), k.cast("double")
    at_k = F.exp(_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
                 + k * math.log(p) + (n - k) * math.log1p(-p))
    steps = F.sequence(F.lit(0), F.least(k, 100 + 40 * F.ceil(F.sqrt(n))).cast("int"))
    step = lambda acc, j: F.struct(
        (acc["term"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("term"), (acc["total"] + acc["term"]).alias("total"))
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
    return F.when(k >= n * p, 1.0).otherwise(at_k * F.aggregate(steps, zero, step, lambda acc: acc["total"]))


def certify(counted: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, level) in use, from (stratum, strictness, n_good, n_bad): labelled texts by the level that rejects them.

    ``level`` is the strictest index in use, -1 for none.
    """
    strata = counted.select("stratum").distinct()
    levels = strata.select("stratum", F.explode(F.sequence(F.lit(0), F.lit(N_LEVELS))).alias("strictness"))
    own = Window.partitionBy("stratum")
    so_far = own.orderBy("strictness")
    table = levels.join(counted, ["stratum", "strictness"], "left").select(
        "stratum", "strictness",
        F.sum(F.coalesce("n_good", F.lit(0))).over(own).alias("good"),
        F.sum(F.coalesce("n_good", F.lit(0))).over(so_far).alias("good_out"),
        F.sum(F.coalesce("n_bad", F.lit(0))).over(so_far).alias("bad_out")).where(F.col("strictness") < N_LEVELS)
    n_strata = max(1, strata.count())
    table = table.withColumn("passed", (binomial_tail(F.col("good"), F.col("good_out"), alpha) <= delta / n_strata).cast("int"))
    table = table.withColumn("certified", F.min("passed").over(so_far))
    gain = (F.col("bad_out") - GOOD_WEIGHT * F.col("good_out")) * F.col("certified")
    best = table.groupBy("stratum").agg(F.max(F.struct(gain.alias("gain"), (-F.col("strictness")).alias("order"))).alias("best"))
    return best.select("stratum", F.when(F.col("best.gain") > 0, -F.col("best.order")).otherwise(-1).cast("int").alias("level"))


def _named(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"))


def _known(labels: DataFrame, label_id: str, label_col: str) -> DataFrame:
    return labels.where(F.col(label_id).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(label_id).alias("doc_id")).agg(F.max(label_col).alias("good"))


def _levels(scored: DataFrame, known: DataFrame, alpha: float, delta: float) -> DataFrame:
    """(stratum, level) in use, by the labelled ones of ``scored`` rows (doc_id, stratum, strictness)."""
    # a bound holds for independent texts: one observation for each labelled id, however often it occurs
    once = scored.select("doc_id", "strictness", "stratum").join(known, "doc_id").groupBy("doc_id", "good").agg(
        F.min(F.struct("strictness", "stratum")).alias("first")).select("first.*", "good")
    counted = once.groupBy("stratum", "strictness").agg(
        F.sum((F.col("good") == 1).cast("long")).alias("n_good"), F.sum((F.col("good") != 1).cast("long")).alias("n_bad"))
    return stage(certify(stage(counted, "holdout"), alpha, delta), "levels")


def _decided(scored: DataFrame, levels: DataFrame) -> DataFrame:
    level = F.coalesce("level", F.lit(-1))
    return scored.join(levels, "stratum", "left").withColumns(
        {"level": level, "kept": ~F.col("base_failed") & (F.col("strictness") > level)})


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          label_id: str = "doc_id", label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(doc_id, text_hash, stratum, counts, base_failed, strictness, level, kept) for every row of ``docs``.

    Rows that share a labelled id are one observation: that of the smallest strictness,
    then of the first stratum.
    """
    scored = statistics(_named(docs, id_col, text_col, stratum_col)).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "stratum", *COUNTS, "n_lines", "n_capitals")
    scored = stage(scored.withColumns({"base_failed": base_failed(), "strictness": strictness()}), "quality")
    return _decided(scored, _levels(scored, _known(labels, label_id, label_col), alpha, delta))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs``, all columns, that the rules keep."""
    gone = judge(docs, labels, id_col, text_col, **options).where("not kept").select(
        F.col("doc_id").alias("_q_id"), F.col("text_hash").alias("_q_hash")).distinct()
    gone = stage(gone, "rejected")
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_q_id"]) & (F.xxhash64(docs[text_col]) == gone["_q_hash"]), "left_anti")
