"""Registered queries of the subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, chat, decontaminate, exact_dedup, jaccard, lexical, licenses, quality, secrets, suffix_dedup, toxicity, turns, warc

Build = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "stratum", "strictness", "level")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(table(spark, sf_dir, "documents"), path, decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema))
    out = chat.formatted(chat.best_paths(chat.thread_messages(rows)))
    out = out.withColumns({"turns": chat.turns_of(F.col("formatted")), "learned": chat.under_loss(F.col("formatted"), F.col("loss"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        chat.tree_id("long").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.with_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *(count(k) for k in secrets.BASE), F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(toxicity.fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "text_digest", F.array_join("licenses", ",").alias("licenses"), F.array_join("notices", ",").alias("notices"))


def op8_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("matches", F.lit(0).cast("long"), lambda n, m: n + m["end"] - m["start"])
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["longest"])), F.lit(0).cast("long"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("matches") > 0).alias("contaminated"),
        longest.alias("longest_match"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10).select(
        F.col("query").alias("item_id"), "rank", "doc_id", "score")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damaged(table(spark, sf_dir, "conversations")), gone="gone")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


QUERIES: dict[str, Build] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_warc": op2_warc,
    "op3_bpe": op3_bpe,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_reply_trees": op5_reply_trees,
    "op6_secrets": op6_secrets,
    "op7_toxicity": op7_toxicity,
    "op9_licenses": op9_licenses,
    "op8_benchmark_passages": op8_benchmark_passages,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_structure_repair": op12_structure_repair,
    "op13_exact_dedup": op13_exact_dedup,
}


def _spelled(form: str) -> str:
    """SQL for equivalent spellings made one; words stand between two blanks meanwhile, so that each has its own."""
    out = f"' ' || replace({form}, ' ', '  ') || ' '"
    for spelling, one in licenses.EQUIVALENT.items():
        out = f"replace({out}, ' {spelling.replace(' ', '  ')} ', ' {one} ')"
    return f"trim(replace({out}, '  ', ' '))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LINE = r"trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g'))"
def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _quoted(v) for v in row) + ")" for row in rows)


_ENTRIES = list(enumerate(licenses.license_entries()))
_MARKS = sorted({mark for _, e in _ENTRIES for mark in e["swaps"]})
_FORMS = _values((i, name, "".join(e["parts"][:k + 1])) for i, e in _ENTRIES for name in e["names"] for k in range(len(e["parts"])))
_WORDINGS = _values((i, mark, wording) for i, e in _ENTRIES for mark, wordings in e["swaps"].items() for wording in wordings)
_TITLES = _values((i, title) for i, e in _ENTRIES for title in ["", *(f"{t}\n\n" for t in e["titles"])])
_SWAPPED = ", ".join(
    f"worded{k + 1} AS (SELECT f.e, name, replace(text, {_quoted(mark)}, coalesce(wording, '')) AS text FROM worded{k} f "
    f"LEFT JOIN wordings w ON w.e = f.e AND w.mark = {_quoted(mark)})" for k, mark in enumerate(_MARKS))
_NAMED = f"regexp_extract(form, {_quoted(licenses.BEFORE_NAME)}, 1)"
LICENSES_SQL = f"""
    WITH worded0 AS (SELECT * FROM (VALUES {_FORMS}) AS f(e, name, text)),
         wordings AS (SELECT * FROM (VALUES {_WORDINGS}) AS w(e, mark, wording)),
         titles AS (SELECT * FROM (VALUES {_TITLES}) AS t(e, title)), {_SWAPPED},
         listed AS (SELECT name, title || text AS text, '' AS mark FROM worded{len(_MARKS)} JOIN titles USING (e)
                    UNION ALL SELECT *, '' FROM (VALUES {_values([*licenses.KNOWN, *licenses.notice_lines()])}) AS k(name, text)
                    UNION ALL SELECT *, '{licenses.NAMED}' FROM (VALUES {_values(licenses.license_names())}) AS k(name, text)),
         texts AS (SELECT row_number() OVER () AS n, doc_id, NULL AS name, NULL AS mark, text FROM documents
                   UNION ALL SELECT -row_number() OVER (), NULL, name, mark, text FROM listed),
         lines AS (SELECT n, doc_id, name, mark, list_filter(list_transform(
                       string_split(coalesce(text, ''), chr(10)), lambda line: CASE
                       WHEN regexp_matches(line, {_quoted(licenses.NOTICE_LINE)}) AND NOT regexp_matches(line, {_quoted(licenses.BODY_LINE)})
                       THEN '' ELSE {_spelled(_LINE)} END),
                       lambda form: form <> '') AS forms FROM texts),
         canonical AS (SELECT *, {_spelled("array_to_string(forms, ' ')")} AS whole FROM lines),
         known AS (SELECT DISTINCT mark || whole AS form, name FROM canonical WHERE n < 0 AND whole <> ''),
         docs AS (SELECT n, doc_id, forms, whole FROM canonical WHERE n > 0),
         every AS (SELECT n, whole AS form, true AS of_whole FROM docs UNION SELECT n, unnest(forms), false FROM docs),
         asked AS (SELECT n, form, of_whole FROM every UNION SELECT n, '{licenses.NAMED}' || {_NAMED}, of_whole FROM every WHERE {_NAMED} <> ''),
         named AS (SELECT n, of_whole, string_agg(name, ',' ORDER BY name) AS names
                   FROM (SELECT DISTINCT n, of_whole, name FROM asked JOIN known USING (form)) GROUP BY ALL)
    SELECT doc_id, md5(whole) AS text_digest, coalesce(w.names, '') AS licenses, coalesce(l.names, '') AS notices
    FROM docs LEFT JOIN named w ON w.n = docs.n AND w.of_whole LEFT JOIN named l ON l.n = docs.n AND NOT l.of_whole"""

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          rf"'{lexical.TERM}')")
SQL: dict[str, str] = {
    "op11_lexical_search": rf"""
        WITH split AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
             docs AS (SELECT r, len(terms) AS n FROM split WHERE len(terms) > 0),
             sums AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
             wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
             tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest(terms) AS term FROM split)
                     WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
             weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
                         FROM tfs, sums GROUP BY term, n_docs),
             impacts AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS impact
                         FROM tfs JOIN docs USING (r) JOIN weights USING (term), sums),
             scores AS (SELECT item_id, r, doc_id, sum(impact)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY ALL)
        SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10""",
    "op13_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op4_jaccard_join": r"""
        WITH RECURSIVE
             split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
             sets AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                          ELSE list_distinct(list_transform(range(1, len(words) - 3),
                              lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles FROM split),
             flat AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
             links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM flat AS a JOIN flat AS b USING (shingle) WHERE a.doc_id <> b.doc_id
                       GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
             reached AS (SELECT doc_id AS origin, doc_id AS node FROM sets
                         UNION SELECT origin, b FROM reached JOIN links ON node = a WHERE origin < b)
        SELECT doc_id, len(shingles) AS n_shingles, component_id
        FROM sets JOIN (SELECT node AS doc_id, min(origin) AS component_id FROM reached GROUP BY node) USING (doc_id)""",
    "op9_licenses": LICENSES_SQL,
    "op5_reply_trees": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
             e AS (SELECT *, replace(replace(replace(role, '%', '%25'), ':', '%3A'), '<', '%3C') AS head,
                          replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '###', '\###') AS body FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(14 + length(head) + length(body))::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
             q AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest FROM p),
             r AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS first FROM q)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < first THEN first END AS refers_to
        FROM r""",
}
