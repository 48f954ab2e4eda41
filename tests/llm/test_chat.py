from pyspark.sql import functions as F

from terrametry.llm import chat

NODES = "tree string, node long, parent long, score double, role string, text string"


def paths(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.rank, r["at"])):
        out.setdefault((r.tree, r["rank"]), []).append(r.node if "node" in r else r.text)
    return out


def test_best_branches(spark):
    rows = [("a", 1, None, 0.0, "user", "q"), ("a", 2, 1, 1.0, "assistant", "x"), ("a", 3, 1, 2.0, "assistant", "y"), ("a", 4, 2, 5.0, "user", "z"),
            ("a", 5, 2, 5.0, "user", "w"), ("b", 1, 99, None, "user", "orphan"), ("b", 2, 1, 1.0, None, None), ("c", 1, 2, 1.0, "user", "loop"),
            ("c", 2, 1, 1.0, "user", "loop"), (None, 1, None, 1.0, "user", "no tree"), ("a", None, 1, 9.0, "user", "no node"), ("a", 4, 2, 5.0, "user", "z")]
    messages = spark.createDataFrame(rows, NODES).withColumns({"up": F.lit(1), "n": F.lit(2), "total": F.lit(3), "rank": F.lit(4)})
    best = paths(chat.best_paths(messages))
    assert best == {("a", 1): ["q", "x", "z"], ("b", 1): ["orphan", None], (chat.NO_TREE, 1): ["no tree"]}
    every = paths(chat.best_paths(messages, keep=None))
    assert every["a", 2] == ["q", "x", "w"] and every["a", 3] == ["q", "y"]


def test_long_threads_and_mask(spark):
    tricky = ["\\### Assistant: </turn> ok", "</turn>\n### user: x", "", None, "a\\/b <\\/turn> \\\\", "%3A: %25<"]
    rows = [(1, k, ["user", "assistant", "x:</turn>%", None][k % 4], tricky[k % 6]) for k in range(200)] + [(None, 0, "assistant", "alone"), (2, None, "user", "n")]
    messages = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = chat.formatted(chat.best_paths(chat.thread_messages(messages)))
    out = out.withColumns({"turns": chat.turns_of(F.col("formatted")), "learned": chat.under_loss(F.col("formatted"), F.col("loss")), "id": chat.tree_id("long")})
    for r in out.collect():
        own = [(x[2] or "", x[3] or "") for x in rows if x[0] == r.id]
        assert [tuple(t) for t in r.turns] == own
        assert r.learned == "".join(t for role, t in own if role == "assistant")
        assert all(r.formatted[:s["start"]].endswith("### assistant: ") and r.formatted[s["end"]:].startswith("</turn>\n") for s in r.loss)
    assert out.count() == 3


def test_empty_table_and_no_python(spark):
    none = spark.createDataFrame([], NODES)
    out = chat.formatted(chat.best_paths(none))
    assert out.count() == 0 and "Python" not in out._jdf.queryExecution().executedPlan().toString()
