"""Conversations from reply trees: best branch of each tree, formatted for training.

Messages name their parent. Self-joins double how far each message sees: after k
rounds it knows the ancestor 2^k above it and the score in between, so paths of any
length take a logarithmic number of joins. Leaves are ranked within their tree by the
total score of their path, then by its length, then by the smaller message; the
chosen leaves' paths are listed by the same jumps and each is formatted as one text.

A turn is ``### role: text</turn>`` and a line feed. Inside texts a backslash stands
before a backslash, before ``###`` and within ``</turn>``, so no text can look like a
mark, and formatting can be undone. The loss mask lists where the learned roles' texts
lie, in code points.

Built-in expressions only. Null texts and roles are empty. Messages with null tree
are one tree. A message whose parent is null or missing is a root. Messages on a
cycle of parents have no root and no path. Messages with null id are left out; of
those that share tree and id the smallest counts. An empty table gives no rows. One
conversation is one row of the result, and must fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

END = "</turn>"
NO_TREE = "\u0000"
LOSS = "array<struct<start: long, end: long>>"


def escaped(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(END), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("###"), F.lit("\\###"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    role = F.coalesce(role, F.lit(""))
    for plain, code in (("%", "%25"), (":", "%3A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _role_back(role: Column) -> Column:
    for plain, code in (("<", "%3C"), (":", "%3A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def thread_messages(rows: DataFrame, tree_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """Plain conversations as trees: each row answers the one before it; equal turns by role, then text."""
    tree = F.coalesce(F.col(tree_col).cast("string"), F.lit(NO_TREE))
    rows = rows.select(tree.alias("tree"), F.col(order_col).alias("at"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    node = F.row_number().over(Window.partitionBy("tree").orderBy("at", "role", "text")).cast("long")
    return rows.select("tree", node.alias("node"), "role", "text").select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def _jumps(messages: DataFrame) -> list[DataFrame]:
    """(tree, node, up, total, n) for 1, 2, 4 ... steps; ``total`` and ``n`` of the nodes from ``node`` to below ``up``."""
    own = messages.select("tree", "node", F.col("parent").alias("up"), "score")
    there = messages.select(F.col("tree").alias("tree"), F.col("node").alias("up"), F.lit(True).alias("found"))
    first = own.join(there, ["tree", "up"], "left").select(
        "tree", "node", F.when(F.col("found"), F.col("up")).alias("up"),
        F.coalesce("score", F.lit(0.0)).alias("total"), F.lit(1).cast("long").alias("n"))
    jumps = [stage(first, "jumps")]
    n_nodes = jumps[0].count()
    while 2 ** (len(jumps) - 1) <= n_nodes and jumps[-1].where("up is not null").take(1):
        last = jumps[-1]
        beyond = last.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"), F.col("n").alias("m"))
        doubled = last.where("up is not null").join(beyond, ["tree", "up"]).select(  # those at their root stay as they are
            "tree", "node", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("n") + F.col("m")).alias("n"))
        jumps.append(stage(last.where("up is null").unionAll(doubled), "jumps"))
    return jumps


def best_paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, at, role, text): messages of the ``keep`` best paths of each tree (all: None), ``at`` from 0."""
    messages = messages.where("node is not null").groupBy(F.coalesce("tree", F.lit(NO_TREE)).alias("tree"), "node").agg(
        F.min(F.struct("parent", "score", "role", "text")).alias("m")).select("tree", "node", "m.*")
    messages = stage(messages, "messages")
    jumps = _jumps(messages)
    parents = messages.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = jumps[-1].where("up is null").join(parents, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("n"), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(order))
    if keep is not None:
        leaves = leaves.where(F.col("rank") <= keep)
    path = stage(leaves.select("tree", F.col("node").alias("leaf"), "rank", "n", "node", F.lit(0).cast("long").alias("up_by")), "paths")
    for k, jump in enumerate(jumps[:-1]):
        above = path.join(jump.where("up is not null").select("tree", "node", "up"), ["tree", "node"])
        above = above.select("tree", "leaf", "rank", "n", F.col("up").alias("node"), (F.col("up_by") + 2 ** k).alias("up_by"))
        path = path.unionAll(stage(above, "paths"))
    return path.join(messages.select("tree", "node", "role", "text"), ["tree", "node"]).select(
        "tree", "leaf", "rank", (F.col("n") - 1 - F.col("up_by")).alias("at"), "role", "text")


def formatted(paths: DataFrame, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(tree, leaf, rank, formatted, loss): one text for each path, and where its loss mask lies."""
    turn = F.struct("at", F.concat(F.lit("### "), _role(F.col("role")), F.lit(": ")).alias("head"), escaped(F.col("text")).alias("body"),
                    F.coalesce(F.col("role").isin(*learned), F.lit(False)).alias("learned"))
    turns = paths.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")

    def add(acc, t):
        start = acc["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END) + 1).alias("at"), F.when(
            t["learned"], F.concat(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(LOSS).alias("loss"))
    return turns.select("tree", "leaf", "rank", text.alias("formatted"), F.aggregate("turns", zero, add, lambda acc: acc["loss"]).alias("loss"))


def turns_of(text: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    parts = F.filter(F.split(text, END + "\n", -1), lambda part: part != "")
    return F.transform(parts, lambda part: F.struct(
        _role_back(F.substring(part, F.lit(5), F.locate(": ", part) - 5)).alias("role"),
        unescaped(F.substring(part, F.locate(": ", part) + 2, F.length(part))).alias("text")))


def under_loss(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(
        F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def tree_id(kind: str) -> Column:
    """The tree's id as it was given."""
    return F.nullif(F.col("tree"), F.lit(NO_TREE)).cast(kind)
