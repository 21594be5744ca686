"""Reply trees: root-to-leaf paths by iterative self-joins, the best ones formatted as conversations.

Messages (tree_id, node_id, parent_id, score) form trees.  Self-joins by doubling give every message its
2**k-th ancestor and the score on the way, so a path of any length takes log2(length) rounds; a leaf's total
ranks its branch (higher score first, then the smaller leaf), and the chosen paths are listed by running the
jumps again.  Only ids and scores take part; texts join at the end.

Template: ``<turn ROLE>\\n`` text ``\\n</turn>\\n`` for each turn, the role URL-encoded.  A control string in a
text (``<turn`` or ``</turn``) gets one more backslash before it and the backslashes that precede it, so
no text can open or close a turn and removing one backslash restores it.  The loss mask is a list of byte
spans of the formatted text that hold the assistant's texts.

Defined results.  A null text is empty, a null role is the empty role.  A null conversation id is a
conversation of its own.  Equal turns come in the order of role and text; repeated rows are turns of their
own.  A message whose parent is missing is a root; messages on a circle belong to no path.  Extra columns
are not looked at; an empty table gives an empty result.

DataFrame and SQL functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .common import written

CONTROL = r"(\\*</?turn)"
ESCAPED = r"\\(\\*</?turn)"
CLOSE = "\n</turn>\n"
ASSISTANT = "assistant"


def escape(text):
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"\\$1"))


def unescape(text):
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1"))


def best_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """tree_id, leaf, branch (rank from 1), node_id, position (0 at the root) of the ``best`` paths of each tree.

    ``messages`` has tree_id, node_id (unique in a tree), parent_id and score, none of them null but parent_id.
    """
    nodes = written(messages.select("tree_id", "node_id", "parent_id", F.col("score").cast("double").alias("score")))
    ids = nodes.select("tree_id", F.col("node_id").alias("parent_id"))
    jumps = written(nodes.join(ids, ["tree_id", "parent_id"]).select("tree_id", "node_id", F.col("parent_id").alias("to")))
    leaves = nodes.join(jumps.select("tree_id", F.col("to").alias("node_id")), ["tree_id", "node_id"], "left_anti")
    most = nodes.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    rounds = max(1, math.ceil(math.log2(most)) + 1)
    steps, total = [], nodes.select("tree_id", "node_id", F.col("score").alias("sum"))
    while len(steps) < rounds and jumps.limit(1).count():
        steps.append(jumps)
        # the scores of twice as many messages, and the jump over twice as many
        above = jumps.join(total.select("tree_id", F.col("node_id").alias("to"), F.col("sum").alias("more")), ["tree_id", "to"])
        total = written(total.join(above.drop("to"), ["tree_id", "node_id"], "left").select(
            "tree_id", "node_id", (F.col("sum") + F.coalesce("more", F.lit(0.0))).alias("sum")))
        jumps = written(jumps.join(jumps.select("tree_id", F.col("node_id").alias("to"), F.col("to").alias("far")), ["tree_id", "to"])
                        .select("tree_id", "node_id", F.col("far").alias("to")))
    circling = jumps.select("tree_id", "node_id") if len(steps) == rounds else None
    ends = leaves.join(total, ["tree_id", "node_id"])
    if circling is not None:
        ends = ends.join(circling, ["tree_id", "node_id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree_id").orderBy(F.desc("sum"), "node_id"))
    chosen = ends.withColumn("branch", rank).where(F.col("branch") <= best)
    paths = written(chosen.select("tree_id", F.col("node_id").alias("leaf"), "branch", "node_id", F.lit(0).alias("height")))
    for k, jump in enumerate(steps):
        far = paths.join(jump, ["tree_id", "node_id"]).select("tree_id", "leaf", "branch", F.col("to").alias("node_id"),
                                                              (F.col("height") + 2 ** k).alias("height"))
        paths = written(paths.union(far))
    root = F.max("height").over(Window.partitionBy("tree_id", "leaf"))
    return paths.select("tree_id", "leaf", "branch", "node_id", (root - F.col("height")).alias("position"))


def formatted(paths: DataFrame, texts: DataFrame) -> DataFrame:
    """tree_id, leaf, branch, text, loss_spans (byte start and length) of each path, one row a conversation.

    ``texts`` has tree_id, node_id, role, text.
    """
    t = texts.select("tree_id", "node_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = paths.join(t, ["tree_id", "node_id"])
    rows = rows.withColumn("head", F.concat(F.lit("<turn "), F.url_encode("role"), F.lit(">\n"))).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("size", (F.octet_length("head") + F.octet_length("body") + F.lit(len(CLOSE))).cast("long"))
    before = F.sum("size").over(Window.partitionBy("tree_id", "leaf").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rows = rows.withColumn("start", before + F.octet_length("head"))
    parts = F.array_sort(F.collect_list(F.struct("position", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), "start",
                                                 F.octet_length("body").cast("long").alias("length"), "role")))
    whole = rows.groupBy("tree_id", "leaf", "branch").agg(parts.alias("p"))
    mask = F.transform(F.filter("p", lambda x: x["role"] == ASSISTANT), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    return whole.select("tree_id", "leaf", "branch", F.array_join("p.piece", "").alias("text"), mask.alias("loss_spans"))


def read_back(conversations: DataFrame) -> DataFrame:
    """The columns of ``conversations`` with turns (role, text) and loss_text, both read from the formatted text."""
    segments = F.split("text", CLOSE)
    segments = F.slice(segments, F.lit(1), F.size(segments) - 1)
    head = lambda s: F.substring_index(s, ">\n", 1)
    turns = F.transform(segments, lambda s: F.struct(
        F.url_decode(F.substr(head(s), F.lit(7))).alias("role"), unescape(F.substr(s, F.length(head(s)) + 3)).alias("text")))
    raw = F.col("text").cast("binary")
    loss = F.transform("loss_spans", lambda s: unescape(
        F.substr(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")))
    return conversations.withColumn("turns", turns).withColumn("loss_text", F.array_join(loss, ""))


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Conversations kept as rows by turn, as messages that each reply to the one before."""
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node_id", at.cast("long"))
    return rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree_id"), "conv_id", "node_id",
                       F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), F.lit(0.0).alias("score"), "role", "text")


def op2_chat_trees(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(tricky).alias("text"))
    messages = written(linear_messages(rows.unionByName(extra)))
    told = read_back(formatted(best_paths(messages), messages))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        F.when(F.col("tree_id") != "", F.col("tree_id").cast("long")).alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("text").cast("long").alias("formatted_chars"))
