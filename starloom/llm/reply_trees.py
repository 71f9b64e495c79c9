"""Chat formatting over reply trees.

Self-joins that double their reach enumerate every root-to-leaf path in as
many rounds as the longest path has binary digits; branches are ranked by
score, and each chosen path becomes one formatted conversation with a loss
mask over the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written

# The template's control strings and the marks around a text.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>")
MARKS = {"user": ("<s>[INST] ", " [/INST]</s>"), "system": ("<s><<SYS>> ", " <</SYS>></s>"), "assistant": ("<s>", "</s>")}

_TAILS = "|".join(c[1:].replace("]", r"\]") for c in CONTROLS)


def escaped(text: Column) -> Column:
    """No control string is left: one backslash goes in after its first
    character, and one more where backslashes stand there already."""
    return F.regexp_replace(text, rf"([<\[])(\\*(?:{_TAILS}))", r"$1\\$2")


def unescaped(text: Column) -> Column:
    """Inverse of ``escaped``."""
    return F.regexp_replace(text, rf"([<\[])\\(\\*(?:{_TAILS}))", "$1$2")


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up) for every node on every root-to-leaf path of
    ``nodes`` (tree, node, parent); ``up`` counts steps above the leaf.

    A node whose parent is null or absent is a root.  After round k every leaf
    knows its ancestors below distance 2^k and every node its ancestor at that
    distance.  Replies that form a circle raise ``ValueError``."""
    nodes = nodes.select("tree", "node", "parent")
    parents = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    same_tree = F.col("tree").eqNullSafe(F.col("t"))
    edges = written(nodes.join(parents, same_tree & (F.col("parent") == F.col("p")), "left_semi")
                         .select("tree", "node", F.col("parent").alias("far")), "reply-edges")
    inner = edges.select(F.col("tree").alias("t"), F.col("far").alias("p")).distinct()
    leaves = nodes.join(inner, same_tree & (F.col("node") == F.col("p")), "left_anti")
    found = written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("up")), "reply-paths")
    jump, reach, n = edges, 1, edges.count()
    while jump.take(1):
        if reach > n:
            raise ValueError("replies form a circle")
        hop = jump.select(F.col("tree").alias("t"), F.col("node").alias("from"), F.col("far").alias("to"))
        above = (found.join(hop, same_tree & (F.col("node") == F.col("from")))
                      .select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + reach).alias("up")))
        found = written(found.unionByName(above), "reply-paths")
        jump = written(jump.join(hop, same_tree & (F.col("far") == F.col("from")))
                           .select("tree", "node", F.col("to").alias("far")), "reply-jumps")
        reach *= 2
    return found


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, formatted, loss) of the ``branches`` best root-to-leaf
    paths of each tree of ``messages`` (tree, node, parent, role, text, score).

    Paths rank by the sum of their scores, then by the smaller leaf.  Null
    role and text count as empty, null score as 0; of rows that repeat a node,
    the one with the smallest (parent, role, text) counts.  ``loss`` lists
    (start, length), in code points of ``formatted``, of each assistant text.
    A conversation is one value, held by one task."""
    messages = messages.groupBy("tree", "node").agg(
        F.min(F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("m")
    ).select("tree", "node", "m.*")
    messages = written(messages, "reply-messages")
    found = paths(messages)
    told = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text", "score")
    on = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
    scores = found.join(told.drop("role", "text"), on).groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
    chosen = (written(scores.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= branches)
                            .select(F.col("tree").alias("ct"), F.col("leaf").alias("cl")), "reply-chosen"))
    rows = found.join(chosen, F.col("tree").eqNullSafe(F.col("ct")) & (F.col("leaf") == F.col("cl"))).join(told, on)
    opening, closing = F.concat(F.lit("<s><<ROLE>>"), escaped(F.col("role")), F.lit("<</ROLE>>")), F.lit("</s>")
    for role, (a, b) in MARKS.items():
        opening = F.when(F.col("role") == role, F.lit(a)).otherwise(opening)
        closing = F.when(F.col("role") == role, F.lit(b)).otherwise(closing)
    turn = F.struct((-F.col("up")).alias("at"), opening.alias("a"), escaped(F.col("text")).alias("x"), closing.alias("b"),
                    (F.col("role") == "assistant").alias("loss"))
    turns = rows.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["a"], t["x"], t["b"])), "")
    # running length up to each turn, then the place of its text
    begins = F.aggregate(
        F.transform("turns", lambda t: F.struct(F.length(t["a"]).alias("a"), F.length(t["x"]).alias("x"), F.length(t["b"]).alias("b"), t["loss"].alias("loss"))),
        F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda s, t: F.struct((s["end"] + t["a"] + t["x"] + t["b"]).alias("end"),
                              F.when(t["loss"], F.concat(s["spans"], F.array(F.struct((s["end"] + t["a"]).alias("start"), t["x"].alias("length")))))
                               .otherwise(s["spans"]).alias("spans")))
    return turns.select("tree", "leaf", formatted.alias("formatted"), begins["spans"].alias("loss"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    raw = F.filter(F.split(formatted, "</s>", -1), lambda t: t != "")

    def turn(t: Column) -> Column:
        named = F.regexp_extract(t, r"(?s)\A<s><<ROLE>>(.*?)<</ROLE>>(.*)\z", 1)
        role, text = unescaped(named), F.regexp_extract(t, r"(?s)\A<s><<ROLE>>(.*?)<</ROLE>>(.*)\z", 2)
        text = F.when(t.startswith("<s><<ROLE>>"), text).otherwise(F.regexp_replace(t, r"\A<s>", ""))
        role = F.when(t.startswith("<s><<ROLE>>"), role).otherwise(F.lit("assistant"))
        for name, (a, b) in MARKS.items():
            if name != "assistant":
                b = b.removesuffix("</s>")
                text = F.when(t.startswith(a), t.substr(F.lit(len(a) + 1), F.length(t) - len(a) - len(b))).otherwise(text)
                role = F.when(t.startswith(a), F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(raw, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(formatted.substr(s["start"] + 1, s["length"]))), "")
