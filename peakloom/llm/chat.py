"""Chat formatting of reply trees.

Messages form trees by their parents. Root-to-leaf paths are enumerated by iterative self-joins with doubling
steps: round r adds to each leaf's known ancestors those 2^r above them, while a pointer table is joined with
itself. Rounds grow with the logarithm of the depth, rows with the length of the paths, and a chain of any length
needs no chain of joins. Branches are ranked by score. Each chosen path is formatted as one conversation.

Template: ``<|im_start|>role``, a new line, the text, ``<|im_end|>`` and a new line for each turn. In roles and texts a
backslash is added to every ``<|`` (``<\\|``, and one more to those that have some), so no text can hold a control
string; taking one away restores it. New lines and per cents of a role are written ``%0A`` and ``%25``. The loss
mask covers the texts of assistant turns and nothing else.

Defined cases: null texts and roles count as empty; a message whose parent does not exist is a root; a tree
without messages gives no row, nor do messages without tree or id; messages that repeat tree and id are one turn
each, in the order of role and text; ties of score go to the smaller leaf id. A cycle has no leaf and gives no path; a
leaf that hangs on one is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakloom.session import Scratch

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "<(\\\\*)\\|", "<\\\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, "<\\\\(\\\\*)\\|", "<$1|")


def escaped_role(role: Column) -> Column:
    one_line = F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escaped(one_line)


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def chain(turns: DataFrame) -> DataFrame:
    """Flat conversations (conv_id, turn, role, text) as trees of one branch, in the order of their turns."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.withColumnRenamed("conv_id", "tree").withColumn("id", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("id") > 1, F.col("id") - 1).alias("parent")
    return rows.select("tree", "id", parent, "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """(tree, leaf, id, above): every message of every root-to-leaf path, ``above`` the steps from the leaf."""
    nodes = scratch.save(messages.select("tree", "id", "parent").distinct(), "nodes")
    parents = nodes.select("tree", F.col("parent").alias("id")).where(F.col("id").isNotNull()).distinct()
    leaves = nodes.select("tree", "id").distinct().join(parents, ["tree", "id"], "left_anti")
    known = scratch.save(
        leaves.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("above")), "path"
    )
    own = nodes.select("tree", F.col("id").alias("parent")).distinct()
    jump = scratch.save(nodes.join(own, ["tree", "parent"]).select("tree", "id", F.col("parent").alias("to")), "jump")
    step, most = 1, nodes.count()
    while True:
        further = known.join(jump, ["tree", "id"]).select(
            "tree", "leaf", F.col("to").alias("id"), (F.col("above") + step).alias("above")
        )
        further = scratch.save(further, "further")
        if further.isEmpty():
            return known
        if step > most:
            raise ValueError("a branch runs into a cycle")
        known = scratch.save(known.unionAll(further), "path")
        twice = jump.select("tree", "id", F.col("to").alias("middle")).join(
            jump.select("tree", F.col("id").alias("middle"), "to"), ["tree", "middle"]
        )
        jump = scratch.save(twice.select("tree", "id", "to"), "jump")
        step *= 2


def conversations(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, score, rank, formatted, loss): one conversation for each of the ``best`` branches (None: all).

    ``messages`` has tree, id, parent, role, text and score. A branch's score is the mean score of its messages;
    ``loss`` lists the spans (start, length, in code points) under the loss mask.
    """
    scratch = Scratch(messages.sparkSession)
    messages = scratch.save(messages.select("tree", "id", "parent", "role", "text", "score"), "messages")
    steps = paths(messages, scratch)
    turns = messages.select("tree", "id", "role", "text", "score")
    met = steps.join(turns, ["tree", "id"])
    turn = F.struct((-F.col("above")).alias("place"), "id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    branches = met.groupBy("tree", "leaf").agg(
        F.avg(F.coalesce("score", F.lit(0.0))).alias("score"), F.sort_array(F.collect_list(turn)).alias("turns")
    )
    if best is None:
        rank = F.lit(None).cast("int")
    else:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    branches = branches.withColumn("rank", rank)
    if best is not None:
        branches = branches.where(F.col("rank") <= best)
    return _formatted(branches)


def _formatted(branches: DataFrame) -> DataFrame:
    head = lambda t: F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n"))
    pieces = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == "assistant").alias("learn")))
    out = branches.withColumn("pieces", pieces)
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(state, p):
        begin = state["at"] + F.length(p["head"])
        span = F.struct(begin.cast("long").alias("start"), F.length(p["body"]).cast("long").alias("length"))
        return F.struct(
            (begin + F.length(p["body"]) + len(END)).cast("long").alias("at"),
            F.when(p["learn"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    loss = F.aggregate("pieces", start, add)["spans"]
    return out.select("tree", "leaf", "score", "rank", formatted.alias("formatted"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    parts = F.split(formatted, "<\\|im_end\\|>\n")
    whole = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part):
        body = F.substring(part, len(START) + 1, 1 << 30)
        line = F.locate("\n", body)
        role = unescaped_role(body.substr(F.lit(1), line - 1))
        return F.struct(role.alias("role"), unescaped(body.substr(line + 1, F.length(body))).alias("text"))

    return F.transform(whole, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    spans = F.transform(loss, lambda s: unescaped(formatted.substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(spans, "")
