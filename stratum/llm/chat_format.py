"""Chat formatting of reply trees: paths by iterative self-joins, ranked by score, one text a path.

A node (tree, node, parent, role, text, score) replies to its parent. Each round joins the
table of ancestors with itself, which doubles the distance every pointer spans, so a path
of d turns takes log d rounds and no task ever follows one. The same rounds sum the scores
to the root: that is a leaf's rank within its tree, and only the ``keep`` best leaves of a
tree are followed back, by the pointers of all rounds, largest first. A hot root or parent
is one row of the side that it is looked up in, so adaptive execution may split its
replies.

A path is written as turns ``<|im_start|>role\\ntext<|im_end|>\\n``. Within a role or text a
backslash escapes a backslash, the bar of a control string's start ``<|`` and, in roles, a
newline; removing the backslashes gives the original. The loss mask is a list of (start,
end) over the formatted text, in code points, with the texts of assistant turns. A path is
one row up to ``PART`` turns; a longer one goes on in further rows, so that a conversation
that a third of all rows belong to is never one task's or one value's.

Defined results: null roles and texts are empty; a null tree is a tree of its own; a node
whose parent is not in its tree is a root; a circle of replies is opened at its least node,
which becomes a root; repeated rows of a conversation are turns of their own, ordered by
turn (null first), role and text hash; ties of score go to the least leaf; texts of any
length are formatted whole; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.sequence import PID, POS, lag_lead, range_layout

# fixed values: the template
START, END = "<|im_start|>", "<|im_end|>"
MASKED_ROLE = "assistant"
PART = 64
PATHS = "tree string, leaf long, node long, depth long"


def escaped(value: Column, newline: bool = False) -> Column:
    """Backslashes doubled, and one put into every ``<|`` and, if asked, before every newline."""
    out = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\\n")) if newline else out


def unescaped(value: str) -> str:
    return re.sub(r"\\(.)", r"\1", value, flags=re.DOTALL)


def chain(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as reply trees: every turn replies to the one before; all scores are 1."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    tree = F.to_json(F.struct(F.col(conv).alias("id")))  # also names the null conversation
    base = rows.select(tree.alias("tree"), F.col(turn).alias("turn"), of(role).alias("role"), of(text).alias("text"))
    laid = range_layout(base, ["tree", F.col("turn").asc_nulls_first(), "role", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")])
    laid = laid.select("tree", "role", "text", (F.shiftleft(F.col(PID).cast("long"), 33) + F.col(POS)).alias("node"),
                       F.lit(1.0).alias("score"))
    links = lag_lead(laid.select("tree", "node"), ["tree"], ["node"], "node", lag_name="parent", lead_name="next")
    return laid.join(links.select("node", "parent"), "node")


def _rooted(nodes: DataFrame) -> DataFrame:
    """(tree, node, up, score) with ``up`` null where the parent is not in the tree."""
    there = nodes.select(F.col("tree").alias("_tree"), F.col("node").alias("up"))
    base = nodes.select("tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    return base.join(there, (F.col("tree") == F.col("_tree")) & (F.col("parent") == F.col("up")), "left").select(
        "tree", "node", "up", "score")


def ancestors(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, depth, total) of every node, and per round k (tree, node, up) with ``up`` 2^k replies above."""
    rooted = _rooted(nodes).checkpoint()
    size = rooted.count()
    while True:
        at = rooted.select("tree", "node", "up", F.lit(0).cast("long").alias("depth"), F.col("score").alias("total"),
                           F.col("node").alias("least"))
        done, rounds = at.filter("up is null"), []
        at = at.filter("up is not null")
        while not at.isEmpty() and 1 << len(rounds) <= 2 * size:
            rounds.append(at.select("tree", "node", "up"))
            # a pointer that ended at a root adds the root's sums; the others span twice as far
            far = at.unionByName(done)
            far = far.select(*[F.col(c).alias(f"_{c}") for c in far.columns])
            step = F.lit(1 << (len(rounds) - 1)).cast("long")
            both = at.join(far, (F.col("tree") == F.col("_tree")) & (F.col("up") == F.col("_node"))).select(
                "tree", "node", F.col("_up").alias("up"),
                F.when(F.col("_up").isNull(), step + F.col("_depth")).otherwise(F.col("depth")).alias("depth"),
                (F.col("total") + F.col("_total")).alias("total"), F.least("least", "_least").alias("least")).checkpoint()
            done = done.unionByName(both.filter("up is null"))
            at = both.filter("up is not null")
        if at.isEmpty():
            return done.select("tree", "node", "depth", "total"), rounds
        # what pointers still meet after so many rounds are circles; each one's least node becomes a root
        met = at.select("tree", F.col("up").alias("node")).distinct()
        cut = at.join(met, ["tree", "node"]).select("tree", F.col("least").alias("node")).distinct().withColumn(
            "cut", F.lit(True))
        rooted = rooted.join(cut, ["tree", "node"], "left").select(
            "tree", "node", F.when(F.col("cut").isNull(), F.col("up")).alias("up"), "score").checkpoint()


def best_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, leaf, node, depth): the nodes of the ``keep`` root-to-leaf paths of greatest score in each tree."""
    found, rounds = ancestors(nodes)
    found = found.checkpoint()
    leaves = found
    if rounds:  # the first round's pointers are the parents
        leaves = found.join(rounds[0].select("tree", F.col("up").alias("node")), ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    path = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep).select(
        "tree", F.col("node").alias("leaf"), "node").checkpoint()
    for pointers in reversed(rounds):
        above = path.join(pointers, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"))
        path = path.unionByName(above).checkpoint()
    return path.join(found.select("tree", "node", "depth"), ["tree", "node"]).select("tree", "leaf", "node", "depth")


def format_trees(nodes: DataFrame, keep: int = 1, part: int = PART) -> DataFrame:
    """(tree, leaf, part, n_turns, formatted, mask) of the chosen paths, at most ``part`` turns a row."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    head = F.concat(F.lit(START), escaped(of("role"), True), F.lit("\n"))
    body = escaped(of("text"))
    turns = nodes.select("tree", "node", head.alias("head"), body.alias("body"),
                         (of("role") == MASKED_ROLE).alias("masked"))
    tail = F.lit(END + "\n")
    turns = best_paths(nodes, keep).join(turns, ["tree", "node"]).select(
        "tree", "leaf", F.expr(f"depth div {part}").alias("part"),
        F.struct("depth", F.length("head").alias("head"), F.length("body").alias("body"), "masked",
                 F.concat("head", "body", tail).alias("text")).alias("turn"))
    rows = turns.groupBy("tree", "leaf", "part").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["text"])).alias("at"),
            F.concat(acc["mask"], F.when(t["masked"], F.array(F.struct(
                (acc["at"] + t["head"]).alias("start"), (acc["at"] + t["head"] + t["body"]).alias("end")))).otherwise(
                F.array().cast("array<struct<start:int,end:int>>"))).alias("mask")),
        lambda acc: acc["mask"])
    return rows.select("tree", "leaf", "part", F.size("turns").alias("n_turns"),
                       F.array_join("turns.text", "").alias("formatted"), spans.alias("mask"))


_TURN = re.compile(re.escape(START) + r"((?:[^\\\n]|\\.)*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn; no control string stands unescaped in a role or text."""
    return [(unescaped(r), unescaped(t)) for r, t in _TURN.findall(formatted)]


def read_back(formatted: DataFrame) -> DataFrame:
    """(tree, leaf, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from formatted texts and masks.

    A path's parts pass in order through one task, which holds one part at a time.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["tree", "leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        at, n, chars, length, turns, loss = None, 0, 0, 0, None, None
        row = lambda: (*at, n, turns.hexdigest(), chars, loss.hexdigest(), length)
        for b in batches:
            done = []
            for tree, leaf, text, starts, ends in b[["tree", "leaf", "formatted", "starts", "ends"]].itertuples(index=False):
                if (tree, leaf) != at:
                    if at is not None:
                        done.append(row())
                    at, n, chars, length, turns, loss = (tree, leaf), 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, said in parsed(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                for s, e in zip(starts, ends):
                    said = unescaped(text[s:e])
                    chars += len(said)
                    loss.update(said.encode("utf-8", "replace"))
                length += len(text)
            yield pd.DataFrame(done, columns=names)
        if at is not None:
            yield pd.DataFrame([row()], columns=names)

    return (formatted.select("tree", "leaf", "part", "formatted", F.col("mask.start").alias("starts"), F.col("mask.end").alias("ends"))
            .repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "part").mapInPandas(
        read, "tree string, leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def format_conversations(rows: DataFrame, conv: str = "conv_id", **columns: str) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation."""
    nodes = chain(rows, conv, **columns).checkpoint()
    kind = rows.schema[conv].dataType.simpleString()
    found = read_back(format_trees(nodes).checkpoint())
    return found.select(F.from_json("tree", f"id {kind}")["id"].alias(conv), "n_turns", "turns_sha256", "loss_chars",
                        "loss_sha256", "formatted_chars")
