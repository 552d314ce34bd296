"""Conversation structure repair: the cheapest edits that restore a legal sequence of roles.

Rows are laid out by range over (conversation, turn), so a conversation of any length lies
over many tasks, and cut into blocks of ``BLOCK`` rows. The edits of a block are found by a
dynamic program over the grammar ``(s?(ua)+)?``, whose states are: nothing yet, after a
system row, after a user row, after an assistant row. Its audits (one letter an edit) are
persistent: an audit is the node of its last letter, linked to the node before, so states
share their prefixes. Nodes carry ancestors at the powers of two and a rolling hash. Of two
audits of equal cost the ASCII-least is kept; they are compared at the first place where
they differ, which a search over ancestors by hash finds, and equal hashes are verified
letter by letter.

A block gives, for each state it may be entered in, the least cost of leaving it in each
state and the order of those audits. Inserts are placed before a row or at the very end, so
every audit that leaves a block ends with the letter of the block's last row, and none is a
prefix of another: which of two audits is less is settled by the earlier block in which
they differ. So costs and ranks suffice to choose the states between blocks; with these
fixed, all blocks are traced at once. What one task reads of a whole conversation is a few
numbers a block, and once, in order and with constant memory, its texts for the digest,
which is sequential by its nature.

Defined results: a null conversation id is a conversation of its own, a null turn stands
first, a null role or text is one space; rows of one turn are ordered by role, then by a
hash of the text; equal rows are duplicates of the first; empty and very long texts, and
any other columns, play no further part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.text import SPACE_CLASS
from stratum.operators.sequence import PID, POS, range_layout

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# fixed values: costs of the edits, and of a truncated row that stays
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
BLOCK = 1024
# answers of short blocks that a task keeps, and blocks a task gets: bytes tell little of their work
CACHED, TASK_BLOCKS = 1 << 14, 5_000
# states of the grammar, and the state that the next user or assistant row leads to
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# letters of a row: role initial (upper case: truncated; the letter itself: keep or edit), d: must go
KEPT_IN = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
FORCED = "d"
MASK, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681


class Audits:
    """Persistent strings: nodes linked to the one before, node 0 is the empty string."""

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [()]

    def add(self, node: int, letter: str) -> int:
        ups, k, at = [node], 0, node
        while k < len(self.up[at]):
            at = self.up[at][k]
            ups.append(at)
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % MASK)
        self.up.append(tuple(ups))
        return len(self.letter) - 1

    def ancestor(self, node: int, depth: int) -> int:
        rise, k = self.depth[node] - depth, 0
        while rise:
            if rise & 1:
                node = self.up[node][k]
            rise >>= 1
            k += 1
        return node

    def same(self, x: int, y: int) -> bool:
        """Equal strings of one depth; equal hashes are verified down to the common node."""
        if self.hash[x] != self.hash[y]:
            return False
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def less(self, x: int, more_x: str, y: int, more_y: str) -> bool:
        """Whether string x + more_x comes before y + more_y."""
        n = min(self.depth[x], self.depth[y])
        a, b = self.ancestor(x, n), self.ancestor(y, n)
        if self.same(a, b):  # one continues the other
            return self.text(x, n) + more_x < self.text(y, n) + more_y
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.letter[a] < self.letter[b]

    def text(self, node: int, start: int = 0) -> str:
        out = []
        while self.depth[node] > start:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


Best = list  # of (cost, node) or None by state


def _offer(audits: Audits, new: dict, state: int, cost: int, node: int, letter: str) -> None:
    old = new.get(state)
    if old is None or cost < old[0] or cost == old[0] and audits.less(node, letter, old[1], old[2]):
        new[state] = (cost, node, letter)


def inserted(audits: Audits, best: Best) -> Best:
    """The best of each state when missing rows may be inserted here."""
    best = list(best)
    for state, before in ((USER, (NOTHING, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
        new = {} if best[state] is None else {state: (*best[state], "")}
        for b in before:
            if best[b] is not None:
                _offer(audits, new, state, best[b][0] + INSERT_COST, best[b][1], INSERT)
        if state in new:
            cost, node, letter = new[state]
            best[state] = (cost, audits.add(node, letter) if letter else node)
    return best


def run_block(audits: Audits, rows: str, entry: int) -> Best:
    """Least (cost, audit) by state after ``rows``, one letter each, entered in ``entry``."""
    best: Best = [None] * 4
    best[entry] = (0, 0)
    for row in rows:
        best, new = inserted(audits, best), {}
        stays = TRUNCATED_COST if row.isupper() else 0
        for state, at in enumerate(best):
            if at is None:
                continue
            cost, node = at
            _offer(audits, new, state, cost + DELETE_COST, node, DELETE)
            if row == FORCED:
                continue
            keep = KEPT_IN[row.lower()].get(state)
            if keep is not None:
                _offer(audits, new, keep, cost + stays, node, KEEP)
            if keep != NEXT[state]:
                _offer(audits, new, NEXT[state], cost + stays + REROLE_COST, node, REROLE)
        best = [(new[s][0], audits.add(*new[s][1:])) if s in new else None for s in range(4)]
    return best


@lru_cache(CACHED)
def block_moves(rows: str, first: bool) -> list[int]:
    """Costs then ranks (4 x 4 each, by entry and exit state, -1: impossible) of a block."""
    costs, ranks = [-1] * 16, [-1] * 16
    for entry in (NOTHING,) if first else range(4):
        audits = Audits()
        best = run_block(audits, rows, entry)
        reached = [s for s in range(4) if best[s] is not None]
        for s in reached:
            costs[4 * entry + s] = best[s][0]
            ranks[4 * entry + s] = sum(audits.less(best[t][1], "", best[s][1], "") for t in reached if t != s)
    return costs + ranks


def chosen(blocks: list[list[int]]) -> tuple[int, list[tuple[int, int]], str]:
    """(cost, (entry, exit) of each block, inserts at the end) of the cheapest and least audit."""
    at, back = {NOTHING: (0, 0)}, []
    for moves in blocks:
        new, key = {}, {}
        for e, (cost, rank) in at.items():
            for s in range(4):
                move = moves[4 * e + s]
                if move >= 0 and (s not in new or (cost + move, rank) < new[s][:2]):
                    new[s] = (cost + move, rank, e)
                    key[s] = (rank, moves[16 + 4 * e + s])
        order = {s: i for i, s in enumerate(sorted(key, key=key.get))}
        back.append({s: new[s][2] for s in new})
        at = {s: (new[s][0], order[s]) for s in new}
    tails = {NOTHING: "", ASSISTANT: "", USER: INSERT, SYSTEM: 2 * INSERT}
    cost, _, last = min((c + INSERT_COST * len(tails[s]), r, s) for s, (c, r) in at.items())
    tail, path = tails[last], []
    for step in reversed(back):
        path.append((step[last], last))
        last = step[last]
    return cost, path[::-1], tail


@lru_cache(CACHED)
def traced(rows: str, entry: int, leave: int) -> str:
    audits = Audits()
    return audits.text(run_block(audits, rows, entry)[leave][1])


class Repaired:
    """Lines of the repaired conversation, from the audit and the rows in turn."""

    def __init__(self):
        self.state = NOTHING

    def step(self, edit: str, role: str = "", text: str = "") -> str | None:
        if edit == DELETE:
            return None
        if edit == KEEP:
            self.state = KEPT_IN[role[:1]][self.state]
            return f"{role}:{text}"
        self.state = NEXT[self.state]
        return f"{ROLE[self.state]}:{text}"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, stripped of ends, repeated or given to the user by hash."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn")).cast("binary")) % 20
    new = (F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("_text", "[.!?]", ""))
           .otherwise(F.col("_text")))
    return (conversations.select("conv_id", "turn", text_of("role").alias("_role"), text_of("text").alias("_text"),
                                 kind.alias("_kind")).filter("_kind <> 0")
            .withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias("role"),
                    new.alias("text")))


def _key(column: str) -> Column:
    """A text that names the conversation, null among them."""
    return F.to_json(F.struct(F.col(column).alias("id")))


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation of
    (conv_id, turn, role, text) without null roles and texts."""
    filled = rows.select(_key("conv_id").alias("key"), "turn", "role", "text",
                         F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"))
    # rows are equal where all keys of the order are
    laid = range_layout(filled, ["key", F.col("turn").asc_nulls_first(), "role", "h1", "h2"])
    laid = laid.withColumn("at", F.shiftleft(F.col(PID).cast("long"), 33) + F.col(POS)).withColumn(
        "block", F.expr(f"at div {block}"))
    blank = ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    ended = F.col("text").rlike(rf"[.!?]{SPACE_CLASS}*\z")
    initial = F.substring("role", 1, 1)
    slim = laid.select("key", "block", "at", "h1", "h2", blank.alias("blank"), ended.alias("ended"),
                       F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("role"))
    first = (slim.groupBy("key", "h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    slim = slim.join(first, ["key", "h1", "h2"], "left").withColumn(
        "fault", F.when(F.col("blank"), "b").when(F.col("at") > F.col("first"), "d").when(~F.col("ended"), "t").otherwise(""))
    letter = F.when(F.col("fault").isin("b", "d"), FORCED).when(F.col("fault") == "t", F.upper("role")).otherwise(F.col("role"))
    n = lambda fault: F.count_if(F.col("fault") == fault)
    # at most ``block`` rows meet in a group
    blocks = slim.groupBy("key", "block").agg(
        F.array_sort(F.collect_list(F.struct("at", "role", letter.alias("letter")))).alias("rows"),
        n("b").alias("blank"), n("d").alias("duplicate"), n("t").alias("truncated"))
    illegal = F.size(F.filter(F.sequence(F.lit(0), F.size("roles") - 2), lambda i: ~F.concat(
        F.get("roles", i), F.get("roles", i + 1)).isin("su", "ua", "au")))
    blocks = blocks.withColumn("roles", F.col("rows.role")).select(
        "key", "block", F.array_join("rows.letter", "").alias("letters"), "blank", "duplicate", "truncated",
        F.get("roles", F.lit(0)).alias("head"), F.element_at("roles", -1).alias("last"),
        F.when(F.size("roles") > 1, illegal).otherwise(0).cast("long").alias("illegal")).checkpoint()
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // TASK_BLOCKS))
    starts = blocks.groupBy("key").agg(F.min("block").alias("start"))

    def moved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (b for b in batches if len(b)):
            yield b.assign(moves=[block_moves(x, bool(f)) for x, f in zip(b.pop("letters"), b.pop("first"))])

    moves = blocks.join(starts, "key").select(
        "key", "block", "letters", (F.col("block") == F.col("start")).alias("first"), "head", "last").repartition(tasks, "key", "block").mapInPandas(
        moved, "key string, block long, head string, last string, moves array<int>")

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["key", "block", "entry", "leave", "tail", "cost", "edges"]
        key, held = None, []

        def close() -> list[tuple]:
            cost, path, tail = chosen([m for _, _, _, m in held])
            edges = [0] + [int(a[2] + b[1] not in ("su", "ua", "au")) for a, b in zip(held, held[1:])]
            last = len(held) - 1
            return [(key, h[0], *p, tail if i == last else "", 0 if i else cost, e)
                    for i, (h, p, e) in enumerate(zip(held, path, edges))]

        for b in batches:
            done = []  # one frame a batch, for a frame a conversation costs more than its work
            for k, *rest in b[["key", "block", "head", "last", "moves"]].itertuples(index=False):
                if k != key:
                    if held:
                        done += close()
                    key, held = k, []
                held.append(rest)
            if done:
                yield pd.DataFrame(done, columns=names)
        if held:
            yield pd.DataFrame(close(), columns=names)

    path = moves.repartition("key").sortWithinPartitions("key", "block").mapInPandas(
        linked, "key string, block long, entry int, leave int, tail string, cost long, edges long")

    def audited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (b for b in batches if len(b)):
            made = [traced(x, e, s) + t for x, e, s, t in zip(b.pop("letters"), b.pop("entry"), b.pop("leave"), b.pop("tail"))]
            yield b.assign(audit=made)

    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    parts = blocks.join(path, ["key", "block"]).select(
        "key", "block", "letters", "entry", "leave", "tail", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.col("edges")).alias("illegal"), "cost").repartition(tasks, "key", "block").mapInPandas(
        audited, "key string, block long, " + ", ".join(f"{c} long" for c in counts) + ", audit string").checkpoint()

    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sha, lines, audit, at = None, None, None, "", 0
        fresh = True

        def write(line: str | None) -> None:
            nonlocal fresh
            if line is not None:
                sha.update(("" if fresh else "\n").encode() + line.encode("utf-8", "replace"))
                fresh = False

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == INSERT:
                write(lines.step(INSERT))
                at += 1

        for b in batches:
            done = []
            for k, piece, role, text in b[["key", "audit", "role", "text"]].itertuples(index=False):
                if k != key:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha, lines, fresh = k, hashlib.sha256(), Repaired(), True
                if piece is not None:
                    audit, at = piece, 0
                    inserts()
                    continue
                write(lines.step(audit[at], role, text))
                at += 1
                inserts()
            yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, sha.hexdigest())], columns=["key", "repaired_sha256"])

    none = F.lit(None).cast("string")
    lines = parts.select("key", "block", F.lit(-1).cast("long").alias("at"), "audit", none.alias("role"), none.alias("text")).union(
        laid.select("key", "block", "at", none.alias("audit"), "role", "text"))
    digests = lines.repartition("key").sortWithinPartitions("key", "block", "at").mapInPandas(
        digested, "key string, repaired_sha256 string")
    sums = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in counts], F.array_join(F.transform(F.array_sort(
        F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    span = (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"))
    gaps = laid.groupBy("key").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    return gaps.join(sums, "key").join(digests, "key").select("key", "gaps", *counts, "audit", "repaired_sha256")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """One row per conversation id of the table, whatever the damage left of it."""
    ids = conversations.select("conv_id", _key("conv_id").alias("key")).distinct()
    found = repair(damage(conversations))
    nothing = hashlib.sha256(b"").hexdigest()
    fill = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return ids.join(found, "key", "left").select(
        "conv_id", *[fill(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
