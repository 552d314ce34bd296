"""Embedding near-duplicates by sorted projection passes with bounded neighbour windows.

Each pass sorts all distinct vectors by their concatenated random hashes: signs of random
hyperplanes, a prefix of ``k`` signs first and ``TAIL`` further ones after it. The order is laid
out by range, so a task streams a stretch of it and compares every vector with the ``block``
vectors before it. Two vectors at an angle t agree on a sign with probability 1 - t / pi,
whatever else the table holds, so one pass gives them the same prefix with the k-th power of
it. k follows from the number of distinct vectors (about ``CROWD`` strangers a prefix), and the
number of passes from k, so that a pair at the very bound shares a prefix with probability
``RECALL`` at every size and density; closer pairs do more surely. Vectors that share a prefix
are one run of the order, which no range cuts, so a run within the window is met whole, and the
window also meets neighbours beyond their run. ``recall=1`` asks for no prefix at all, hence
for all pairs, block by block over the tasks.

A run longer than the window is cut into blocks, and every two blocks are a group of their own
that any task may hold: neither a crowded run nor its pairs lie in one task, and nothing in it
is passed over. Vectors within half the bound's angle of one centre all link with one another
(angles obey the triangle inequality), so a tight group that crowds a prefix is counted by its
size and never compared with itself; its blocks meet those of other vectors only, and work
grows with its rows and not with their square. The centres come from a bounded sample
(``SAMPLED`` vectors of each prefix that holds more than ``1 / PREFIXES`` of all) and change no
result, only what is compared.

Cosines are taken in double precision. A pair that shares prefixes counts in the first pass
where it does; one that the window alone meets shares none in any pass, travels as a pair and
is made distinct over the passes. Tasks return a row for each vector that found links, with
their number and one vector of its component; verified links are united over all passes.

Equal vectors form one class before the passes (combined in their tasks), so a vector that
a third of all rows hold is compared once; its rows count as links of one another without
being paired. Links, components and vectors stay distributed.

Defined results: vectors that are null, empty or zero, or that hold null or non-finite
components link with nothing; only vectors of equal length are compared; rows that repeat
an id are rows of their own; a row without an id names no component; an empty table gives no
rows; texts are not read, nor are other columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratum.llm.components import connected_components

COSINE = 0.9
RECALL = 0.999
CROWD = 256
BLOCK = 512
ROUND = 4
SEED = 20
ROUNDING = 1e-9
TAIL = 16
TASK_ROWS = 50_000
PREFIXES, SAMPLED = 1024, 8


def plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Signs of a prefix and number of passes for ``n`` vectors; a recall of 1 compares all pairs."""
    if recall >= 1:
        return 0, 1
    bits = min(30, max(0, math.floor(math.log2(max(n, 1) / CROWD))))
    meet = (1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi) ** bits
    return bits, 1 if meet >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - meet))


def hashes(x: np.ndarray, bits: int, passes: int, seed: int = SEED) -> np.ndarray:
    """The prefix of each row (first axis) in each pass."""
    out = np.zeros((len(x), passes), np.int32)
    for p in range(passes if bits else 0):
        planes = np.random.default_rng([seed, p, x.shape[1]]).standard_normal((x.shape[1], bits))
        out[:, p] = (x @ planes > 0) @ (1 << np.arange(bits))
    return out


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; the largest component first, against overflow."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``x`` and ``y`` of all pairs at or above the bound."""
    found = [(np.empty(0, np.int64),) * 2]
    for k in range(0, len(x), BLOCK):  # a long run of partners is met block by block
        part = x[k:k + BLOCK]
        a, b = np.nonzero(part @ y.T >= cosine - ROUNDING)
        exact = np.einsum("ij,ij->i", part[a], y[b]) >= cosine
        found.append((a[exact] + k, b[exact]))
    a, b = (np.concatenate(f) for f in zip(*found))
    return a, b


class Neighbours:
    """Links of a run: each vector against those that follow within the window or a run of links."""

    def __init__(self, cosine: float, window: int):
        self.cosine, self.window = cosine, window
        self.x, self.ids, self.seen = None, np.empty(0, np.int64), np.empty(0, np.int64)
        self.at = 0

    def add(self, x: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.x is None:
            self.x = x[:0]
        alive = self.at - self.seen <= self.window
        both, n = np.concatenate([self.x[alive], x]), int(alive.sum())
        ids_all = np.concatenate([self.ids[alive], ids])
        seen = np.concatenate([self.seen[alive], self.at + np.arange(len(x))])
        a, b = linked(both, x, self.cosine)
        a, b = a[a < b + n], b[a < b + n]
        np.maximum.at(seen, a, self.at + b)
        self.x, self.ids, self.seen = both, ids_all, seen
        self.at += len(x)
        return ids_all[a], ids[b]


def group_pairs(x: np.ndarray, left: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked places of a group: the first ``left`` rows against the others, or all where there are no others."""
    if left < len(x):
        a, b = linked(x[:left], x[left:], cosine)
        return a, b + left
    near, at = Neighbours(cosine, len(x)), np.arange(len(x))
    found = [near.add(x[k:k + BLOCK], at[k:k + BLOCK]) for k in range(0, len(x), BLOCK)]
    a, b = (np.concatenate(f) for f in zip(*found))
    return a, b


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place of each place's component under the pairs (a, b)."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        new = root.copy()
        np.minimum.at(new, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


class Window:
    """Links of a sorted stream: each vector against the ``size`` vectors before it in its pass and length."""

    def __init__(self, cosine: float, size: int):
        self.cosine, self.size = cosine, size
        self.stretch, self.rows, self.x = None, None, None

    def add(self, rows: pd.DataFrame, x: np.ndarray) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
        """(rows with those before them, places a, places b) of the links of one stretch, at most ``size`` rows at once."""
        stretch, old = (rows["pass"].iloc[0], x.shape[1]), 0
        if stretch == self.stretch:
            old = len(self.rows)
            rows, x = pd.concat([self.rows, rows], ignore_index=True), np.concatenate([self.x, x])
        a, b = linked(x, x[old:], self.cosine)
        b = b + old
        near = (a < b) & (b - a <= self.size)
        self.stretch, self.rows, self.x = stretch, rows.iloc[-self.size:], x[-self.size:]
        return rows, a[near], b[near]


def centres(sample: np.ndarray, cosine: float) -> np.ndarray:
    """Mean directions of the sample's dense places, those that cover most vectors first."""
    half = math.cos(math.acos(max(-1.0, min(1.0, cosine))) / 2)
    left, out = sample, []
    while len(left):
        near = np.concatenate([(left[k:k + BLOCK] @ left.T >= cosine).sum(axis=1) for k in range(0, len(left), BLOCK)])
        top = int(near.argmax())
        if near[top] < SAMPLED // 2:
            break
        centre = unit(left[left @ left[top] >= cosine].mean(axis=0, keepdims=True))[0]
        covered = left @ centre >= half
        if covered.sum() >= SAMPLED // 2:
            out.append(centre)
        covered[top] = True
        left = left[~covered]
    return np.array(out).reshape(len(out), sample.shape[1])


def tight_groups(keyed: DataFrame, total: int, dtype: type, cosine: float, block: int) -> DataFrame:
    """``keyed`` with the tight group of each vector in ``tight`` (-1: none)."""
    first = F.get("keys", F.lit(0))
    hot = (keyed.groupBy("dim", first.alias("key")).agg(F.count("*").alias("rows"))
           .filter(F.col("rows") > max(4 * block, total // PREFIXES)).select("dim", "key"))
    # fewer than PREFIXES prefixes by the filter, hence a bounded broadcast and a bounded sample
    place = W.partitionBy("dim", "key").orderBy(F.xxhash64("cid"), "cid")
    sample = (keyed.select("dim", first.alias("key"), "cid", "v").join(F.broadcast(hot), ["dim", "key"], "left_semi")
              .withColumn("place", F.row_number().over(place)).filter(F.col("place") <= SAMPLED)
              .select("dim", "cid", "v").orderBy("dim", "cid").collect())
    found, number = {}, 0
    for dim in sorted({r["dim"] for r in sample}):
        raw = np.stack([np.frombuffer(r["v"], dtype) for r in sample if r["dim"] == dim])
        of_dim = centres(unit(raw), cosine)
        if len(of_dim):
            found[dim] = (number, of_dim)
            number += len(of_dim)
    if not found:
        return keyed.withColumn("tight", F.lit(-1))
    # a margin keeps rounding from placing a vector in a group that it might not link with
    half = math.cos(math.acos(max(-1.0, min(1.0, cosine))) / 2) + 1e-7

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tight = np.full(len(b), -1, np.int32)
            for dim, (base, of_dim) in found.items():
                at = np.nonzero(b["dim"].to_numpy() == dim)[0]
                if len(at):
                    x = unit(np.frombuffer(b"".join(b["v"].iloc[at]), dtype).reshape(len(at), -1))
                    inside = x @ of_dim.T >= half
                    tight[at] = np.where(inside.any(axis=1), base + inside.argmax(axis=1), -1)
            yield b.assign(tight=tight)

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema)
    return keyed.mapInPandas(assigned, f"{columns}, tight int").checkpoint()


def links(vectors: DataFrame, cosine: float = COSINE, passes: int | None = None, block: int = BLOCK,
          recall: float = RECALL, absorb: bool = False) -> DataFrame:
    """(cid, root, links) of the rows (cid, v, n): per pass and group, the rows ``n`` of the newly met partners
    of a vector and one vector of its component. ``passes`` overrides the number that ``recall`` asks for;
    ``absorb`` counts tight groups by their size."""
    kind = "float" if vectors.schema["v"].dataType.elementType.simpleString() == "float" else "double"
    dtype = np.float32 if kind == "float" else np.float64
    total = vectors.count()
    bits, needed = plan(total, cosine, recall)
    passes = passes or needed

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, part in b.groupby(b["v"].str.len(), sort=True):
                raw = np.stack(part["v"].to_numpy()).astype(dtype)
                x = unit(raw)
                yield pd.DataFrame({"dim": int(dim), "cid": part["cid"], "n": part["n"], "v": [r.tobytes() for r in raw],
                                    "keys": list(hashes(x, bits, passes)), "tails": list(hashes(x, TAIL, passes, SEED + 1))})

    def counted(rows: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame | None:
        """Links of a pass among its rows: those whose first shared prefix is this pass's, and those that share none."""
        tight = rows["tight"].to_numpy()
        apart = (tight[a] < 0) | (tight[a] != tight[b])  # a tight group is counted by its size
        a, b = a[apart], b[apart]
        if len(a) == 0:
            return None
        keys, n, cid = np.stack(rows["keys"].to_numpy()), rows["n"].to_numpy(np.int64), rows["cid"].to_numpy(np.int64)
        first = np.full(len(a), passes)
        for p in range(passes - 1, -1, -1):
            first[keys[a, p] == keys[b, p]] = p
        alone = first == passes
        lo, hi = np.where(cid[a] < cid[b], a, b)[alone], np.where(cid[a] < cid[b], b, a)[alone]
        pairs = pd.DataFrame({"cid": cid[lo], "root": cid[hi], "links": n[hi], "back": pd.array(n[lo], "Int64")})
        now = first == rows["pass"].iloc[0]
        a, b = a[now], b[now]
        count = np.zeros(len(rows), np.int64)
        np.add.at(count, a, n[b])
        np.add.at(count, b, n[a])
        hit = count > 0
        own = pd.DataFrame({"cid": cid[hit], "root": cid[roots(len(rows), a, b)[hit]], "links": count[hit],
                            "back": pd.array([pd.NA] * int(hit.sum()), "Int64")})
        return pd.concat([own, pairs], ignore_index=True)

    def units(rows: pd.DataFrame) -> np.ndarray:
        return unit(np.frombuffer(b"".join(rows["v"]), dtype).reshape(len(rows), -1))

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, rest, window = ["pass", "dim", "key", "i", "j"], None, Window(cosine, block)
        for batch in (b for b in batches if len(b)):
            short = batch["blocks"].to_numpy() == 1
            for _, stretch in batch[short].groupby(["pass", "dim"], sort=True):
                for k in range(0, len(stretch), block):
                    part = stretch.iloc[k:k + block]
                    out = counted(*window.add(part, units(part)))
                    if out is not None and len(out):
                        yield out
            b = batch[~short]
            if not len(b):
                continue
            rows = b if rest is None else pd.concat([rest, b], ignore_index=True)
            g = rows[names].to_numpy(np.int64)
            starts = np.concatenate([[0], 1 + np.nonzero((g[1:] != g[:-1]).any(axis=1))[0]])
            yield from each(rows, starts[:-1], starts[1:])
            rest = rows.iloc[starts[-1]:]
        if rest is not None:
            yield from each(rest, [0], [len(rest)])

    def each(rows: pd.DataFrame, starts, ends) -> Iterator[pd.DataFrame]:
        own, i, j = (rows[c].to_numpy() for c in ("own", "i", "j"))
        for s, e in zip(starts, ends):
            left = e - s if i[s] == j[s] else int((own[s:e] == i[s]).sum())
            if e - s > 1 and left > 0 and (i[s] == j[s] or left < e - s):
                group = rows.iloc[s:e]
                out = counted(group, *group_pairs(units(group), left, cosine))
                if out is not None and len(out):
                    yield out

    keyed = vectors.select("cid", "v", "n").mapInPandas(
        hashed, "dim int, cid long, n long, v binary, keys array<int>, tails array<int>").checkpoint()
    keyed = tight_groups(keyed, total, dtype, cosine, block) if absorb else keyed.withColumn("tight", F.lit(-1))
    run = W.partitionBy("pass", "dim", "key")
    crowded = (keyed.select("dim", "tight", F.posexplode("keys").alias("pass", "key")).groupBy("pass", "dim", "key", "tight")
               .agg(F.count("*").alias("rows")).withColumn("run", F.sum("rows").over(run)).filter(F.col("run") > block)
               .withColumn("mine", F.ceil(F.col("rows") / block).cast("int"))
               .withColumn("blocks", F.sum("mine").over(run).cast("int"))
               .withColumn("before", (F.sum("mine").over(run.orderBy("tight")) - F.col("mine")).cast("int"))
               .drop("rows", "run").checkpoint())
    # an explicit number, since work follows vectors and not bytes; each pass of a round has its share of the ranges,
    # so a table worth it gets as many ranges a pass as a shuffle has partitions
    parts, copies = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), total * ROUND
    tasks = max(parts, min(ROUND * parts, copies // BLOCK), copies // TASK_ROWS)
    out = None
    for first in range(0, passes, ROUND):  # a round's copies of the vectors are gone before the next round's
        some = F.sequence(F.lit(first), F.lit(min(first + ROUND, passes) - 1))
        rows = keyed.withColumn("pass", F.explode(some)).withColumn("key", F.get("keys", F.col("pass")))
        rows = rows.join(crowded, ["pass", "dim", "key", "tight"], "left")
        one, none = F.lit(1), F.lit(0)
        rows = rows.withColumn("blocks", F.coalesce("blocks", one)).withColumn("mine", F.coalesce("mine", one))
        rows = rows.withColumn("before", F.coalesce("before", none))
        rows = rows.withColumn("own", F.col("before") + F.pmod(F.xxhash64("cid", "pass"), F.col("mine")).cast("int"))
        # blocks of a tight group meet those of other vectors only
        inside = F.col("tight") >= 0
        outside = lambda k: ~inside | (k < F.col("before")) | (k >= F.col("before") + F.col("mine"))
        met = F.when(F.col("blocks") == 1, F.array(none)).otherwise(
            F.filter(F.sequence(none, F.col("blocks") - 1), outside))
        rows = rows.withColumn("other", F.explode(met))
        rows = rows.select("pass", "dim", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                           "own", F.get("tails", F.col("pass")).alias("tail"), "blocks", "tight", "cid", "n", "v", "keys")
        group = ["pass", "dim", "key", "i", "j"]
        # ranges of these columns cut neither a run nor a pair of blocks
        part = rows.repartitionByRange(tasks, *group).sortWithinPartitions(*group, "own", "tail", "cid").mapInPandas(
            compared, "cid long, root long, links long, back long").checkpoint()
        out = part if out is None else out.union(part)
    alone = out.filter("back is not null").distinct()
    out = (out.filter("back is null").select("cid", "root", "links").union(alone.select("cid", "root", "links"))
           .union(alone.select(F.col("root").alias("cid"), F.col("cid").alias("root"), F.col("back").alias("links"))))
    if absorb:
        sizes = (keyed.filter("tight >= 0").groupBy("tight")
                 .agg(F.sum("n").alias("size"), F.min("cid").alias("root")))
        # no more groups than sampled vectors
        out = out.union(keyed.filter("tight >= 0").join(F.broadcast(sizes), "tight")
                        .select("cid", "root", (F.col("size") - F.col("n")).alias("links")).filter("links > 0"))
    return out


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
                    passes: int | None = None, block: int = BLOCK, recall: float = RECALL) -> DataFrame:
    """(id, n_links, component_id, kept) per row; with ``recall=1`` all pairs are compared."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col(id_col).alias("id"), F.when(valid, v).alias("v"))
    # 128 bits of hash name a class
    keys = (F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(SEED), F.col("v")).alias("k2"))
    rows = rows.select("id", "v", *keys)
    classes = (rows.filter("v is not null").groupBy("k1", "k2")
               .agg(F.first("v").alias("v"), F.min("id").alias("least"), F.count("*").alias("n"))
               .withColumn("cid", F.monotonically_increasing_id()).checkpoint())
    found = links(classes, cosine, passes, block, recall, absorb=True).checkpoint()
    roots_ = connected_components(found.select(F.col("cid").alias("src"), F.col("root").alias("dst")))
    partners = found.groupBy("cid").agg(F.sum("links").alias("partners"))
    members = classes.select("k1", "k2", "cid", "least", "n").join(
        roots_.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = members.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = members.join(named, "root").join(partners, "cid", "left").select(
        "k1", "k2", "component_id", (F.col("n") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"))
    # a row without a valid vector meets no class: the hash of null is no class's key pair
    slim = rows.select("id", *[F.when(F.col("v").isNotNull(), F.col(k)).alias(k) for k in ("k1", "k2")])
    out = slim.join(labels, ["k1", "k2"], "left")
    linked = F.col("n_links").isNotNull()
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(linked, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
