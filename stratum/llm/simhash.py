"""SimHash near-duplicates: fingerprints linked by a grid join on segment bit counts.

A fingerprint is cut into segments; the vector of segment bit counts is an embedding in
which Manhattan distance never exceeds Hamming distance. Each distinct fingerprint is
posted to its own grid cell and to the cells within half the distance bound of it, so two
fingerprints within the bound meet in at least one cell; candidates are then verified by
their exact Hamming distance.

Copies share a fingerprint and are grouped before any join. A fingerprint has a bounded
number of others within the distance bound, so the links of a large group of near copies
grow with its distinct fingerprints, never with the square of its rows. Cells are dealt
over tasks by equi-join, and adaptive execution splits a crowded one.

Defined results: null and empty texts have fingerprint 0 and link like any other; a text
of fewer words than the shingle is one shingle; repeated rows are copies of each other; a
row without an id takes part but never names a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.components import connected_components
from stratum.llm.text import hex_u64, whole
from stratum.operators.joins import fits

SEED = 42
SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 16
BLOCK = 1 << 18


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set if it is set in over half of the shingle hashes."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        words = [b" ".join(words)]
    else:
        words = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in words), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def row_keys(id_col: str, text: str) -> list[Column]:
    """128 bits of hash that name a pair of id and text; never null."""
    t = whole(F.col(text))
    return [F.xxhash64(F.col(id_col), t).alias("k1"), F.xxhash64(F.lit(SEED), F.col(id_col), t).alias("k2")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(id, fingerprint long) per row, with the row keys if ``keyed``, computed where the rows lie."""
    keys = ["k1", "k2"] if keyed else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.fromiter((fingerprint_of(t, shingle) for t in b["t"]), dtype=np.uint64, count=len(b))
            yield b[["id", *keys]].assign(fp=fp.view(np.int64))

    slim = docs.select(F.col(id_col).cast("string").alias("id"), *(row_keys(id_col, text) if keyed else []),
                       F.col(text).cast("string").alias("t"))
    out = slim.mapInPandas(run, ", ".join(["id string", *[f"{k} long" for k in keys], "fp long"]))
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *keys, "fp")


def _steps(segments: int, radius: int) -> list[list[tuple[int, int]]]:
    """Sparse offsets (segment, change) of all grid cells within ``radius``."""
    out: list[list[tuple[int, int]]] = []
    for n in range(radius + 1):
        for where in combinations(range(segments), n):
            for change in product(*[[d for d in range(-radius, radius + 1) if d]] * n):
                if sum(map(abs, change)) <= radius:
                    out.append(list(zip(where, change)))
    return out


def cells(fp: Column, segments: int = SEGMENTS, radius: int = 1) -> Column:
    """Grid cells of a fingerprint: its segment bit counts, and those up to ``radius`` steps off.

    A cell is one long: a digit of base (segment width + 1) per segment. Cells outside the
    lattice are left out; by the triangle inequality two points within 2 * radius share a cell.
    """
    width = 64 // segments
    base = width + 1
    if segments * width != 64 or base ** segments >= 1 << 63:
        raise ValueError("segments must divide 64 and the cell number fit 63 bits")
    mask = (1 << width) - 1
    count = [F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit(mask).cast("long")))
             for i in range(segments)]
    home = sum((c.cast("long") * F.lit(base ** i) for i, c in enumerate(count)), F.lit(0).cast("long"))
    posted = []
    for step in _steps(segments, radius):
        inside = F.lit(True)
        shift = 0
        for i, d in step:
            inside = inside & (count[i] + d).between(0, width)
            shift += d * base ** i
        posted.append(F.when(inside, home + F.lit(shift).cast("long")))
    return F.array_compact(F.array(*posted))


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(src, dst) of distinct fingerprints at ``max_bits`` or fewer differing bits."""
    posted = distinct_fps.select("fp", F.explode(cells(F.col("fp"), segments, -(-max_bits // 2))).alias("cell"))
    left = posted.select("cell", F.col("fp").alias("src"))
    right = posted.select("cell", F.col("fp").alias("dst"))
    near = (F.col("src") < F.col("dst")) & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits)
    return left.join(right, "cell").filter(near).select("src", "dst").distinct()


def components_of(fps: DataFrame, id_col: str, max_bits: int, segments: int) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of (id, fp)."""
    distinct = fps.groupBy("fp").agg(F.min(id_col).alias("least")).checkpoint()
    roots = connected_components(links(distinct.select("fp"), max_bits, segments))
    members = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = members.groupBy("root").agg(F.min("least").alias("component_id"))
    return members.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS) -> DataFrame:
    """(id, fingerprint hex, component_id): the smallest id reachable over links, itself included."""
    fps = fingerprints(docs, id_col, text, shingle).checkpoint()
    labels = components_of(fps, id_col, max_bits, segments).select("fp", "component_id")
    return fps.join(labels, "fp").select(
        id_col, hex_u64(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Exactly one row of each group, with all columns of ``docs``: one whose id names the component.

    Of rows of one group that share this id, the one of smallest text hash stays, so a
    repeated id costs no group its row; a group without any id keeps a row likewise. Only
    ids, hashes and fingerprints are grouped, combined in their tasks. The keys of rows that
    go, and of kept rows that stand more than once, are the smaller part: within the
    broadcast bound they meet the rows where those lie, and only repeated ones are shuffled.
    Beyond the bound the rows are shuffled by key.
    """
    fps = fingerprints(docs, id_col, text, shingle, keyed=True).checkpoint()
    labels = components_of(fps, id_col, max_bits, segments)
    chosen = (fps.join(labels, "fp").filter(F.col(id_col).eqNullSafe(F.col("component_id")))
              .groupBy("root").agg(F.min(F.struct("k1", "k2")).alias("k")).select("k.k1", "k.k2").distinct().checkpoint())
    rows = docs.select(F.struct("*").alias("row"), *row_keys(id_col, text))
    own = [F.col("row")[c].alias(c) for c in docs.columns]
    keys = fps.groupBy("k1", "k2").agg(F.count("*").alias("n")).join(
        chosen.withColumn("stays", F.lit(True)), ["k1", "k2"], "left").select(
        "k1", "k2", F.col("stays").isNull().alias("goes"), "n")
    few = keys.filter("goes or n > 1").checkpoint()
    if not fits(few):
        return rows.join(chosen, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(*own)
    once = rows.join(F.broadcast(few), ["k1", "k2"], "left_anti").select(*own)
    repeated = few.filter("not goes").select("k1", "k2")
    if repeated.isEmpty():
        return once
    return once.unionByName(rows.join(F.broadcast(repeated), ["k1", "k2"], "left_semi")
                            .dropDuplicates(["k1", "k2"]).select(*own))
