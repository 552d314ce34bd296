"""Phrase collocation mining by Toivonen's method: counts of phrases, and their cohesion.

A sample proposes the phrases that seem frequent: level by level, at a lowered threshold,
over a ``SHARE`` of the pieces (the runs between delimiters that phrases cannot cross),
drawn at random. A pass over all rows then counts what the sample proposed and its
negative border, that is every phrase whose first and last parts (one word shorter) were
proposed; the border of the single words is every word. It counts by hash, in a few bytes
a phrase and task, which never counts too little. A second pass counts by text, exactly,
the phrases whose hash reached the threshold. A border phrase among them is a failure of
the sample: what failures newly allow, the phrases of proposed parts that hold one, each
followed to its longest extension, is counted in the same pass. A further pass runs only
for failures whose hash hid them behind a proposed phrase. So the sample decides how much
is counted, and never what is found.

Tasks test proposals in Bloom filters of bounded size, whose bits Spark gathers; what they
let through by mistake is counted too, and a filled filter only costs work. A task numbers
the phrases of a chunk of texts and sends one count a chunk and phrase, which are summed
before and after the shuffle, so a word, phrase or copied text that a third of all rows
hold arrives as one count a task.

Defined results: null texts are empty; a null language is ``und``; an empty table, or one
without a frequent phrase, gives no rows; repeated rows count as often as they stand; only
A-Z are lower-cased; phrases do not cross the delimiters of pieces. A very long text is
cut at delimiters into pieces of about ``CHUNK_CHARS`` characters, so memory follows the
chunk, or the longest run without any delimiter. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLD = 100
LONGEST = 5
TOP = 2000
SHARE = 0.05
LOWERED = 0.4
CHUNK_CHARS = 2_000_000
FILTER_BITS = 1 << 27
# bits of a phrase's hash, those that name its group, and bytes of input a group is made for
HASH_BITS, GROUP_BITS, GROUP_BYTES = 52, 12, 8 << 20
HELD = 1_500_000
SALTS = 64
SCHEMA = "lang string, n int, phrase string, h long, a long, holds boolean"

BREAK = b"\n"
# fixed values: delimiters of pieces, and of words within a piece
_MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", BREAK * 9 + b" ")


class Filter:
    """Bloom filter of two probes over hashes of ``HASH_BITS`` bits: never misses a member."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for p in (h & self.mask, (h >> np.uint64(25)) & self.mask):
            found &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def gathered(phrases: DataFrame) -> Filter:
    """The filter of the column ``h``: about 16 bits an entry, ``FILTER_BITS`` at most."""
    bits = 1 << 16
    wanted = min(FILTER_BITS, 16 * phrases.count())
    while bits < wanted:
        bits *= 2
    probe = F.explode(F.array(F.col("h"), F.shiftrightunsigned("h", 25))).alias("p")
    at = phrases.select(probe).select(F.col("p").bitwiseAND(F.lit(bits - 1)).alias("p"))
    rows = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("b"))
    found = rows.toPandas()  # one row a word of the filter: FILTER_BITS / 64 at most
    words = np.zeros(bits // 64, np.uint64)
    words[found["w"].to_numpy(np.int64)] = found["b"].to_numpy(np.int64).view(np.uint64)
    return Filter(words)


def mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word and that of the last word."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Level:
    """The phrases of ``n`` words of a chunk: hash, count and one place of each, and which hold a fresh one."""

    def __init__(self, n: int, h: np.ndarray, count: np.ndarray, place: np.ndarray, new: np.ndarray):
        self.n, self.chain, self.count, self.place, self.new = n, h, count, place, new
        self.h = h >> np.uint64(64 - HASH_BITS)


class Chunk:
    """Words of a chunk of pieces by number, and its phrases level by level."""

    def __init__(self, data: bytes, lang: str):
        tokens = data.replace(BREAK, b" \n ").split(b" ")
        names = {b"": 0, BREAK: 1}
        names.update(zip((w for w in dict.fromkeys(tokens) if w not in names), range(2, 1 << 62)))
        ids = np.fromiter(map(names.__getitem__, tokens), np.int64, len(tokens))
        self.ids, self.words = ids[ids > 0], list(names)
        seed = xxhash.xxh32_intdigest(lang.encode())
        self.hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words], np.uint64)

    def text(self, level: Level, which: np.ndarray) -> list[str]:
        rows = self.ids[level.place[which][:, None] + np.arange(level.n)].tolist()
        return [b" ".join([self.words[i] for i in row]).decode("utf-8", "replace") for row in rows]

    def levels(self, high: int, known: Filter | None, fresh: Filter | None = None) -> Iterator[Level]:
        """Single words, then the phrases of 2..high words whose parts are known or hold a fresh phrase."""
        ids, v = self.ids, len(self.words)
        place = np.zeros(v, np.int64)
        place[ids] = np.arange(len(ids))
        count = np.bincount(ids, minlength=v)
        count[:2] = 0
        level = Level(1, self.hashes, count, place, np.zeros(v, bool))
        yield level
        pid = np.where(ids > 1, ids, -1)
        for n in range(2, high + 1):
            holds = level.new if fresh is None else level.new | fresh(level.h)
            alive = np.append(known(level.h) | holds, False)[pid]  # the last entry is that of -1
            at = np.flatnonzero(alive[:-1] & alive[1:])
            if not len(at):
                return
            pairs, inverse, count = np.unique(pid[at] * v + ids[at + n - 1], return_inverse=True, return_counts=True)
            place = np.empty(len(pairs), np.int64)
            place[inverse] = at
            level = Level(n, mixed(level.chain[pairs // v], self.hashes[pairs % v]), count, place,
                          holds[pid[place]] | holds[pid[place + 1]])
            yield level
            pid = np.full(len(ids), -1)
            pid[at] = inverse


def pieces(texts: Iterator[str]) -> Iterator[bytes]:
    """Lower-cased texts joined and cut at delimiters, about ``CHUNK_CHARS`` bytes each."""
    held, size = [], 0
    for t in texts:
        data = t.encode("utf-8", "replace").lower().translate(_MARKS)
        while size + len(data) > CHUNK_CHARS:
            cut = data.rfind(BREAK, 0, max(0, CHUNK_CHARS - size))
            if cut < 0 and not held:
                cut = data.find(BREAK)
            if cut < 0 and not held:
                break  # a run without delimiters stays whole
            if cut >= 0:
                held.append(data[:cut])
                data = data[cut + 1:]
            yield BREAK.join(held)
            held, size = [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield BREAK.join(held)


def chunks_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Chunk]]:
    """(lang, chunk) over the rows (lang, text) of a task."""
    each: dict[str, list[str]] = {}
    size = 0
    for b in batches:
        for lang, text in zip(b["lang"], b["text"]):
            each.setdefault(lang, []).append(text)
            size += len(text)
            if size > CHUNK_CHARS:
                for k in each:
                    yield from ((k, Chunk(data, k)) for data in pieces(iter(each[k])))
                each, size = {}, 0
    for k in each:
        yield from ((k, Chunk(data, k)) for data in pieces(iter(each[k])))


def phrase_counts(docs: DataFrame, low: int, high: int, known: Broadcast | None = None, wanted: Broadcast | None = None,
                  fresh: Broadcast | None = None) -> DataFrame:
    """(lang, n, phrase, h, a, holds): exact counts over the rows (lang, text) of ``docs``.

    Of the phrases of ``low``..``high`` words whose parts are ``known`` or hold a ``fresh``
    phrase, those that hold one (``holds``), and those ``wanted`` (None: all). ``low`` 0
    adds the number of all words.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        want, new = wanted and wanted.value, fresh and fresh.value
        for lang, chunk in chunks_of(batches):
            if low == 0:
                yield pd.DataFrame({"lang": [lang], "n": 0, "phrase": "", "h": 0,
                                    "a": int((chunk.ids > 1).sum()), "holds": False})
            for x in chunk.levels(high, known and known.value, new):
                send = x.count > 0 if want is None else (x.count > 0) & (x.new | want(x.h))
                if x.n >= low and send.any():
                    yield pd.DataFrame({"lang": lang, "n": x.n, "phrase": chunk.text(x, send),
                                        "h": x.h[send].view(np.int64), "a": x.count[send], "holds": x.new[send]})

    return docs.mapInPandas(count, SCHEMA).groupBy("lang", "n", "phrase").agg(
        F.min("h").alias("h"), F.sum("a").alias("a"), F.bool_or("holds").alias("holds"))


def _summed(h: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes with their counts, up to ``most``."""
    order = np.argsort(h, kind="stable")
    h, count = h[order], count[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
    return h[first], np.minimum(np.add.reduceat(count, first) if len(h) else count, most)


def frequent_hashes(docs: DataFrame, high: int, known: Broadcast, threshold: int) -> DataFrame:
    """(h): hashes whose phrases of 1..high words with known parts occur ``threshold`` times or more together.

    Tasks send blocks of packed hashes and counts, by the leading bits of the hash; a
    phrase takes six bytes. Counts beyond the threshold are of no use and are cut to it.
    """
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    groups = size // GROUP_BYTES if size < 1 << 55 else 1  # beyond, the planner does not know
    bits = max(GROUP_BITS, min(HASH_BITS - 32, math.ceil(math.log2(max(1, groups)))))
    rest, kind = HASH_BITS - bits, np.uint8 if threshold < 256 else np.uint32

    def packed(h: np.ndarray, count: np.ndarray) -> pd.DataFrame:
        group = (h >> np.uint64(rest)).astype(np.int64)
        low, mid, count = h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint8), count.astype(kind)
        cuts = [*np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(h)] if len(h) else [0]
        return pd.DataFrame({"g": group[cuts[:-1]], "low": [low[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                             "mid": [mid[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                             "count": [count[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]})

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for _, chunk in chunks_of(batches):
            for x in chunk.levels(high, known.value):
                some = x.count > 0
                held.append((x.h[some], x.count[some]))
                n += len(held[-1][0])
            if n > HELD:
                held = [_summed(*map(np.concatenate, zip(*held)), threshold)]
                n = len(held[0][0])
                if n > HELD // 2:
                    yield packed(*held[0])
                    held, n = [], 0
        if held:
            yield packed(*_summed(*map(np.concatenate, zip(*held)), threshold))

    def total(group: int, parts: list[tuple[bytes, bytes, bytes]]) -> pd.DataFrame:
        low, mid, count = (np.frombuffer(b"".join(p), t) for p, t in zip(zip(*parts), (np.uint32, np.uint8, kind)))
        # the bits above the group's are cut off with the byte's; the group gives them back
        h = low.astype(np.uint64) | (mid.astype(np.uint64) << np.uint64(32))
        h = (h & np.uint64((1 << rest) - 1)) | np.uint64(group << rest)
        h, count = _summed(h, count.astype(np.int64), threshold)
        return pd.DataFrame({"h": h[count >= threshold].view(np.int64)})

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts = None, []
        for b in batches:
            for g, *part in b[["g", "low", "mid", "count"]].itertuples(index=False):
                if g != at and parts:
                    yield total(at, parts)
                    parts = []
                at = g
                parts.append(part)
        if parts:
            yield total(at, parts)

    return docs.mapInPandas(sent, "g long, low binary, mid binary, count binary").repartition("g").sortWithinPartitions(
        "g").mapInPandas(totals, "h long")


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def sampled(rows: DataFrame, share: float) -> DataFrame:
    """(lang, text): a ``share`` of the pieces of all rows, drawn at random, one row a text with any."""
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for b in batches:
            texts = []
            for t in b["text"]:
                parts = t.encode("utf-8", "replace").translate(_MARKS).split(BREAK)
                picked = np.flatnonzero(rng.random(len(parts)) < share)
                texts.append(BREAK.join([parts[i] for i in picked]).decode("utf-8", "replace"))
            yield pd.DataFrame({"lang": b["lang"], "text": texts})

    return rows.mapInPandas(draw, "lang string, text string").filter("text <> ''")


def proposed(rows: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, share: float = SHARE) -> DataFrame:
    """(lang, n, phrase, h) of less than ``longest`` words that seem frequent by a sample of the pieces.

    Each level counts only phrases whose parts seem frequent, as the whole pass does.
    """
    spark = rows.sparkSession
    some = sampled(rows, share).checkpoint()
    least, out = max(2, int(LOWERED * threshold * share)), None
    for n in range(1, longest):
        known = spark.sparkContext.broadcast(gathered(out)) if out is not None else None
        level = phrase_counts(some, n, n, known).filter(F.col("a") >= least).drop("a", "holds").checkpoint()
        if level.isEmpty():
            return level if out is None else out
        out = level if out is None else out.union(level)
    return out


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD,
                     longest: int = LONGEST, share: float = SHARE) -> tuple[DataFrame, DataFrame, int]:
    """(lang, phrase, n, a) of every phrase of 1..longest words with a >= threshold; (lang, total) words; the passes."""
    sc, rows = docs.sparkSession.sparkContext, _rows(docs, text, lang)
    known = proposed(rows, threshold, longest, share)
    wanted = frequent_hashes(rows, longest, sc.broadcast(gathered(known)), threshold).checkpoint()
    failed = wanted.join(known.select("h"), "h", "left_anti")
    wider, passes = known.select("h").union(failed), 2
    found = phrase_counts(rows, 0, longest, *[sc.broadcast(gathered(x)) for x in (wider, wanted, failed)]).filter(
        (F.col("n") == 0) | (F.col("a") >= threshold)).checkpoint()
    total = found.filter("n = 0").select("lang", F.col("a").alias("total"))
    found = found.filter("n > 0")
    # A frequent phrase that is not counted yet holds a failure that was not followed, and each of
    # its parts is proposed, frequent, or holds such a failure: one more pass closes the search.
    missed = (found.filter(~F.col("holds") & (F.col("n") < longest)).join(known, ["lang", "n", "phrase"], "left_anti")
              .join(failed, "h", "left_anti").select("h").checkpoint())
    if not missed.isEmpty():
        wider, none, passes = wider.union(found.select("h")), missed.limit(0), 3
        found = found.union(phrase_counts(rows, 2, longest, *[sc.broadcast(gathered(x)) for x in (wider, none, missed)])
                            .filter(F.col("a") >= threshold))
    # a phrase that two passes counted has the same count in both
    return found.groupBy("lang", "phrase").agg(F.max("n").alias("n"), F.max("a").alias("a")), total, passes


def _part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(frequent: DataFrame, total: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more; the lowest cut counts.

    Parts of a frequent phrase are frequent, so their counts are at hand. Products are
    taken in 38 digits.
    """
    words, wide = F.split("phrase", " "), lambda c: F.col(c).cast("decimal(19,0)")
    count = lambda part, name: frequent.select("lang", F.col("phrase").alias(part), F.col("a").alias(name))
    cuts = (frequent.filter("n > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
            .select("lang", "phrase", "a", "k", _part(words, 1, F.col("k")).alias("left"),
                    _part(words, F.col("k") + 1, F.size(words)).alias("right")))
    cuts = cuts.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
    cuts = cuts.join(total.withColumnRenamed("total", "n"), "lang").select(
        "lang", "phrase", "a", "k", "l", "r", "n",
        ((wide("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(19,0)") * wide("n")).alias("top"),
        (wide("l") * wide("r")).alias("bottom"))
    cuts = cuts.withColumn("score", F.expr("top div bottom"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("c"))
    return best.select("lang", "phrase", "c.a", "c.l", "c.r", "c.n", "c.score")


def contained(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the greatest count among the phrases one word longer that hold it.

    A phrase that a longer one replaces everywhere is replaced by one only a word longer
    too, so this step suffices.
    """
    words = F.split("phrase", " ")
    parts = F.array(_part(words, 1, F.size(words) - 1), _part(words, 2, F.size(words) - 1))
    return frequent.filter("n > 2").select("lang", F.explode(parts).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD,
                 longest: int = LONGEST, top: int = TOP, share: float = SHARE) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    frequent, total, _ = frequent_phrases(docs, text, lang, threshold, longest, share)
    frequent = frequent.checkpoint()
    kept = scored(frequent, total).join(contained(frequent), ["lang", "phrase"], "left").filter(
        "longer is null or longer < a").drop("longer")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the best of each slice first, so that no task sorts all phrases of a language
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    kept = kept.withColumn("slice", slice_).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
