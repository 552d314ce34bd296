"""Byte-level BPE: encoding by batched numpy merge rounds, and decoding.

Pre-tokens of a chunk of documents are looked up in a bounded memo; the new distinct ones
lie in one flat symbol array. A round finds the rank of every adjacent pair by binary
search over the sorted pair keys, takes each word's lowest rank, merges all its
occurrences from the left, and drops the words that have none left. Work is
per task without any shuffle; the vocabulary (a fixed file of a public tokenizer) is read
on the driver and broadcast.

Defined results: null is the empty text, which has no ids and decodes to the empty text;
strings of added tokens in a text are those tokens; rows are independent, so repeated rows
give repeated results, and columns beside the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.batches import chunks, spans

# fixed value: the split that byte-level vocabularies of this family were made with
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# the same split where every character is in Latin-1, with the classes spelled out for ``re``
LATIN = re.compile(
    r"""'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+| ?[0-9²³¹¼½¾]+"""
    r"""| ?[^\t-\r \x85\xa0A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼½¾]+"""
    r"""|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+""")
ANY = regex.compile(PATTERN)
MEMO_WORDS = 300_000
NO_RANK = np.iinfo(np.int32).max


def split(text: str) -> list[str]:
    """Pre-tokens of a text."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return ANY.findall(text)
    return LATIN.findall(text)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file (the tokenizer's JSON as bytes)."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        vocab: dict[str, int] = spec["model"]["vocab"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.first = np.array([vocab[c] for c in symbols], dtype=np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)[order]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_split = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
                            if self.added else None)
        table = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        table |= {i: t.encode() for t, i in self.added.items()}
        out = [table.get(i, b"") for i in range(max(table) + 1)]
        self.out_len = np.array([len(t) for t in out], dtype=np.int64)
        self.out_start = np.cumsum(self.out_len) - self.out_len
        self.out_bytes = np.frombuffer(b"".join(out), dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        """An empty memo: word -> row of (start, length) in the flat id store."""
        self.memo: dict[str, int] = {}
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)
        self.store = np.empty(0, np.int64)
        if self.added:
            self._remember(list(self.added), np.array(list(self.added.values())), np.ones(len(self.added), np.int64))

    def _remember(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.memo.update(zip(words, range(len(self.memo), len(self.memo) + len(words))))
        ends = np.cumsum(lengths)
        self.start = np.concatenate([self.start, len(self.store) + ends - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.store = np.concatenate([self.store, ids])

    def pretokens(self, text: str) -> list[str]:
        if self.added_split is None or not any(t in text for t in self.added):
            return split(text)
        out: list[str] = []
        for k, part in enumerate(self.added_split.split(text)):
            out += [part] if k % 2 else split(part)
        return out

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all (non-empty) words and the number of ids of each."""
        sizes = np.fromiter(map(len, words), np.int64, count=len(words))
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        rank, made = np.empty(len(sym), np.int32), np.empty(len(sym), np.int64)
        self._rank(sym, word, rank, made, np.arange(len(sym)))
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(sym)]))
            over = low == NO_RANK
            done_sym.append(sym[over])
            done_word.append(word[over])
            hit = (rank == low) & ~over
            # of a run of equal pairs (as in "aaa") every second one merges, from the left
            place = np.arange(len(sym))
            begin = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            hit &= (place - begin) % 2 == 0
            where = np.flatnonzero(hit)
            sym[where] = made[where]
            stay = ~over
            stay[where + 1] = False
            sym, word, rank, made = sym[stay], word[stay], rank[stay], made[stay]
            fresh = np.flatnonzero(hit[stay])
            self._rank(sym, word, rank, made, np.concatenate([fresh, fresh[fresh > 0] - 1]))
        flat, owner = np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=len(words))

    def _rank(self, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, made: np.ndarray, at: np.ndarray) -> None:
        """Set the rank, and the symbol made, of the pairs that begin at the places ``at``."""
        rank[at] = NO_RANK
        at = at[at + 1 < len(sym)]
        at = at[word[at] == word[at + 1]]
        key = (sym[at] << 32) | sym[at + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[found] == key
        at, found = at[known], found[known]
        rank[at], made[at] = self.ranks[found], self.merged[found]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        tokens = [self.pretokens(t) for t in texts]
        memo = self.memo
        new = [w for w in set().union(*tokens) if w not in memo]
        if new:
            self._remember(new, *self.merge([w.encode("utf-8") for w in new]))
        rows = np.fromiter(map(memo.__getitem__, chain.from_iterable(tokens)), np.int64)
        lengths = self.length[rows]
        ids = self.store[spans(self.start[rows], lengths)]
        ends = np.r_[0, np.cumsum(lengths)]
        cuts = ends[np.cumsum([len(ws) for ws in tokens])[:-1]] if len(tokens) else []
        return np.split(ids, cuts)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return self.out_bytes[spans(self.out_start[ids], self.out_len[ids])].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(raw: bytes) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(raw)


def vocabulary(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The vocabulary file, read on the driver and broadcast (a fixed, small file)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids array<int>) per row."""
    vocab = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(vocab.value)
        for part in chunks(batches, "t"):
            yield pd.DataFrame({"id": part["id"], "ids": [x.astype(np.int32) for x in c.encode(part["t"].tolist())]})

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("string").alias("t"))
    out = slim.mapInPandas(run, "id string, ids array<int>")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "ids")


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` with its id arrays replaced by a column ``text``."""
    vocab = vocabulary(encoded.sparkSession, path)

    @F.pandas_udf("string")
    def run(col: pd.Series) -> pd.Series:
        c = codec(vocab.value)
        return col.map(lambda x: None if x is None else c.decode(np.asarray(x, dtype=np.int64)))

    return encoded.withColumn("text", run(F.col(ids))).drop(*[ids] * (ids != "text"))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Digests of a text's ids and of their decoded text, in one pass over the rows."""
    vocab = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(vocab.value)
        for part in chunks(batches, "t"):
            ids = c.encode(part["t"].tolist())
            yield pd.DataFrame({
                "id": part["id"], "n_tokens": [len(x) for x in ids],
                "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(c.decode(x).encode("utf-8")).hexdigest() for x in ids]})

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("string").alias("t"))
    out = slim.mapInPandas(run, "id string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
                      "n_tokens", "ids_sha256", "decoded_sha256")
