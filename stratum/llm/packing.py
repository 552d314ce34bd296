"""Best-fit packing of tokenised documents into sequences of bounded length.

Tokenising happens where the rows lie and leaves one small row per piece; those rows, not
the texts, are dealt evenly over tasks of about ``PIECES_PER_TASK`` pieces. A task packs
its stream online with a fixed number of open sequences, kept in a bitset keyed by free
space: a piece goes to the fullest open sequence that holds it, found as the lowest set
bit at or above its length; when all are open, the fullest closes first. Long pieces of a
batch go first. Memory is a batch and the open sequences, which also bound the unfilled
tail of a task.

Ids come from the ``tiktoken`` library, four times as fast as the JSON's; a text that its
pattern engine refuses (white space running over about a million characters) is encoded by
``bpe.Codec``, which gives the same ids.

Defined results: null and empty texts are the end token alone; a document longer than a
sequence is cut from its end, so that only its first piece may be shorter; repeated rows
are packed as often as they occur; other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import bpe
from stratum.llm.batches import chunks

CAPACITY = 1024
END_ID = 2
OPEN_SEQUENCES = 16_384
PIECES_PER_TASK = 400_000
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


class OpenSequences:
    """Bounded-space online best fit."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN_SEQUENCES, first_id: int = 0):
        self.capacity, self.most, self.next_id = capacity, most, first_id
        self.free = 0                                       # bit f: a sequence with f free places is open
        self.ids: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0

    def _take(self, space: int) -> int:
        found = self.ids[space].pop()
        if not self.ids[space]:
            self.free &= ~(1 << space)
        self.n_open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of 1..capacity tokens."""
        fits = self.free >> length
        if fits:
            space = (fits & -fits).bit_length() - 1 + length
            sequence = self._take(space)
        else:
            space, sequence = self.capacity, self.next_id
            self.next_id += 1
        left = space - length
        if left:
            if self.n_open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            self.ids[left].append(sequence)
            self.free |= 1 << left
            self.n_open += 1
        return sequence, self.capacity - space


@lru_cache(maxsize=2)
def tokenizer(raw: bytes) -> tiktoken.Encoding:
    """The vocabulary's rank file in the ``tiktoken`` library: same ids as the JSON, faster."""
    ranks = {base64.b64decode(a): int(r) for a, r in (line.split() for line in raw.splitlines() if line)}
    return tiktoken.Encoding("packing", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})


def encoded(enc: tiktoken.Encoding, text: str, vocabulary: bytes) -> np.ndarray:
    """Ids of a text; ``vocabulary`` is the same vocabulary as the tokenizer's JSON."""
    try:
        return enc.encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return bpe.codec(vocabulary).encode([text])[0]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``length`` tokens."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, path: str | None = None, json_path: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32) per piece of every document.

    ``path`` and ``json_path`` are a vocabulary's rank file and its JSON.
    """
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        vocab = docs.sparkSession.sparkContext.broadcast(f.read())
    spec = bpe.vocabulary(docs.sparkSession, json_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = tokenizer(vocab.value), END_ID.to_bytes(4, "little")
        for part in chunks(batches, "t"):
            rows = []
            for key, text_ in zip(part["id"], part["t"]):
                data = encoded(enc, text_, spec.value).astype("<u4", copy=False).tobytes() + end
                for k, (s, n) in enumerate(cut(len(data) // 4, capacity)):
                    rows.append((key, k, s, n, zlib.crc32(data[4 * s:4 * (s + n)])))
            yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"])

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("string").alias("t"))
    out = slim.mapInPandas(run, "id string, piece int, start long, length long, ids_crc32 long")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "piece", "start", "length", "ids_crc32")


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         open_sequences: int = OPEN_SEQUENCES, pieces_per_task: int = PIECES_PER_TASK,
         path: str | None = None, json_path: str | None = None) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    table = pieces(docs, id_col, text, capacity, path, json_path).checkpoint()
    tasks = max(1, -(-table.count() // pieces_per_task))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = OpenSequences(capacity, open_sequences, TaskContext.get().partitionId() << 40)
        for b in batches:
            b = b.sort_values(["length", "id", "piece"], ascending=False)
            at = [bins.place(n) for n in b["length"]]
            yield b.assign(sequence_id=[s for s, _ in at], offset=[o for _, o in at])

    slim = table.select(F.col(id_col).cast("string").alias("id"), "piece", "start", "length", "ids_crc32")
    out = slim.repartition(tasks).mapInPandas(
        run, "id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
                      "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
