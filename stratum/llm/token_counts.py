"""Token counts under a unigram model, by dynamic programming over a shared trie.

The model scores a piece of a public vocabulary file (one piece and rank per line) with
the logarithm of a Zipf weight of its rank; a pre-token is cut into the pieces of the
highest total score. The best score of a prefix does not depend on what follows, so the
distinct pre-tokens of a task go into a trie whose nodes hold the forward score and the
piece count of their prefix: both are computed once per shared prefix, and the count at
a word's last node is the word's. A node looks back along the vocabulary's reversed
pieces only, so a very long pre-token costs time in proportion to its length.

Rows are counted where they lie, without a shuffle; the trie is dropped when it passes
``MAX_NODES``, and pre-tokens of ``LONG_WORD`` characters or more, which share no prefix
worth keeping, are cut by the same step in two flat arrays. Both bound a worker's memory
and change no result.

Defined results: null and empty texts have 0 tokens; equal scores prefer fewer pieces;
bytes are pieces, so every text can be cut; repeated rows repeat their result, and other
columns are not read.
"""

from __future__ import annotations

import base64
import math
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.batches import chunks
from stratum.llm.bpe import split

MAX_NODES = 600_000
LONG_WORD = 50_000


def piece_scores(raw: bytes) -> dict[bytes, float]:
    """Log Zipf weight of each piece of a rank file; the 256 bytes share the last rank."""
    ranks = {base64.b64decode(a): int(r) for a, r in (line.split() for line in raw.splitlines() if line)}
    last = len(ranks)
    return {p: -math.log((last if len(p) == 1 else r) + 2) for p, r in ranks.items()}


class Terminals(dict):
    """Counts at the words' last nodes; an unknown word is inserted first, a long one only cut."""

    def __init__(self, insert: Callable[[str], int], cut: Callable[[str], int], long_word: int):
        super().__init__()
        self.insert, self.cut, self.long_word = insert, cut, long_word

    def __missing__(self, word: str) -> int:
        if len(word) >= self.long_word:
            return self.cut(word)
        n = self[word] = self.insert(word)
        return n


class Trie:
    """Prefixes of the words seen so far, with the best cut of each."""

    def __init__(self, scores: dict[bytes, float], long_word: int = LONG_WORD):
        self.long_word = long_word
        # reversed pieces: (node << 8 | byte) -> node, and the score where a piece ends
        self.back: dict[int, int] = {}
        self.back_score: list[float | None] = [None]
        for piece, score in scores.items():
            node = 0
            for byte in reversed(piece):
                key = node << 8 | byte
                if key not in self.back:
                    self.back[key] = len(self.back_score)
                    self.back_score.append(None)
                node = self.back[key]
            self.back_score[node] = score
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}
        self.score = [0.0]
        self.count = [0]
        self.terminal = Terminals(self.insert, self.cut, self.long_word)

    def insert(self, word: str) -> int:
        """Add a word; the number of pieces of its best cut."""
        data = word.encode("utf-8")
        path = [0]
        for d, byte in enumerate(data, 1):
            key = path[-1] << 8 | byte
            node = self.children.get(key)
            if node is None:
                best, pieces = self._best(data, d, self.score, self.count, path)
                node = self.children[key] = len(self.score)
                self.score.append(best)
                self.count.append(pieces)
            path.append(node)
        return self.count[path[-1]]

    def cut(self, word: str) -> int:
        """The number of pieces of a word's best cut, without adding the word."""
        data = word.encode("utf-8")
        score, count, path = array("d", [0.0]), array("q", [0]), range(len(data) + 1)
        for d in path[1:]:
            best, pieces = self._best(data, d, score, count, path)
            score.append(best)
            count.append(pieces)
        return count[-1]

    def _best(self, data: bytes, d: int, score: Sequence[float], count: Sequence[int],
              path: Sequence[int]) -> tuple[float, int]:
        """Score and pieces of the best cut of the first ``d`` bytes; ``path[j]`` holds that of ``j``."""
        best, pieces, back = -math.inf, 0, 0
        for j in range(d - 1, -1, -1):
            back = self.back.get(back << 8 | data[j])
            if back is None:
                break
            piece = self.back_score[back]
            if piece is not None:
                total, n = score[path[j]] + piece, count[path[j]] + 1
                if total > best or total == best and n < pieces:
                    best, pieces = total, n
        return best, pieces

    def tokens(self, text: str) -> int:
        total = sum(map(self.terminal.__getitem__, split(text)))
        if len(self.score) > MAX_NODES:
            self.clear()
        return total


@lru_cache(maxsize=2)
def trie(raw: bytes) -> Trie:
    return Trie(piece_scores(raw))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 path: str | None = None) -> DataFrame:
    """(id, n_tokens long) per row."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        vocab = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = trie(vocab.value)
        for part in chunks(batches, "t"):
            yield pd.DataFrame({"id": part["id"], "n": np.fromiter(map(t.tokens, part["t"]), np.int64, count=len(part))})

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("string").alias("t"))
    out = slim.mapInPandas(run, "id string, n long")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_tokens"))
