"""Small helpers for work on Arrow batches inside Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

CHUNK_CHARS = 2_000_000


def chunks(batches: Iterator[pd.DataFrame], text: str, chars: int = CHUNK_CHARS) -> Iterator[pd.DataFrame]:
    """The rows of all batches in pieces of about ``chars`` characters (one row at least).

    Null texts become empty ones, so a task's working memory follows the longest text
    and not the number of rows in a batch.
    """
    for batch in batches:
        batch = batch.assign(**{text: batch[text].where(batch[text].notna(), "")})
        if not len(batch):
            continue
        group = batch[text].str.len().cumsum() // chars
        for _, part in batch.groupby(group.to_numpy(), sort=False):
            yield part.reset_index(drop=True)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start..start+length-1 of every span, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
