"""First rows and repeatable random samples (S-10, O-3).

A sample keeps the rows whose key has the smallest hash, so it depends on the keys and the
seed alone, not on partitions, files or the order of rows. Both forms are limited in every
task before anything moves: ``TakeOrderedAndProject`` for the whole table,
``WindowGroupLimit`` per stratum, so a stratum that holds most rows sends ``k`` a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import first_per_group, top_k


def preview(df: DataFrame, n: int, order: Sequence[Column | str] = ()) -> DataFrame:
    """The first ``n`` rows: by ``order`` if given, else as the scan brings them (reads no further than it must)."""
    return top_k(df, order, n) if order else df.limit(n)


def priority(keys: Sequence[str], seed: int = 0) -> Column:
    """A row's place in the draw: MD5 of ``seed:key1:key2...``; a NULL part is written as ``~``."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("~")) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def sample_rows(df: DataFrame, k: int, keys: Sequence[str], seed: int = 0, strata: Sequence[str] = ()) -> DataFrame:
    """``k`` random rows without replacement, of the table or of each stratum (NULL is one); fewer if there are fewer.

    ``keys`` should name a row; rows of equal keys are told apart by all their columns.
    """
    rows = df.withColumn("_draw", priority(keys, seed))
    order = ["_draw", *keys, *[c for c in df.columns if c not in keys]]
    if strata:
        return first_per_group(rows, list(strata), order, k).drop("_draw")
    return top_k(rows, order, k).drop("_draw")
