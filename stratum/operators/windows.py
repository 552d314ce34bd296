"""Ranking and per-group window operators.

``row_number``/``rank``/``dense_rank`` followed by a filter on the rank are
planned with ``WindowGroupLimit`` before the shuffle, so each map task ships at
most ``n`` rows (plus ties) per key: a hot key does not reach one task whole.
Spark inserts that map-side limit for ``n`` up to
``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default); larger
``n`` keeps the plain window, which sorts and spills per key.
Ordered frames that scan a whole key (lag/lead/running/moving) live in
:mod:`stratum.operators.sequence`, which spreads hot keys over range partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, rounded
from .joins import BROADCAST_MAX_ROWS, fits


def _order(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    n: int = 1, name: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per key by a total order (W-1, U-3, S16)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    rn = name or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if name else out.drop(rn)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None,
          check_unique: bool = False) -> DataFrame:
    """Deterministic ``dropDuplicates``: one row per key, chosen by ``order``.

    Without an explicit order every non-key column is used, which is a total
    order whenever full rows are distinct. With ``check_unique`` the largest
    key group is measured first (an aggregate over the key columns only, one
    number to the driver): when every key is already unique the input is
    returned as is, saving the full-row shuffle and sort of the window.
    """
    order = list(order) if order else [c for c in df.columns if c not in keys]
    if check_unique:
        biggest = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                     .agg(F.max("_n")).collect()[0][0])
        if (biggest or 0) <= 1:
            return df
    return first_per_group(df, keys, order, 1)


def keep_latest(df: DataFrame, keys: Sequence[str], version: Sequence[Column | str]) -> DataFrame:
    """Newest version per key wins (K-11); ``version`` columns descending."""
    order = [F.col(v).desc_nulls_last() if isinstance(v, str) else v for v in version]
    return first_per_group(df, keys, order, 1)


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    n: int, rank_name: str = "rank", dense_name: str | None = None) -> DataFrame:
    """``rank() <= n`` per key (ties kept, so possibly more than n rows) (W-2, W-11, S19)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    out = df.withColumn(rank_name, F.rank().over(w))
    if dense_name:
        out = out.withColumn(dense_name, F.dense_rank().over(w))
    return out.filter(F.col(rank_name) <= n)


def diff_from_group_mean(df: DataFrame, keys: Sequence[str], value: str,
                         mean_name: str, diff_name: str, digits: int = 2) -> DataFrame:
    """Value minus its group's mean (W-10), as aggregate + join instead of a window.

    ``avg() OVER (PARTITION BY k)`` buffers a whole key in one task; the
    aggregate is partial before its shuffle and the join back is skew-split by
    AQE, or broadcast when the number of groups is proven small.
    """
    means = df.groupBy(*keys).agg(exact_mean(value).alias("_mean"))
    # AQE sees the aggregate's real size at run time and broadcasts it when small
    joined = df.join(means, list(keys), "left")
    return (joined.withColumn(mean_name, rounded(F.col("_mean"), digits))
                  .withColumn("_diff", F.col(value) - F.col("_mean"))
                  .withColumn(diff_name, rounded(F.col("_diff"), digits)))


def top_k_diff_from_mean(df: DataFrame, keys: Sequence[str], value: str, tie: str, k: int,
                         mean_name: str, diff_name: str, digits: int = 2,
                         max_groups: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The ``k`` rows with the largest ``value - mean(value) per key`` (ties by ``tie``).

    The per-key means are aggregated once (map-side) and checkpointed; when
    their row count is within ``max_groups`` they are broadcast, so every row
    gets its difference without the table being shuffled, and the top ``k`` is
    taken map-side (``TakeOrderedAndProject``). Beyond the bound a shuffle join
    is used (AQE splits hot keys). Every row is ranked by the exact ordering
    expression, so there is no per-key candidate cap.
    """
    means = df.groupBy(*keys).agg(exact_mean(value).alias("_mean")).checkpoint(eager=True)
    side = F.broadcast(means) if fits(means, max_groups) else means
    scored = (df.join(side, list(keys))
                .withColumn("_diff", F.col(value) - F.col("_mean"))
                .withColumn(mean_name, rounded(F.col("_mean"), digits))
                .withColumn(diff_name, rounded(F.col("_diff"), digits)))
    return top_k(scored, [F.col("_diff").desc(), F.col(tie).asc()], k).drop("_mean", "_diff")


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """Sort + limit planned as ``TakeOrderedAndProject`` (O-2, O-4)."""
    return df.orderBy(*_order(order)).limit(k)
