"""Exact quantiles per key by narrowing a value range (A-4): no sort of the table, no checkpoint of it.

Each round takes approximate percentiles of what is left of a key (a sketch, combined map-side) and
keeps two of them around the wanted rank. One aggregate then counts the rows below, at,
between and above the two, which tells exactly where the rank lies whatever the sketch's error:
at a bound, and the key is done, or in one of the three ranges, which is all the next round
looks at. The rank's neighbourhood shrinks by a fixed factor a round whatever the values'
distribution. Keys with at most ``FEW`` rows left are ranked directly.

A key that holds most of the table only sends sketches and counts, since every step over many rows is
an aggregate. The state is one row a key: it is broadcast within the size check, and
joined (split by adaptive execution where a key is hot) beyond it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import fits

FEW = 100_000
GRID = 256
ACCURACY = 4096
SHARES = ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1))
X, RANK, LEFT, LO, HI = "_x", "_rank", "_left", "_lo", "_hi"


Hint = Callable[[DataFrame], DataFrame]


def _on_keys(rows: DataFrame, state: DataFrame, names: Sequence[str], hint: Hint) -> DataFrame:
    """``rows`` with the state of their keys (NULL is a key), whose columns differ from the rows'."""
    side = state.select(*[F.col(n).alias(f"_s{n}") for n in names], *[c for c in state.columns if c not in names])
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_s{n}"))
    return rows.join(hint(side), same).drop(*[f"_s{n}" for n in names])


def _bounds(rows: DataFrame, state: DataFrame, names: Sequence[str], hint: Hint) -> DataFrame:
    """The state with the two sketched values around each key's rank; NULL where there is no bound."""
    sketch = rows.groupBy(*names).agg(F.expr(f"percentile_approx({X}, array({SHARES}), {ACCURACY})").alias("_g"))
    both = _on_keys(sketch, state, names, hint)
    at = (F.col(RANK) - F.lit(0.5)) / F.col(LEFT) * F.lit(GRID)
    return both.select(*names, RANK, LEFT,
                       F.get("_g", F.floor(at).cast("int") - 1).alias(LO),
                       F.get("_g", F.ceil(at).cast("int") + 1).alias(HI))


def _ranges(state: DataFrame, rows: DataFrame, names: Sequence[str], hint: Hint) -> DataFrame:
    """Where each key's rank lies: the counts of its rows before, at, between and behind its bounds."""
    x, lo, hi = F.col(X), F.col(LO), F.col(HI)
    # a missing bound lies beyond every row
    part = (F.when(x < lo, 0).when(x == lo, 1).when(x > hi, 4).when(x == hi, 3).otherwise(2))
    counted = _on_keys(rows, state, names, hint).withColumn("_part", part).groupBy(*names).agg(
        F.first(RANK).alias(RANK), F.first(LO).alias(LO), F.first(HI).alias(HI),
        *[F.count_if(F.col("_part") == p).alias(f"_c{p}") for p in range(5)])
    before, place, offset, size = F.lit(0), None, None, None
    for p in range(5):
        upto = before + F.col(f"_c{p}")
        here = F.col(RANK) <= upto
        place = F.when(here, p) if place is None else place.when(here, p)
        offset = F.when(here, before) if offset is None else offset.when(here, before)
        size = F.when(here, F.col(f"_c{p}")) if size is None else size.when(here, F.col(f"_c{p}"))
        before = upto
    return counted.select(*names, place.alias("_place"), (F.col(RANK) - offset).alias(RANK), size.alias(LEFT), LO, HI)


def _select(rows: DataFrame, state: DataFrame, names: Sequence[str], few: int, hint: Hint) -> DataFrame:
    """(names, value): the row of rank ``_rank`` (from 1) of every key of the state (names, _rank, _left)."""
    found = None
    while True:
        n_big = state.agg(F.count_if(F.col(LEFT) > few)).first()[0]
        # without a large key the rows left are those of the state already
        small = _on_keys(rows, state.filter(F.col(LEFT) <= few).select(*names, RANK), names, hint)
        ranked = small.withColumn("_n", F.row_number().over(Window.partitionBy(*names).orderBy(X)))
        done = ranked.filter(F.col("_n") == F.col(RANK)).select(*names, F.col(X).alias("_value"))
        found = done if found is None else found.union(done)
        if not n_big:
            return found
        big = state.filter(F.col(LEFT) > few)
        large = _on_keys(rows, big.select(*names), names, hint)
        placed = _ranges(_bounds(large, big, names, hint), large, names, hint).checkpoint()
        at_bound = F.col("_place").isin(1, 3)
        found = found.union(placed.filter(at_bound).select(
            *names, F.when(F.col("_place") == 1, F.col(LO)).otherwise(F.col(HI)).alias("_value")))
        open_ = placed.filter(~at_bound)
        x, place = F.col(X), F.col("_place")
        inside = (F.when(place == 0, x < F.col(LO)).when(place == 4, x > F.col(HI))
                  .otherwise(F.coalesce(x > F.col(LO), F.lit(True)) & F.coalesce(x < F.col(HI), F.lit(True))))
        # a share of the rows that falls with every round
        rows = _on_keys(rows, open_.select(*names, "_place", LO, HI), names, hint).filter(inside).select(
            *names, X).checkpoint()
        state = open_.select(*names, RANK, LEFT)


def group_quantile(df: DataFrame, keys: Sequence[str], col: str, q: float = 0.5, name: str = "quantile",
                   few: int = FEW) -> DataFrame:
    """(keys, name): the exact quantile of non-NULL ``col`` per key, as doubles, linear between two rows.

    The row numbered ``q * (n - 1)`` from 0 counts; between two rows their weighted mean does. A
    key without a value has no row; NULL is a key; NaN is above all numbers, as in a sort.
    """
    if not 0 <= q <= 1:
        raise ValueError(f"quantile {q} is not between 0 and 1")
    ensure_checkpoint_dir(df.sparkSession)
    # without keys one constant key stands for the table
    names = [f"_k{i}" for i in range(len(keys))] or ["_all"]
    named = [F.col(k).alias(n) for k, n in zip(keys, names)] or [F.lit(0).alias("_all")]
    rows = df.select(*named, F.col(col).cast("double").alias(X)).filter(F.col(X).isNotNull())
    at = F.lit(float(q)) * (F.col(LEFT) - 1)
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias(LEFT)).select(
        *names, LEFT, (F.floor(at) + 1).alias(RANK), (at - F.floor(at)).alias("_share")).checkpoint()
    # checked once: later states hold some of these keys and two bounds each
    hint: Hint = F.broadcast if fits(counts) else lambda side: side
    low = _select(rows, counts.select(*names, RANK, LEFT), names, few, hint)
    # the next row is the same value again, or the least above it
    both = _on_keys(rows, _on_keys(low, counts.select(*names, RANK, "_share"), names, hint), names, hint)
    out = both.groupBy(*names).agg(
        F.first("_value").alias("_value"), F.first(RANK).alias(RANK), F.first("_share").alias("_share"),
        F.count_if(F.col(X) <= F.col("_value")).alias("_upto"),
        F.min(F.when(F.col(X) > F.col("_value"), F.col(X))).alias("_above"))
    high = F.when(F.col("_upto") > F.col(RANK), F.col("_value")).otherwise(F.col("_above"))
    value = F.when(F.col("_share") == 0, F.col("_value")).otherwise(
        F.col("_value") * (F.lit(1.0) - F.col("_share")) + high * F.col("_share"))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], value.alias(name))


def quantile(df: DataFrame, col: str, q: float = 0.5, name: str = "quantile", few: int = FEW) -> DataFrame:
    """One-row frame with the exact quantile of ``col``; NULL where it has no value."""
    return group_quantile(df, [], col, q, name, few).agg(F.max(name).alias(name))
