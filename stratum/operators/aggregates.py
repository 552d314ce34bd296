"""Aggregation operators: summaries, stacked segment rates, column profiles.

All of them are single ``agg`` calls so Spark plans partial (map-side) and final
aggregation around one shuffle; none collects a group into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rounded


def summarise(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column],
              having: Column | None = None) -> DataFrame:
    """``GROUP BY keys`` with named measures and an optional HAVING."""
    out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
    return out.filter(having) if having is not None else out


def segment_rates(df: DataFrame, dimensions: Mapping[str, Column | str],
                  measures: Mapping[str, Column],
                  dimension_col: str = "dimension", segment_col: str = "segment") -> DataFrame:
    """The same measures over several single-column groupings, stacked (A-17).

    One ``GROUPING SETS`` aggregate scans the input once, where a UNION ALL of
    per-dimension GROUP BYs scans it once per branch. The dimension name comes
    from ``grouping_id()``, so a NULL segment stays distinguishable.
    """
    names = list(dimensions)
    tmp = [f"_d{i}" for i in range(len(names))]
    base = df.select("*", *[(F.col(c) if isinstance(c, str) else c).cast("string").alias(t)
                            for c, t in zip(dimensions.values(), tmp)])
    agg = base.groupingSets([[F.col(t)] for t in tmp], *[F.col(t) for t in tmp]).agg(
        F.grouping_id().alias("_gid"), *[c.alias(n) for n, c in measures.items()])
    full = (1 << len(tmp)) - 1
    dim = seg = None
    for i, (name, t) in enumerate(zip(names, tmp)):
        gid = full ^ (1 << (len(tmp) - 1 - i))
        hit = F.col("_gid") == F.lit(gid)
        dim = F.when(hit, F.lit(name)) if dim is None else dim.when(hit, F.lit(name))
        seg = F.when(hit, F.col(t)) if seg is None else seg.when(hit, F.col(t))
    return agg.select(dim.alias(dimension_col), seg.alias(segment_col), *measures.keys())


def union_tagged(frames: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """UNION ALL by name of like-shaped frames, each tagged with its name (U-1)."""
    out = None
    for name, f in frames.items():
        t = f.select(F.lit(name).alias(tag), *f.columns)
        out = t if out is None else out.unionByName(t)
    if out is None:
        raise ValueError("no frames")
    return out


def nullness(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Replace every column except ``keep`` by a marker that is NULL exactly when it was.

    Profiles only need to know whether a value is NULL, so wide columns (text,
    arrays) can shrink to a boolean before a join or shuffle. The result has
    the same column names and the same NULL pattern.
    """
    return df.select(*[F.col(c) if c in keep else
                       F.when(F.col(c).isNotNull(), F.lit(True)).alias(c) for c in df.columns])


def null_profile(df: DataFrame, keep_zero: bool = False, column: str = "column_name",
                 count: str = "n_null") -> DataFrame:
    """Missing-value count per column in one pass, unpivoted (A-13)."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot([], cols, column, count)
    return long if keep_zero else long.filter(F.col(count) > 0)


def null_ratios(df: DataFrame, column: str = "column_name", ratio: str = "null_ratio",
                digits: int = 4) -> DataFrame:
    """Per-column NULL ratio (rounded) with the row total, one pass."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_rows"], cols, column, "_nulls")
    return long.select(column, F.col("_nulls").alias("n_null"), F.col("_rows").alias("n_rows"),
                       rounded(F.col("_nulls") / F.col("_rows"), digits).alias(ratio))


def sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Columns whose NULL ratio is above ``threshold`` (P-4 candidates)."""
    r = null_ratios(df)
    return r.filter(F.col("n_null") > F.col("n_rows") * F.lit(threshold))


def drop_sparse(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Drop the columns above the NULL-ratio threshold (one metrics row collected)."""
    names = [r[0] for r in sparse_columns(df, threshold).select("column_name").collect()]
    return df.drop(*names)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``count(*)``, ``count(distinct keys)`` and their difference, one row (A-15).

    Grouping by the key first (combined map-side) and counting groups avoids a
    distinct aggregate; keys with a NULL part are not counted as distinct,
    like ``count(distinct ...)``.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    total = F.coalesce(F.sum("_c"), F.lit(0)).cast("long")
    distinct = F.count_if(complete)
    return per_key.agg(total.alias("total_rows"), distinct.alias("distinct_keys"),
                       (total - distinct).alias("duplicate_rows"))



def profile(df: DataFrame) -> DataFrame:
    """Shape and per-column profile in one aggregate (S-10).

    One row per column: ``column_name, data_type, n_rows, n_null, n_distinct``
    (types are Spark's simple strings, taken from the schema, not the data).
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}"), F.count_distinct(c).alias(f"_d{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                     F.col("_rows").alias("n_rows"), F.col(f"_n{i}").alias("n_null"),
                     F.col(f"_d{i}").alias("n_distinct"))
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")
