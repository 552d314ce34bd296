"""Table profiles kept as mergeable state per partition (S-10, A-5).

The state of a partition is one small row per column: rows, NULLs and an HLL sketch of the
distinct values. It comes from one aggregate without a copy of the rows per column, combined
in the tasks, and states merge, so a partition that is added or rewritten is the only one read
again, and the profile of the table comes from the stored states. Distinct counts are
estimates with a relative standard error of about ``1 / sqrt(2 ** LG_K)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layers import overwrite_partitions

LG_K = 14
SKETCHED = ("int", "bigint", "string", "binary")


def partition_states(df: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """(partition columns, column_name, data_type, n_rows, n_null, sketch), a row per partition and column."""
    fields = [f for f in df.schema.fields if f.name not in partition_cols]
    kinds = {f.name: f.dataType.simpleString() for f in fields}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (name, kind) in enumerate(kinds.items()):
        value = F.col(f"`{name}`")
        aggs += [F.count_if(value.isNull()).alias(f"_n{i}"),
                 F.hll_sketch_agg(value if kind in SKETCHED else value.cast("string"), LG_K).alias(f"_s{i}")]
    rows = [F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"), F.col("_rows").alias("n_rows"),
                     F.col(f"_n{i}").alias("n_null"), F.col(f"_s{i}").alias("sketch"))
            for i, (name, kind) in enumerate(kinds.items())]
    wide = df.groupBy(*partition_cols).agg(*aggs)
    return wide.select(*partition_cols, F.explode(F.array(*rows)).alias("_p")).select(*partition_cols, "_p.*")


def merged(states: DataFrame) -> DataFrame:
    """(column_name, data_type, n_rows, n_null, n_distinct) over any states."""
    return states.groupBy("column_name", "data_type").agg(
        F.sum("n_rows").cast("long").alias("n_rows"), F.sum("n_null").cast("long").alias("n_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def refresh_profile(rows: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Replace the stored states of the partitions that ``rows`` holds; all other states stay.

    ``rows`` must hold whole partitions.
    """
    overwrite_partitions(partition_states(rows, partition_cols), path, partition_cols)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return merged(spark.read.parquet(path))
