"""Join helpers. A side is broadcast only after its size is proven small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables within both bounds are broadcast; anything larger is left to Catalyst/AQE, which
# chooses sort-merge and splits skewed partitions.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes: text by its length, nested values by their JSON's."""
    total = F.lit(8 * (len(schema) + 1)).cast("long")
    for f in schema.fields:
        value = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(f.dataType, (T.StringType, T.BinaryType)):
            continue
        total = total + F.coalesce(F.octet_length(value), F.lit(0))
    return total


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows that take about ``max_bytes`` or less.

    The limit stops each task after ``max_rows + 1`` rows and only their sizes are moved,
    so the check costs at most that many rows per partition, not a full scan.
    """
    rows, size = (df.select(row_bytes(df.schema).alias("_b")).limit(max_rows + 1)
                    .agg(F.count(F.lit(1)), F.sum("_b")).first())
    return rows <= max_rows and (size or 0) <= max_bytes


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                    max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint if both bounds hold, else the frame unchanged."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
