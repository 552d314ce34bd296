"""Incremental bronze ingest with Structured Streaming (T-1).

Re-aims a wait-for-file sensor and scheduled load: a file-source
stream with ``trigger(availableNow=True)`` picks up every file not seen before,
writes it to the bronze Parquet table with lineage columns, records progress in
the checkpoint, and stops. Re-running ingests only new files, and a run killed
half way resumes from the checkpoint without duplicates (the file sink commits
atomically per batch).

``upsert_available`` merges the new files into a keyed table instead: each batch reads and
rewrites only the partitions that its keys or rows touch, late rows the days they belong to.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.incremental import create_keyed, merge_into
from ..plans.versions import create_if_absent, file_system

LEDGER = "_applied"


def _rows(spark: SparkSession, target: str) -> int:
    """Rows of a table, from the files' footers; 0 if there is none yet."""
    try:
        return spark.read.parquet(target).count()
    except AnalysisException:
        return 0


def ingest_available(spark: SparkSession, source_dir: str, schema: T.StructType,
                     target: str, checkpoint: str, fmt: str = "csv",
                     options: dict[str, str] | None = None, run_ts: str | None = None,
                     max_files_per_trigger: int | None = None) -> int:
    """Ingest all files present now; return the number of rows written."""
    reader = spark.readStream.schema(schema).format(fmt)
    opts = {"header": "true", "escape": '"'} if fmt == "csv" else {}
    opts.update(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    stream = reader.options(**opts).load(source_dir)
    ingested_at = (F.lit(run_ts).cast("timestamp_ntz") if run_ts
                   else F.current_timestamp().cast("timestamp_ntz"))
    stamped = stream.select("*", ingested_at.alias("_ingested_at"),
                            F.col("_metadata.file_name").alias("_source_file"))
    # the sink's own row count: progress reports keep only the latest batches
    before = _rows(spark, target)
    q = (stamped.writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return _rows(spark, target) - before


def apply_batch(rows: DataFrame, batch: int, ledger: str, target: str, keys: Sequence[str],
                version: Sequence[str], part_col: str) -> bool:
    """Merge one batch into the keyed table unless the ledger names it; False if it does.

    The ledger's entry is made last. A batch that stopped before it is merged again, which
    changes nothing, since the newest version of a key wins and equal ones are one row.
    """
    spark = rows.sparkSession
    entry = f"{ledger}/{batch:012d}"
    fs, p, _ = file_system(spark, entry)
    if fs.exists(p):
        return False
    try:
        spark.read.parquet(target)
    except AnalysisException:  # the first rows make the table
        if not rows.isEmpty():
            create_keyed(rows, target, keys, version, part_col)
    else:
        merge_into(target, rows, keys, version, part_col)
    create_if_absent(spark, entry)
    return True


def upsert_available(spark: SparkSession, source_dir: str, schema: T.StructType, target: str, checkpoint: str,
                     keys: Sequence[str], version: Sequence[str], part_col: str, fmt: str = "csv",
                     prepare: Callable[[DataFrame], DataFrame] | None = None, options: dict[str, str] | None = None,
                     max_files_per_trigger: int | None = None) -> list[int]:
    """Merge all files present now into the keyed table, each exactly once in effect; returns the batches applied.

    ``prepare`` derives columns such as ``part_col`` from the raw rows. The ledger of applied
    batches lies in the checkpoint, whose batch numbers it holds: who loses the one loses
    both, and merging every file anew gives the same table. One such stream may write a table.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    opts = {"header": "true", "escape": '"'} if fmt == "csv" else {}
    opts.update(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    stream = reader.options(**opts).load(source_dir)
    applied: list[int] = []

    def merge(rows: DataFrame, batch: int) -> None:
        if apply_batch(rows, batch, f"{checkpoint}/{LEDGER}", target, keys, version, part_col):
            applied.append(batch)

    q = ((prepare(stream) if prepare else stream).writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return applied
