"""Lake layers: bronze stamping, partitioned writes, atomic publish, upserts.

Writes never overwrite a path that the same plan reads. ``publish`` (see
:mod:`stratum.plans.versions`) writes a version of its own, validates it, and only then
points the table to it, so a failed run leaves the previous one intact (H3 / G-6). Partitioned writes shuffle by
the partition columns first, so each value is written by one task (H6) rather
than one file per task per value; a salt column splits hot values over several
tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import sized_broadcast
from ..operators.windows import keep_latest
from ..session import ensure_checkpoint_dir
from .versions import current_version, publish, published_path, read_published  # noqa: F401


def _file_name(df: DataFrame):
    """The scan's file name: ``_metadata`` on a direct file scan, else the
    per-row input file (works through unions); NULL for non-file sources."""
    from pyspark.errors import AnalysisException

    try:
        df.select(F.col("_metadata.file_name"))
        return F.col("_metadata.file_name")
    except AnalysisException:
        return F.nullif(F.regexp_extract(F.input_file_name(), r"[^/]*$", 0), F.lit(""))


def bronze_stamp(df: DataFrame, run_ts: str, source_file: str | None = None) -> DataFrame:
    """Lineage columns (K-6): one run timestamp literal and the source file name.

    The file name comes from the scan itself unless a constant is given.
    """
    src = F.lit(source_file) if source_file else _file_name(df)
    return df.select("*", F.lit(run_ts).cast("timestamp_ntz").alias("_ingested_at"),
                     src.alias("_source_file"))


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      mode: str = "overwrite", salt_buckets: int = 1) -> None:
    """Hive-style partitioned Parquet (K-2), one shuffle by the partition values.

    Adaptive execution splits a value that holds many rows over several tasks (and
    files); ``salt_buckets > 1`` fixes their number instead.
    """
    cols = [F.col(c) for c in partition_cols]
    if salt_buckets > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
        shaped = df.repartition(*cols, salt)
    else:
        shaped = df.hint("rebalance", *partition_cols)
    shaped.write.mode(mode).partitionBy(*partition_cols).parquet(path)


def write_clustered(df: DataFrame, path: str, col: str, mode: str = "overwrite",
                    num_files: int | None = None) -> None:
    """Range-cluster on ``col`` (K-9) so file and row-group min/max statistics skip data.

    Spark has no secondary index; clustering is what makes ``col > x`` read
    only the files and row groups that can match. ``num_files`` fixes the
    number of ranges (AQE keeps an explicit count); by default AQE sizes them.
    """
    ranged = (df.repartitionByRange(num_files, F.col(col)) if num_files
              else df.repartitionByRange(F.col(col)))
    ranged.sortWithinPartitions(col).write.mode(mode).parquet(path)


def interleaved(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    """Layout key of several numeric or time columns: the bits of their range ranks, in turns (K-9).

    A column's rank is the number of its ``2 ** bits - 1`` quantiles that lie below a value
    (NULL: 0), from one mergeable aggregate over all columns, so the ranks are even whatever
    the distribution. Rows close in every column lie close in the order.
    """
    if not cols or bits * len(cols) > 62:
        raise ValueError("1 to 62 bits in all")
    shares = F.array(*[F.lit(k / 2 ** bits) for k in range(1, 2 ** bits)])
    cuts = df.agg(*[F.percentile_approx(_number(df, c), shares).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        edges = F.array(*[F.lit(float(x)) for x in cuts[i] or []]).cast("array<double>")
        value = _number(df, c)
        rank = F.coalesce(F.size(F.filter(edges, lambda x, value=value: x < value)), F.lit(0)).cast("long")
        for k in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(rank, k).bitwiseAND(F.lit(1).cast("long")), k * len(cols) + i))
    return key


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.simpleString()
    c = F.col(name)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if kind in ("string", "binary", "boolean") or "<" in kind:
        raise ValueError(f"{name}: numeric or time columns only")
    return c.cast("double")


def write_interleaved(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite",
                      num_files: int | None = None, bits: int = 6) -> None:
    """Cluster on several columns at once, so that a filter on any of them skips files (K-9)."""
    keyed = df.withColumn("_layout", interleaved(df, cols, bits))
    ranged = keyed.repartitionByRange(num_files, "_layout") if num_files else keyed.repartitionByRange("_layout")
    ranged.sortWithinPartitions("_layout").drop("_layout").write.mode(mode).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (K-10, dynamic overwrite).

    Rows are rebalanced by the partition values, so adaptive execution splits a hot value
    over several tasks and joins small ones.
    """
    (df.hint("rebalance", *partition_cols).write
       .option("partitionOverwriteMode", "dynamic").mode("overwrite")
       .partitionBy(*partition_cols).parquet(path))


def affected_partitions(df: DataFrame, ts_col: str, part_col: str, lookback: str,
                        unit: str = "day") -> DataFrame:
    """Rows of every partition touched by the look-back window before the newest row.

    ``part_col`` must not be coarser than ``unit`` of ``ts_col``. The window's start, cut to
    ``unit``, becomes one literal range on ``ts_col`` that reaches the scan as a pushed
    filter; which partitions have rows in the window is then decided within that range. The
    literal travels as text, so the driver's time zone plays no part.
    """
    start = F.max(ts_col) - F.expr(f"INTERVAL {lookback}")
    cutoff, aligned = df.agg(start.cast("string").alias("c"),
                             F.date_trunc(unit, start).cast("string").alias("a")).first()
    if cutoff is None:
        return df.limit(0)
    kind = df.schema[ts_col].dataType
    recent = df.filter(F.col(ts_col) >= F.lit(aligned).cast(kind))
    part_kind = df.schema[part_col].dataType
    if part_kind.simpleString() in ("date", "timestamp", "timestamp_ntz"):
        # the same range on the partition column prunes the folders of a partitioned table
        recent = recent.filter(F.col(part_col) >= F.lit(aligned).cast(part_kind))
    touched = recent.filter(F.col(ts_col) >= F.lit(cutoff).cast(kind)).select(part_col).distinct()
    return recent.join(touched, part_col, "left_semi")


def upsert_latest(current: DataFrame, changes: DataFrame, keys: Sequence[str],
                  version: Sequence[str], current_unique: bool = False) -> DataFrame:
    """Union the change set into the table; the newest version per key wins (K-11).

    With ``current_unique`` (the table holds one row per key, as every earlier upsert leaves
    it) only rows whose key the change set names are compared and shuffled. The change
    set's keys are checkpointed and counted; within the broadcast bound they are broadcast
    and the rest of the table passes through untouched, so shuffled bytes follow the change
    set and not the table. Beyond the bound both sides are shuffled by key.
    """
    # among equal versions the greatest row stays, so that the result does not depend on the layout
    version = [*version, *(f.name for f in sorted(current.schema.fields, key=lambda f: f.name)
                           if f.name not in keys and f.name not in version and "map<" not in f.dataType.simpleString())]
    if not current_unique:
        return keep_latest(current.unionByName(changes), keys, version)
    ensure_checkpoint_dir(current.sparkSession)
    named = sized_broadcast(
        changes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct().checkpoint())
    same = None
    for i, k in enumerate(keys):  # a NULL key is a key of its own, as in the window
        eq = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        same = eq if same is None else same & eq
    untouched = current.join(named, same, "left_anti")
    touched = current.join(named, same, "left_semi")
    return keep_latest(touched.unionByName(changes), keys, version).unionByName(untouched)


def rebuild_if_changed(source: DataFrame, key: str, ts: str, state: str, build) -> bool:
    """Call ``build()`` only when the source's checksum differs from the recorded one (D-15).

    The one-row checksum is published to ``state`` after the build, so a failed build is
    repeated by the next run. Returns whether it was built.
    """
    from ..operators.quality import checksum, rebuild_needed

    spark = source.sparkSession
    measured = checksum(source, key, ts)
    now = spark.createDataFrame(measured.collect(), measured.schema)
    if not rebuild_needed(now, read_published(spark, state) if current_version(spark, state) else None):
        return False
    build()
    publish(now, state)
    return True


def layer_report(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Rows, Parquet bytes, files and folders (partitions) per layer (K-8), computed by Spark.

    Sizes come from the scan's ``_metadata`` (one row per file after a
    distinct), so no driver-side directory walk is needed.
    """
    out = None
    for name, path in layers.items():
        per_file = (read_published(spark, path)
                    .groupBy("_metadata.file_path", "_metadata.file_size")
                    .agg(F.count(F.lit(1)).alias("_rows")))
        row = per_file.agg(F.lit(name).alias("layer"), F.lit(path).alias("path"),
                           F.sum("_rows").cast("long").alias("n_rows"),
                           F.count(F.lit(1)).alias("n_files"),
                           F.count_distinct(F.regexp_replace("file_path", "/[^/]*$", "")).alias("n_folders"),
                           F.sum("file_size").cast("long").alias("bytes"))
        out = row if out is None else out.unionByName(row)
    return out


def enforced(df: DataFrame, not_null: Sequence[str] = (),
             defaults: Mapping[str, object] | None = None) -> DataFrame:
    """NULLs of ``defaults`` columns filled, and a NULL left in a ``not_null`` column fails the job (K-13).

    Both are part of the projection that is written, so there is no pass of its own.
    """
    defaults = dict(defaults or {})
    unknown = {*not_null, *defaults} - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")

    def column(f):
        c = F.col(f.name)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        if f.name in not_null:
            c = F.coalesce(c, F.raise_error(f"NULL in column {f.name}").cast(f.dataType))
        return c.alias(f.name)
    return df.select(*[column(f) for f in df.schema.fields])


def load_table(df: DataFrame, name: str, mode: str = "overwrite",
               partition_cols: Sequence[str] = (), not_null: Sequence[str] = (),
               defaults: Mapping[str, object] | None = None) -> None:
    """Catalog table load, replace or append (K-3), under NOT NULL and default rules (K-13)."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    w = enforced(df, not_null, defaults).write.mode(mode).format("parquet")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, ddl_columns: str,
                 partition_cols: Sequence[str] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` with a typed column list (K-13)."""
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING parquet{part}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _files(spark: SparkSession, path: str) -> list[str]:
    try:
        return spark.read.parquet(path).inputFiles()
    except AnalysisException:  # no table yet
        return []


def write_checked(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write Parquet and verify the read-back row count (K-7).

    The written count is observed during the write (no extra pass over the
    input); only the read-back count scans the output. An append reads back the files that
    it added; another writer's files among them would count, and raise.
    """
    from pyspark.sql import Observation

    spark, obs = df.sparkSession, Observation("write_checked")
    before = set(_files(spark, path)) if mode == "append" else set()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    written = int(obs.get["rows"])
    added = [f for f in _files(spark, path) if f not in before]
    read_back = spark.read.schema(df.schema).parquet(*added).count() if added else 0
    if read_back != written:
        raise RuntimeError(f"wrote {written} rows but read back {read_back} from {path}")
    return written


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               mode: str = "append", batch_size: int = 1000,
               max_connections: int | None = None) -> None:
    """Load a frame into a JDBC table (K-3, H7): batched inserts, bounded connections.

    ``max_connections`` coalesces the frame so at most that many tasks (and
    database connections) write concurrently.
    """
    out = df.coalesce(max_connections) if max_connections else df
    w = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    for k, v in properties.items():
        w = w.option(k, v)
    w.save()


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int,
                   mode: str = "overwrite") -> None:
    """Catalog table bucketed (and sorted) by ``keys``.

    Two tables bucketed by the same join key into the same number of buckets
    join without an Exchange on either side: the shuffle is paid once, at
    write time, instead of in every query that joins them.
    """
    # one task per bucket, so that a bucket is one file and not one per task
    (df.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
       .saveAsTable(name))


def refresh_affected(source: DataFrame, ts_col: str, part_col: str, lookback: str,
                     build, target: str) -> DataFrame:
    """Incremental mart refresh (K-10): rebuild only partitions the look-back touches.

    ``build(rows)`` turns the source rows of the affected partitions into mart
    rows that keep ``part_col``; those partitions are replaced in ``target``
    with dynamic overwrite and every other partition is left as written.
    Returns the rebuilt mart rows.
    """
    mart = build(affected_partitions(source, ts_col, part_col, lookback))
    overwrite_partitions(mart, target, [part_col])
    return mart
