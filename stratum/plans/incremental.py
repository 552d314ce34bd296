"""Stored tables kept up to date partition by partition (K-10, K-11, D-15).

``merge_into`` applies a change set to a table that is stored by partition. Beside the
table lies a key filter for every partition: a Bloom filter as a Spark table of 64-bit
words, four bits of one word for each key. The changed keys are joined with the words they
fall on, which names the partitions that may hold them; only those and the ones that the
changes belong to are read, merged and overwritten. Filters never miss a key; one that is
let through by mistake costs the reading of a partition.

``changed_partitions`` compares the checksums of two versions level by level, from the
whole table through coarser groups of partitions to the partitions, and goes down only
where sums differ, so ``rebuild_changed`` rebuilds only partitions whose rows changed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import keep_latest
from ..session import ensure_checkpoint_dir
from .layers import overwrite_partitions, upsert_latest
from .versions import current_version, file_system, publish, read_published

FILTERS = "._keys"
KEYS_PER_WORD = 4
WORDS, WORD, BITS = "_words", "_word", "_bits"


def _latest(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key: the newest version; among equal versions the greatest row."""
    rest = sorted(c for c in df.columns if c not in keys and c not in version)
    return keep_latest(df, keys, [*version, *rest])


def _hashes(keys: Sequence[str]) -> tuple[Column, Column]:
    """A key's word number before the modulus, and its four bits within the word."""
    bit = F.xxhash64(F.lit(1), *keys)
    mask = F.lit(0).cast("long")
    for k in range(4):
        place = F.shiftrightunsigned(bit, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.xxhash64(*keys), mask


def key_filters(df: DataFrame, keys: Sequence[str], part_col: str) -> DataFrame:
    """(part_col, words, word, bits): a key filter for every partition, sized by its rows to a power of two."""
    sizes = df.groupBy(part_col).agg(F.greatest(F.lit(6), F.ceil(F.log2(
        F.count(F.lit(1)) / KEYS_PER_WORD)).cast("int")).alias("_log")).select(
        F.col(part_col).alias("_part"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_log")).alias(WORDS))
    word, mask = _hashes(keys)
    rows = df.select(part_col, word.alias("_h"), mask.alias(BITS))
    rows = rows.join(sizes, F.col(part_col).eqNullSafe(F.col("_part"))).withColumn(WORD, F.pmod("_h", WORDS))
    return rows.groupBy(part_col, WORDS, WORD).agg(F.bit_or(BITS).alias(BITS))


def create_keyed(df: DataFrame, path: str, keys: Sequence[str], version: Sequence[str], part_col: str) -> None:
    """Store ``df``, one row per key, by ``part_col``, with the key filters beside it."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = _latest(df, keys, version).checkpoint()
    overwrite_partitions(key_filters(rows, keys, part_col), path + FILTERS, [part_col])
    overwrite_partitions(rows, path, [part_col])


def _touched(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], part_col: str) -> list:
    """Partitions that may hold a changed key or get a changed row; never more than the table's and the changes'."""
    filters = spark.read.parquet(path + FILTERS)
    sizes = [r[0] for r in filters.select(WORDS).distinct().collect()]  # powers of two: a few dozen at most
    word, mask = _hashes(keys)
    probes = changes.select(word.alias("_h"), mask.alias("_mask")).distinct().select(
        "*", F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<long>")).alias("_size"))
    probes = probes.withColumn("_at", F.pmod("_h", "_size"))
    hit = filters.join(probes, (F.col(WORDS) == F.col("_size")) & (F.col(WORD) == F.col("_at"))
                       & (F.col(BITS).bitwiseAND(F.col("_mask")) == F.col("_mask")))
    return [r[0] for r in hit.select(part_col).union(changes.select(part_col)).distinct().collect()]


def _within(column: str, values: Sequence) -> Column:
    """A literal list, which prunes the partitions of a scan; NULL may be among the values."""
    some = [v for v in values if v is not None]
    cond = F.col(column).isin(some) if some else F.lit(False)
    return cond | F.col(column).isNull() if len(some) < len(values) else cond


def _drop_partitions(spark: SparkSession, path: str, part_col: str, values: Sequence) -> None:
    """Delete the folders of partitions that have no rows left."""
    if not values:
        return
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)
    gone = spark.read.parquet(path).filter(_within(part_col, values)).select(folder.alias("f")).distinct()
    for r in gone.collect():  # one row a partition
        fs, p, _ = file_system(spark, r["f"])
        fs.delete(p, True)


def merge_into(path: str, changes: DataFrame, keys: Sequence[str], version: Sequence[str], part_col: str) -> list:
    """Apply ``changes`` to the table of ``create_keyed``; the newest version of a key wins.

    Returns the partitions that were read. A key whose newest version belongs to another
    partition moves there. Filters are widened before rows are written, and applying the
    same changes again changes nothing, so a run that stopped half-way is simply repeated.
    """
    spark = changes.sparkSession
    ensure_checkpoint_dir(spark)
    changes = _latest(changes, keys, version).checkpoint()
    touched = _touched(spark, path, changes, keys, part_col)
    current = spark.read.parquet(path).filter(_within(part_col, touched))
    rest = sorted(c for c in current.columns if c not in keys and c not in version)
    merged = upsert_latest(current, changes.select(*current.columns), keys, [*version, *rest], current_unique=True).checkpoint()
    both = merged.select(part_col, *[k for k in keys if k != part_col]).union(
        current.select(part_col, *[k for k in keys if k != part_col]))
    overwrite_partitions(key_filters(both, keys, part_col), path + FILTERS, [part_col])
    left = {r[0] for r in merged.select(part_col).distinct().collect()}
    overwrite_partitions(merged, path, [part_col])
    _drop_partitions(spark, path, part_col, [v for v in touched if v not in left])
    return touched


# ------------------------------------------------------------ checksums by partition

def partition_checksums(df: DataFrame, part_col: str) -> DataFrame:
    """(part, n_rows, row_hash): rows and the sum of row hashes of every partition."""
    total = F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)")).cast("decimal(38,0)")
    return df.groupBy(F.col(part_col).alias("part")).agg(F.count(F.lit(1)).alias("n_rows"), total.alias("row_hash"))


def _fold(leaves: DataFrame, group: Column) -> DataFrame:
    return leaves.groupBy(group.alias("_group")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("row_hash").cast("decimal(38,0)").alias("row_hash"))


def _differing(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, n_before, n_after) of keys whose rows or hashes differ, or that are on one side only."""
    a = before.select(F.col(key).alias("_k"), F.col("n_rows").alias("n_before"), F.col("row_hash").alias("_a"))
    b = after.select(key, F.col("n_rows").alias("n_after"), F.col("row_hash").alias("_b"))
    both = a.join(b, F.col("_k").eqNullSafe(F.col(key)), "full_outer")
    same = F.col("n_before").eqNullSafe(F.col("n_after")) & F.col("_a").eqNullSafe(F.col("_b"))
    fill = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return both.filter(~same).select(F.coalesce(F.col(key), F.col("_k")).alias(key), fill("n_before"), fill("n_after"))


def changed_partitions(before: DataFrame, after: DataFrame,
                       levels: Sequence[Callable[[Column], Column]] = ()) -> DataFrame:
    """(part, n_before, n_after) of the partitions whose checksums differ.

    ``levels`` map a partition to a group, from coarse to fine; each level is compared only
    below the groups that differ on the level above, the first being the whole table.
    """
    part = F.col("part")
    for level in (lambda c: F.lit("all"), *levels):
        wrong = _differing(_fold(before, level(part)), _fold(after, level(part)), "_group").select(
            F.col("_group").alias("_wrong"))
        before, after = (x.join(wrong, level(part).eqNullSafe(F.col("_wrong")), "left_semi") for x in (before, after))
    return _differing(before, after, "part")


def rebuild_changed(source: DataFrame, part_col: str, state: str, target: str,
                    build: Callable[[DataFrame], DataFrame], levels: Sequence[Callable[[Column], Column]] = ()) -> list:
    """Rebuild the partitions of a mart whose source rows changed since the last run; returns them.

    ``build(rows)`` turns source rows into mart rows that keep ``part_col``. The checksums are
    published to ``state`` last, so a run that failed is repeated.
    """
    spark = source.sparkSession
    ensure_checkpoint_dir(spark)
    after = partition_checksums(source, part_col).checkpoint()
    before = read_published(spark, state) if current_version(spark, state) else after.limit(0)
    # a list of partitions, as any writer of the table holds it
    parts = [r[0] for r in changed_partitions(before, after, levels).select("part").collect()]
    if parts:
        mart = build(source.filter(_within(part_col, parts))).checkpoint()
        left = {r[0] for r in mart.select(part_col).distinct().collect()}
        overwrite_partitions(mart, target, [part_col])
        try:
            _drop_partitions(spark, target, part_col, [p for p in parts if p not in left])
        except AnalysisException:  # every partition of a new mart is empty
            pass
        publish(after, state)
    return parts
