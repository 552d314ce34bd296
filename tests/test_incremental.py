"""Stored merges of touched partitions and partition checksums."""

import os

import pytest
from pyspark.sql import functions as F

from stratum.operators.windows import keep_latest
from stratum.plans import incremental as I

COLS = "id long, day string, v int, ver int"


def files_of(path):
    return {p: sorted(f for f in os.listdir(os.path.join(path, p)) if f.endswith(".parquet"))
            for p in os.listdir(path) if p.startswith("day=")}


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in ("id", "day", "v", "ver")) for r in df.collect())))


@pytest.fixture()
def stored(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = spark.range(4000).select("id", F.concat(F.lit("d"), F.col("id") % 20).alias("day"),
                                    F.lit(1).alias("v"), F.lit(1).alias("ver"))
    # a key twice in the input, and a partition of NULL
    rows = rows.union(spark.createDataFrame([(5, "d5", 2, 2), (9001, None, 1, 1)], COLS))
    I.create_keyed(rows, path, ["id"], ["ver"], "day")
    return path, keep_latest(rows, ["id"], ["ver"])


def test_merge_rewrites_touched_partitions_only(spark, stored):
    path, before = stored
    changes = spark.createDataFrame([(3, "d3", 7, 2),          # updated in place
                                     (4, "d17", 7, 2),         # moves from d4 to d17
                                     (5, "d5", 7, 1),          # older than what is stored
                                     (9001, "d17", 8, 2),      # leaves the NULL partition, which is then empty
                                     (7777, "new", 7, 1), (7777, "new", 8, 2)], COLS)
    files = files_of(path)
    touched = I.merge_into(path, changes, ["id"], ["ver"], "day")
    want = rows_of(keep_latest(before.unionByName(changes), ["id"], ["ver"]))
    assert rows_of(spark.read.parquet(path)) == want
    assert {"d3", "d4", "d17", "d5", "new", None} <= set(touched) and len(touched) < 12
    after = files_of(path)
    assert "day=__HIVE_DEFAULT_PARTITION__" not in after and "day=new" in after
    for p, names in files.items():
        if p[4:] not in touched and p != "day=__HIVE_DEFAULT_PARTITION__":
            assert after[p] == names
    # the same changes again, as after a stopped run
    I.merge_into(path, changes, ["id"], ["ver"], "day")
    assert rows_of(spark.read.parquet(path)) == want
    # the moved key is found where it went, although the change names its old day
    touched = I.merge_into(path, spark.createDataFrame([(4, "d4", 9, 3)], COLS), ["id"], ["ver"], "day")
    assert {"d17", "d4"} <= set(touched)
    assert spark.read.parquet(path).filter("id = 4").collect()[0]["v"] == 9


def test_filters_never_miss_and_follow_the_size_of_a_partition(spark, stored, tmp_dir):
    path, before = stored
    for low in (0, 1000, 3990):
        some = before.filter((F.col("id") >= low) & (F.col("id") < low + 7))
        days = {r["day"] for r in some.collect()}
        assert days <= set(I._touched(spark, path, some.withColumn("day", F.lit("d0")), ["id"], "day"))
    big = os.path.join(tmp_dir, "big")
    rows = spark.range(30_000).select("id", F.when(F.col("id") < 20_000, "a").otherwise("b").alias("day"),
                                      F.lit(1).alias("v"), F.lit(1).alias("ver"))
    I.create_keyed(rows, big, ["id"], ["ver"], "day")
    sizes = {r["day"]: r[I.WORDS] for r in spark.read.parquet(big + I.FILTERS).select("day", I.WORDS).distinct().collect()}
    assert sizes == {"a": 8192, "b": 4096}
    missing = spark.range(100_000, 100_500).select("id", F.lit("a").alias("day"), F.lit(1).alias("v"), F.lit(1).alias("ver"))
    hits = sum("b" in I._touched(spark, big, missing.filter(F.col("id") == 100_000 + k), ["id"], "day") for k in range(10))
    assert hits <= 3


def test_an_empty_change_set_changes_nothing(spark, stored):
    path, before = stored
    files = files_of(path)
    assert I.merge_into(path, spark.createDataFrame([], COLS), ["id"], ["ver"], "day") == []
    assert files_of(path) == files


def test_one_updated_row_rebuilds_one_partition(spark, tmp_dir):
    state, target = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "mart")
    source = spark.range(300).select("id", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string"), F.lit("-"),
                                                    F.lpad((F.col("id") % 7).cast("string"), 2, "0")).alias("day"),
                                     (F.col("id") % 5).alias("v"))
    built = []

    def build(rows):
        built.append(sorted(r["day"] for r in rows.select("day").distinct().collect()))
        return rows.groupBy("day").agg(F.sum("v").alias("total"))
    run = lambda df: I.rebuild_changed(df, "day", state, target, build, [lambda c: F.substring(c, 1, 7)])
    mart = lambda: {r["day"]: r["total"] for r in spark.read.parquet(target).collect()}
    plain = lambda df: {r["day"]: r["total"] for r in df.groupBy("day").agg(F.sum("v").alias("total")).collect()}
    assert len(run(source)) == 21 and mart() == plain(source)
    files = files_of(target)
    assert run(source) == [] and len(built) == 1
    changed = source.withColumn("v", F.when(F.col("id") == 10, 99).otherwise(F.col("v")))
    assert run(changed) == built[-1] == ["2024-02-03"] and mart() == plain(changed)
    kept = {p: f for p, f in files_of(target).items() if p != "day=2024-02-03"}
    assert kept.items() <= files.items()
    # a partition that is gone from the source goes from the mart
    smaller = changed.filter("day <> '2024-01-00'")
    assert run(smaller) == ["2024-01-00"] and mart() == plain(smaller)


def test_checksums_see_swapped_values_and_null_partitions(spark):
    a = spark.createDataFrame([("x", 1, 2), ("x", 2, 1), (None, 1, 1)], "p string, a int, b int")
    b = spark.createDataFrame([("x", 2, 2), ("x", 1, 1), (None, 1, 1)], "p string, a int, b int")
    c = spark.createDataFrame([("x", 2, 1), ("x", 1, 2)], "p string, a int, b int")
    diff = lambda x, y: sorted((r["part"] or "", r["n_before"], r["n_after"]) for r in I.changed_partitions(
        I.partition_checksums(x, "p"), I.partition_checksums(y, "p")).collect())
    assert diff(a, b) == [("x", 2, 2)] and diff(a, c) == [("", 1, 0)] and diff(a, a) == []
