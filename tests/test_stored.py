"""Mergeable profiles, layouts over several columns, concurrent models, folded logs."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from stratum.plans import audit, layers, models, profiles


def test_profiles_merge_and_read_only_the_new_partition(spark, tmp_dir):
    rows = spark.range(40_000).select(
        (F.col("id") % 3).alias("day"), "id", (F.col("id") % 700).cast("string").alias("name"),
        F.when(F.col("id") % 5 != 0, F.col("id") / 7).alias("ratio"), F.lit(None).cast("date").alias("none"))
    path = os.path.join(tmp_dir, "profile")
    profiles.refresh_profile(rows.filter("day < 2"), path, ["day"])
    kept = set(spark.read.parquet(path).inputFiles())
    profiles.refresh_profile(rows.filter("day = 2"), path, ["day"])
    assert kept <= set(spark.read.parquet(path).inputFiles())
    got = {r["column_name"]: r for r in profiles.read_profile(spark, path).collect()}
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in ("id", "name", "ratio", "none")]).first()
    for c in ("id", "name", "ratio", "none"):
        assert abs(got[c]["n_distinct"] - exact[c]) <= 0.05 * exact[c] and got[c]["n_rows"] == 40_000
    assert got["ratio"]["n_null"] == 8_000 and got["none"]["n_null"] == 40_000 and got["id"]["n_null"] == 0
    profiles.refresh_profile(rows.filter("day = 2"), path, ["day"])  # again: no row counts twice
    assert profiles.read_profile(spark, path).filter("column_name = 'id'").first()["n_rows"] == 40_000


def files_that_may_match(spark, path, column, low, high):
    """Files whose smallest and largest value let a range filter through."""
    stats = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return stats.filter((F.col("a") <= high) & (F.col("b") >= low)).count()


def test_interleaved_layout_skips_files_on_either_column(spark, tmp_dir):
    rows = spark.range(20_000).select(
        (F.xxhash64("id") % 1000).alias("x"), F.timestamp_seconds(F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1000))).alias("t"))
    both, one = os.path.join(tmp_dir, "both"), os.path.join(tmp_dir, "one")
    layers.write_interleaved(rows, both, ["x", "t"], num_files=16)
    layers.write_clustered(rows, one, "x", num_files=16)
    assert sorted(map(tuple, spark.read.parquet(both).collect())) == sorted(map(tuple, rows.collect()))
    low, high = F.timestamp_seconds(F.lit(400)), F.timestamp_seconds(F.lit(420))
    assert files_that_may_match(spark, one, "t", low, high) == 16
    assert files_that_may_match(spark, both, "t", low, high) <= 8
    assert files_that_may_match(spark, both, "x", F.lit(100), F.lit(120)) <= 8
    with pytest.raises(ValueError):
        layers.write_interleaved(rows.select(F.col("x").cast("string").alias("s")), both, ["s"])
    nulls = spark.range(3).select(F.lit(None).cast("long").alias("x"), "id")
    layers.write_interleaved(nulls, os.path.join(tmp_dir, "nulls"), ["x", "id"])
    assert spark.read.parquet(os.path.join(tmp_dir, "nulls")).count() == 3


def test_independent_models_run_at_once_and_failures_stop_descendants(spark, tmp_dir):
    project, met = models.Project(spark, tmp_dir), threading.Barrier(2, timeout=60)
    project.source("raw", lambda: spark.range(10))

    def side(raw):
        met.wait()  # passes only while both sides are being built
        return raw.withColumn("k", F.col("id") % 2)
    project.model("left_side", ["raw"], materialize="table")(side)
    project.model("right_side", ["raw"], materialize="table")(side)
    project.model("joined", ["left_side", "right_side"])(lambda left_side, right_side: left_side.join(right_side, "id"))
    assert project.run(threads=4)["joined"].count() == 10

    broken = models.Project(spark, tmp_dir)
    broken.source("raw", lambda: spark.range(10))
    broken.model("bad", ["raw"])(lambda raw: raw.select("nothing"))
    broken.model("child", ["bad"])(lambda bad: bad)
    broken.model("grandchild", ["child", "raw"])(lambda child, raw: child)
    broken.model("good", ["raw"])(lambda raw: raw)
    with pytest.raises(models.ModelFailures) as error:
        broken.run(threads=2)
    assert set(error.value.failed) == {"bad"} and error.value.skipped == ["child", "grandchild"]
    assert broken.frames["good"].count() == 10


def test_folded_log_shows_the_same_history(spark, tmp_dir):
    log = audit.AuditLog(spark, os.path.join(tmp_dir, "audit"))
    assert log.history().count() == 0
    for k in range(4):
        with log.run(f"p{k}") as ctx:
            ctx.rows_loaded = k
    day = dt.date(2024, 5, 1)
    log.record_success("daily", 7, day)
    verdicts = spark.createDataFrame([("t", "c", True, None)], "table_name string, check_name string, passed boolean, details string")
    log.log_checks(verdicts)

    def seen():
        return sorted(map(tuple, log.runs().collect()), key=str), sorted(map(tuple, log.checks(50).collect()), key=str)
    before, loose = seen(), len(log._loose(log.runs_path))
    log.compact()
    assert seen() == before and len(log._loose(log.runs_path)) == loose  # kept for readers that began earlier
    log.start("late")
    assert len(log.runs().collect()) == len(before[0]) + 1
    log.compact()
    assert len(log._loose(log.runs_path)) == 1 and len(log.runs().collect()) == len(before[0]) + 1
    assert seen()[1] == before[1] and log.succeeded("daily", day) and not log.succeeded("daily", dt.date(2024, 5, 2))
    assert not log.succeeded("p0", day)
