"""Incremental upserts of a file stream: each file counts once, whatever stops or repeats."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.windows import keep_latest
from stratum.streaming import ingest as G

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("v", T.LongType())])
FILES = {
    "a.csv": [(1, "2024-01-01 10:00:00", 1), (2, "2024-01-02 10:00:00", 2), (3, "2024-01-03 10:00:00", 3)],
    "b.csv": [(4, "2024-01-01 09:00:00", 4), (2, "2024-01-04 10:00:00", 20)],        # late row; key moves to another day
    "c.csv": [(2, "2024-01-03 10:00:00", 99), (5, "2024-01-05 10:00:00", 5), (5, "2024-01-05 10:00:00", 5)],  # outdated
}


def put(folder, *names):
    os.makedirs(folder, exist_ok=True)
    for i, n in enumerate(names):
        p = os.path.join(folder, n)
        with open(p, "w") as f:
            f.write("id,ts,v\n" + "".join(f"{a},{b},{c}\n" for a, b, c in FILES[n]))
        os.utime(p, (1_700_000_000 + ord(n[0]), 1_700_000_000 + ord(n[0])))


def run(spark, d):
    return G.upsert_available(spark, f"{d}/in", SCHEMA, f"{d}/t", f"{d}/ckpt", ["id"], ["ts"], "day",
                              prepare=lambda s: s.withColumn("day", F.date_format("ts", "yyyy-MM-dd")),
                              max_files_per_trigger=1)


def stored(spark, d):
    return sorted((r["id"], str(r["ts"]), r["v"], str(r["day"])) for r in spark.read.parquet(f"{d}/t").collect())


def batch_result(spark, names):
    rows = spark.createDataFrame([r for n in names for r in FILES[n]], "id long, ts string, v long").distinct()
    rows = keep_latest(rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")), ["id"], ["ts"])
    return sorted((r["id"], str(r["ts"]), r["v"], str(r["ts"])[:10]) for r in rows.collect())


def test_stream_equals_batch_and_touches_only_its_days(spark, tmp_dir):
    put(f"{tmp_dir}/in", "a.csv")
    assert run(spark, tmp_dir) == [0]
    day3 = sorted(os.listdir(f"{tmp_dir}/t/day=2024-01-03"))
    put(f"{tmp_dir}/in", "b.csv")
    assert run(spark, tmp_dir) == [1] and run(spark, tmp_dir) == []
    assert sorted(os.listdir(f"{tmp_dir}/t/day=2024-01-03")) == day3
    assert not os.path.exists(f"{tmp_dir}/t/day=2024-01-02")  # its only key has moved
    put(f"{tmp_dir}/in", "c.csv")
    assert run(spark, tmp_dir) == [2]
    assert stored(spark, tmp_dir) == batch_result(spark, FILES)


def test_a_batch_that_stops_or_repeats_changes_nothing(spark, tmp_dir, monkeypatch):
    put(f"{tmp_dir}/in", *FILES)
    real, calls = G.create_if_absent, []

    def stop(s, path):
        calls.append(path)
        if len(calls) == 2:  # the second batch is merged, but not yet in the ledger
            raise RuntimeError("stopped")
        return real(s, path)

    monkeypatch.setattr(G, "create_if_absent", stop)
    with pytest.raises(Exception, match="stopped"):
        run(spark, tmp_dir)
    assert run(spark, tmp_dir) == [1, 2]
    want = batch_result(spark, FILES)
    assert stored(spark, tmp_dir) == want
    again = spark.read.schema(SCHEMA).option("header", True).csv(f"{tmp_dir}/in/b.csv").withColumn(
        "day", F.date_format("ts", "yyyy-MM-dd"))
    ledger = f"{tmp_dir}/ckpt/{G.LEDGER}"
    assert G.apply_batch(again, 1, ledger, f"{tmp_dir}/t", ["id"], ["ts"], "day") is False
    assert G.apply_batch(again, 7, ledger, f"{tmp_dir}/t", ["id"], ["ts"], "day") is True
    assert stored(spark, tmp_dir) == want
