"""Tree walks by doubling against the level-by-level walk."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from stratum.operators import hierarchy as H


def rows_of(df):
    return sorted((r["id"], r["depth"], r["path"]) for r in df.collect())


@pytest.mark.parametrize("seed", [1])
def test_doubling_equals_the_walk_by_level(spark, seed):
    rnd, rows = random.Random(seed), []
    for i in range(40):
        rows.append((i, None if i < 3 or rnd.random() < 0.02 else rnd.randint(max(0, i - 15), i - 1), "x"))
    rows += [(1000, 999, "lost"), (1001, 1000, "below a lost one"), (1002, None, "a root alone")]
    df = spark.createDataFrame(rows, "id long, parent long, depth_ string")
    got, want = (f(df, node="id", parent="parent", label="id", separator="/") for f in (H.walk_paths, H.walk_tree))
    assert got.columns == want.columns and rows_of(got) == rows_of(want) and max(r[1] for r in rows_of(got)) > 3


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds, plain = [], DataFrame.checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda *a: rounds.append(1) or plain(*a))
    chain = spark.range(1_000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    got = H.walk_paths(chain, node="id", parent="parent")
    assert got.filter("depth <> id").count() == 0 and got.count() == 1_000 and len(rounds) <= 11


def test_a_circle_is_named(spark):
    rows = [(1, None), (2, 1), (10, 12), (11, 10), (12, 11), (13, 12), (14, 13)]
    with pytest.raises(RecursionError, match="10, 11, 12$"):
        H.walk_paths(spark.createDataFrame(rows, "id long, parent long"), node="id", parent="parent")


def test_empty_and_repeated_nodes(spark):
    schema = "id long, parent long"
    assert H.walk_paths(spark.createDataFrame([], schema), node="id", parent="parent", label="id").count() == 0
    twice = spark.createDataFrame([(1, None), (2, 1), (2, 1), (3, 2)], schema)
    got, want = (f(twice, node="id", parent="parent", label="id") for f in (H.walk_paths, H.walk_tree))
    assert rows_of(got) == rows_of(want)
