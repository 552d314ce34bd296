"""Exact quantiles by narrowing, against sorted lists."""

import math
import random

import numpy as np
import pytest

from stratum.operators import quantiles as N

SCHEMA = "k string, x double"


def expected(values, q):
    values = sorted(values, key=lambda v: (math.isnan(v), v))
    at = q * (len(values) - 1)
    low, share = math.floor(at), at - math.floor(at)
    if share == 0:
        return values[low]
    return values[low] * (1 - share) + values[low + 1] * share


def check(spark, rows, q, few):
    groups = {}
    for k, x in rows:
        if x is not None:
            groups.setdefault(k, []).append(x)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r["k"]: r["m"] for r in N.group_quantile(frame, ["k"], "x", q, "m", few=few).collect()}
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        assert got[k] == expected(values, q) or (math.isnan(got[k]) and math.isnan(expected(values, q))), (k, q)


@pytest.mark.parametrize("q", [0.0, 0.37, 0.5, 1.0])
def test_quantiles_per_key(spark, q):
    rnd = random.Random(int(100 * q))
    rows = [("hot", rnd.lognormvariate(0, 60)) for _ in range(4000)]         # spans many powers of ten
    rows += [("ties", float(rnd.choice([1, 1, 1, 2]))) for _ in range(900)]
    rows += [(None, float(rnd.randrange(50))) for _ in range(301)]
    rows += [("one", -7.5), ("two", 1.0), ("two", 2.0), ("none", None), ("hot", None)]
    rows += [("odd", v) for v in (math.inf, -math.inf, math.nan, 0.0, -1e308, 1e308, 5e-324)]
    check(spark, rows, q, few=20)


def test_tight_values_and_every_size_alike(spark):
    # neighbouring doubles, which an even division of the value range could not part
    rows = [("a", float(v)) for v in 1e300 * (1 + np.arange(500) * 2.0 ** -52)] + [("b", 3.0)] * 500
    for few in (1, 50, 100_000):
        check(spark, rows, 0.5, few)


def test_whole_table_and_empty(spark):
    frame = spark.createDataFrame([(None, float(v)) for v in range(1000)], SCHEMA)
    assert N.quantile(frame, "x", 0.5, few=10).first()[0] == 499.5
    assert N.quantile(frame.limit(0), "x").first()[0] is None
    assert N.quantile(frame.filter("x is null"), "x").first()[0] is None
    assert N.group_quantile(frame.limit(0), ["k"], "x").count() == 0
    with pytest.raises(ValueError):
        N.quantile(frame, "x", 1.5)
