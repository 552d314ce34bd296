"""Rejected CSV lines, previews and repeatable samples."""

import hashlib
import os

from pyspark.sql import functions as F

from stratum.operators import quality as Q
from stratum.operators import sampling as P
from stratum.sources.rejects import split_csv

LINES = """id,name,b,day
1,ann,5,2024-01-05
2,"last, first",6,2024-01-06
3,y,zz,2024-01-07
4,short
5,x,7,2024-01-08,more
6,"quoted ""q"", two",8,no day
7,,,
8,"a,b",zz,nope
"""


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_every_line_is_a_row_or_a_reject(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write(src, "a.csv", LINES)
    write(src, "b.csv", "id,name,b,day\n9,z,1,2024-02-01\nx9,z,1,2024-02-01\n")
    both = split_csv(spark, src, "id int, name string, b int, day date", os.path.join(tmp_dir, "staging"))
    good = sorted((r["id"], r["name"], r["b"], str(r["day"])) for r in both.accepted.collect())
    assert good == [(1, "ann", 5, "2024-01-05"), (2, "last, first", 6, "2024-01-06"), (7, None, None, "None"),
                    (9, "z", 1, "2024-02-01")]
    bad = {r["_raw"]: (r["_file"], r["_reason"]) for r in both.rejected.collect()}
    assert bad == {
        "3,y,zz,2024-01-07": ("a.csv", "b is no int"),
        "4,short": ("a.csv", "short: 2 of 4 fields"),
        "5,x,7,2024-01-08,more": ("a.csv", "long: 5 of 4 fields"),
        '6,"quoted ""q"", two",8,no day': ("a.csv", "day is no date"),
        '8,"a,b",zz,nope': ("a.csv", "b is no int, day is no date"),
        "x9,z,1,2024-02-01": ("b.csv", "id is no int")}
    ratio = both.ratio()
    assert ratio.first()[:2] == (4, 6)
    verdict = Q.verdicts(ratio, [Q.Check("few_rejects", "reject_ratio <= 0.1", "reject_ratio")], "in")
    assert [r["passed"] for r in verdict.collect()] == [False]


def test_columns_left_out_are_still_checked_and_order_is_by_name(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write(src, "a.csv", "b,more,a\n1,x,2\n1,x\n,,3\n")
    both = split_csv(spark, src, "a int, b int", os.path.join(tmp_dir, "staging"))
    assert sorted(map(tuple, both.accepted.collect()), key=str) == [(2, 1), (3, None)]
    assert [r["_reason"] for r in both.rejected.select("_reason").collect()] == ["short: 2 of 3 fields"]
    # one side alone may be read without a column of the other
    assert both.accepted.select("a").count() == 2 and both.rejected.count() == 1
    write(os.path.join(tmp_dir, "none"), "a.csv", "a,b\n")
    empty = split_csv(spark, os.path.join(tmp_dir, "none"), "a int, b int", os.path.join(tmp_dir, "staging2"))
    assert empty.accepted.count() == 0 and tuple(empty.ratio().first()) == (0, 0, None)


def test_sample_does_not_depend_on_partitions(spark):
    rows = [(i, "hot" if i % 10 else None) for i in range(3000)]
    draw = lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest()
    frame = spark.createDataFrame(rows, "id long, s string")
    want = {i for i, _ in sorted(rows, key=lambda r: draw(r[0]))[:25]}
    strata = {s: {i for i, _ in sorted((r for r in rows if r[1] == s), key=lambda r: draw(r[0]))[:25]}
              for s in ("hot", None)}
    for parts in (1, 7):
        df = frame.repartition(parts)
        assert {r["id"] for r in P.sample_rows(df, 25, ["id"], 3).collect()} == want
        got = P.sample_rows(df, 25, ["id"], 3, ["s"]).collect()
        assert {s: {r["id"] for r in got if r["s"] == s} for s in strata} == strata
    assert P.sample_rows(frame, 5000, ["id"]).count() == 3000
    doubled = frame.union(frame)
    assert P.sample_rows(doubled, 4, ["id"], 3).groupBy("id").agg(F.count("*").alias("n")).filter("n = 2").count() == 2
    plan = P.sample_rows(frame, 25, ["id"], 3, ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_preview(spark):
    frame = spark.range(100).repartition(3)
    assert P.preview(frame, 7).count() == 7
    assert [r["id"] for r in P.preview(frame, 3, [F.col("id").desc()]).collect()] == [99, 98, 97]
