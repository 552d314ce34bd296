"""Unit tests: sources, layers, audit, streaming, hierarchy, plans."""

import datetime as dt
import os
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stratum.operators import aggregates as A
from stratum.operators import hierarchy as H
from stratum.operators import quality as Q
from stratum.operators import windows as W
from stratum.operators.joins import fits, sized_broadcast
from stratum.plans import audit, layers, report, versions
from stratum.sources import files
from stratum.streaming.ingest import ingest_available
from tests.conftest import SF_SMALL

# FIXTURES.md A1: employee tree and its expected walk.
EMPLOYEES = [(1, "Alice", "CTO", None), (2, "Bob", "Data Lead", 1), (3, "Carol", "Data Engineer", 2),
             (4, "Dave", "Data Engineer", 2), (5, "Eve", "Analytics Lead", 1),
             (6, "Frank", "Data Analyst", 5), (7, "Grace", "Data Analyst", 5)]
EXPECTED_WALK = [("Alice", 0), ("Alice → Bob", 1), ("Alice → Bob → Carol", 2),
                 ("Alice → Bob → Dave", 2), ("Alice → Eve", 1), ("Alice → Eve → Frank", 2),
                 ("Alice → Eve → Grace", 2)]

LOG = """2024-03-01 09:00:00 INFO  job started
2024-03-01 09:00:01 INFO  reading input
2024-03-01 09:00:02 WARNING input has 12% nulls
2024-03-01 09:00:03 ERROR write failed on attempt 1
2024-03-01 09:00:04 INFO  retry ok
2024-03-01 09:00:05 INFO  job finished
garbage line without a timestamp
2024-03-01 09:10:00 ERROR connection refused
"""


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    total = files.read_table(spark, SF_SMALL, "orders").count()
    assert sum(r["total_orders"] for r in rows) == total


def test_registry_and_profile(spark):
    names = files.register_tables(spark, SF_SMALL, ["region", "nation"])
    assert names == ["region", "nation"]
    assert spark.sql("SELECT count(*) FROM nation").collect()[0][0] == 25
    prof = A.null_profile(spark.table("nation"), keep_zero=True).collect()
    assert {r["column_name"]: r["n_null"] for r in prof} == {
        "n_nationkey": 0, "n_name": 0, "n_regionkey": 0}


def test_literal_rows_sum(spark):
    # FIXTURES.md A3
    cities = spark.createDataFrame([("Sydney", 5_300_000, "AU"), ("Melbourne", 5_100_000, "AU"),
                                    ("Brisbane", 2_600_000, "AU")],
                                   "city string, population long, country string")
    assert cities.agg(F.sum("population")).collect()[0][0] == 13_000_000


def test_walk_tree_matches_expected_and_sql(spark):
    emp = spark.createDataFrame(EMPLOYEES, "id int, name string, role string, manager_id int")
    walk = H.walk_tree(emp, node="id", parent="manager_id", label="name")
    got = sorted((r["path"], r["depth"]) for r in walk.collect())
    assert got == EXPECTED_WALK
    emp.createOrReplaceTempView("employees")
    sql = H.walk_tree_sql(spark, "employees", "id", "manager_id", "name")
    assert sorted((r["path"], r["depth"]) for r in sql.collect()) == EXPECTED_WALK


def test_walk_tree_stops_on_cycles(spark):
    cyc = spark.createDataFrame([(1, None), (2, 1), (3, 2), (2, 3)], "id int, parent int")
    walk = H.walk_tree(cyc, node="id", parent="parent", label="id", max_depth=5, on_limit="stop")
    assert walk.agg(F.max("depth")).collect()[0][0] == 5
    with pytest.raises(RecursionError):
        H.walk_tree(cyc, node="id", parent="parent", label="id", max_depth=5)
    chain = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "id int, parent int")
    assert H.walk_tree(chain, node="id", parent="parent", label="id", max_depth=2).count() == 3


def test_log_parsing_and_filters(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pipeline.log")
    with open(path, "w") as f:
        f.write(LOG)
    logs = files.read_log(spark, path)
    counts = {r["level"]: r["n_lines"] for r in audit.level_counts(logs).collect()}
    assert counts == {"INFO": 4, "WARNING": 1, "ERROR": 2}
    assert files.log_filter(logs, "error|warning", ignore_case=True).count() == 3
    assert files.log_filter(logs, "ERROR", invert=True).count() == 6  # the unparsed line is a line too
    errs = audit.error_summary(logs).collect()
    assert [r["ts"] for r in errs] == [dt.datetime(2024, 3, 1, 9, 0, 3), dt.datetime(2024, 3, 1, 9, 10)]


def test_partitioned_round_trip_keeps_null_and_prunes(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, None), (4, 2021)], "id int, year int")
    path = os.path.join(tmp_dir, "silver")
    layers.write_partitioned(df, path, ["year"], salt_buckets=2)
    back = spark.read.parquet(path)
    assert sorted((r["id"], r["year"]) for r in back.collect()) == [
        (1, 2020), (2, 2021), (3, None), (4, 2021)]  # S22
    pruned = back.filter(F.col("year") == 2021)
    assert "PartitionFilters: [isnotnull(year" in report.plan_text(pruned)  # S-5
    assert pruned.count() == 2
    one = spark.read.parquet(os.path.join(path, "year=2021"))
    assert "year" not in one.columns  # S23: reading one folder loses the column
    based = spark.read.option("basePath", path).parquet(os.path.join(path, "year=2021"))
    assert "year" in based.columns


def test_dynamic_overwrite_and_affected_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "daily")
    base = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)],
                                 "d string, v int")
    layers.overwrite_partitions(base, path, ["d"])
    late = spark.createDataFrame([("2024-01-03", 30)], "d string, v int")
    layers.overwrite_partitions(late, path, ["d"])
    got = sorted((str(r["d"]), r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 30)]
    ev = spark.createDataFrame(
        [(dt.datetime(2024, 1, d, 12), d) for d in range(1, 11)], "ts timestamp_ntz, v int"
    ).withColumn("day", F.to_date("ts"))
    hit = layers.affected_partitions(ev, "ts", "day", "3 days")
    assert sorted(r["v"] for r in hit.collect()) == [7, 8, 9, 10]
    # on a day-partitioned table the touched days become partition filters
    daily = os.path.join(tmp_dir, "events_by_day")
    layers.write_partitioned(ev, daily, ["day"])
    pruned = layers.affected_partitions(spark.read.parquet(daily), "ts", "day", "3 days")
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-07", report.plan_text(pruned))
    assert "GreaterThanOrEqual(ts," in report.plan_text(pruned)
    assert sorted(r["v"] for r in pruned.collect()) == [7, 8, 9, 10]


def test_publish_is_all_or_nothing(spark, tmp_dir):
    target = os.path.join(tmp_dir, "gold")
    first = spark.range(5).withColumnRenamed("id", "k")
    assert layers.publish(first, target) == 5

    def reject(df, rows):
        raise ValueError("validation failed")
    with pytest.raises(ValueError):
        layers.publish(spark.range(100).withColumnRenamed("id", "k"), target, validate=reject)
    assert layers.read_published(spark, target).count() == 5  # prior state survives
    assert layers.publish(spark.range(7).withColumnRenamed("id", "k"), target) == 7
    assert layers.read_published(spark, target).count() == 7
    rep = layers.layer_report(spark, {"gold": target}).collect()[0]
    assert rep["n_rows"] == 7 and rep["n_files"] >= 1 and rep["bytes"] > 0


def test_a_stopped_publish_leaves_one_complete_version(spark, tmp_dir, monkeypatch):
    target = os.path.join(tmp_dir, "gold")
    count = lambda: versions.read_published(spark, target).count()
    layers.publish(spark.range(5), target)

    class Stopped(BaseException):
        pass

    def stop(*a, **k):
        raise Stopped
    for step, rows in (("_point", 5), ("create_if_absent", 5), ("_clean", 9)):
        with monkeypatch.context() as m:
            m.setattr(versions, step, stop)
            with pytest.raises(Stopped):
                layers.publish(spark.range(9), target)
        assert count() == rows
    # stopped between the pointer's creation and its filling: passed over
    assert versions.create_if_absent(spark, versions._pointer(target, 3)) and count() == 9
    with pytest.raises(versions.StaleVersion):
        layers.publish(spark.range(6), target, expect=2)
    with monkeypatch.context() as m:
        m.setattr(versions, "LEASE_S", 0)
        assert layers.publish(spark.range(6), target, expect=2) == 6 and count() == 6
    with pytest.raises(ValueError):
        layers.publish(spark.range(3), target, validate=_reject)
    assert count() == 6
    assert layers.publish(versions.read_published(spark, target).limit(2), target) == 2 and count() == 2
    assert len(os.listdir(os.path.join(target, versions.POINTERS))) <= 4  # with check sums


def test_two_writers_never_mix_and_readers_see_whole_versions(spark, tmp_dir):
    target, seen, errors = os.path.join(tmp_dir, "gold"), [], []
    layers.publish(spark.range(1), target)

    def write(n):
        try:
            for _ in range(3):
                layers.publish(spark.range(n), target, keep=50)
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    writers = [threading.Thread(target=write, args=(n,)) for n in (100, 2000)]
    for w in writers:
        w.start()
    while any(w.is_alive() for w in writers):
        seen.append(versions.read_published(spark, target).count())
    assert not errors and set(seen) <= {1, 100, 2000}
    assert versions.current_version(spark, target)[0] == 7  # no number was used twice


def test_a_writer_on_an_old_version_is_told_so(spark, tmp_dir):
    target = os.path.join(tmp_dir, "gold")
    layers.publish(spark.range(1), target, expect=0)
    number, _ = versions.current_version(spark, target)

    def overtaken(df, rows):
        layers.publish(spark.range(50), target)
    with pytest.raises(versions.StaleVersion):
        layers.publish(spark.range(2), target, expect=number, validate=overtaken)
    assert versions.read_published(spark, target).count() == 50
    with pytest.raises(versions.StaleVersion):
        layers.publish(spark.range(2), target, expect=number)
    assert layers.publish(spark.range(2), target, expect=versions.current_version(spark, target)[0]) == 2


def test_append_reads_back_what_it_added(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    assert layers.write_checked(spark.range(5), path, "append") == 5
    assert layers.write_checked(spark.range(7), path, "append") == 7
    assert spark.read.parquet(path).count() == 12
    lost = spark.range(9)
    files = layers._files
    try:  # a file that vanishes between write and read-back is noticed
        layers._files = lambda s, p: files(s, p)[:1]
        with pytest.raises(RuntimeError, match="read back"):
            layers.write_checked(lost, path, "append")
    finally:
        layers._files = files


def _reject(df, rows):
    raise ValueError("validation failed")


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_dir):
    df = spark.range(400_000).select(F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("p"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        layers.publish(df, os.path.join(tmp_dir, "t"), ["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert len([f for f in os.listdir(os.path.join(layers.published_path(spark, os.path.join(tmp_dir, "t")), "p=0")) if f.endswith(".parquet")]) > 1


def test_upsert_touches_only_named_keys(spark):
    cols = "k long, v int, ver int"
    current = spark.createDataFrame([(1, 10, 1), (2, 20, 5), (3, 30, 1), (None, 40, 1)], cols)
    changes = spark.createDataFrame([(1, 11, 2), (1, 12, 3), (2, 21, 4), (4, 44, 1), (None, 41, 2)], cols)
    slim, plain = [sorted(map(str, layers.upsert_latest(current, changes, ["k"], ["ver"], u).collect()))
                   for u in (True, False)]
    assert slim == plain and len(slim) == 5
    tie = spark.createDataFrame([(1, v, 9) for v in (5, 7, 6)], cols)
    assert layers.upsert_latest(current, tie.repartition(3), ["k"], ["ver"]).filter("k = 1").first()["v"] == 7


def test_writer_enforces_not_null_and_defaults(spark):
    rows = spark.createDataFrame([("a", None), ("b", 2)], "id string, n int")
    assert [r["n"] for r in layers.enforced(rows, ["id", "n"], {"n": 7}).orderBy("id").collect()] == [7, 2]
    with pytest.raises(Exception, match="NULL in column n"):
        layers.enforced(rows, ["n"]).collect()
    with pytest.raises(ValueError):
        layers.enforced(rows, ["missing"])


def test_rebuild_only_when_the_source_changed(spark, tmp_dir):
    state, built = os.path.join(tmp_dir, "state"), []
    src = spark.createDataFrame([(1, 5, dt.datetime(2024, 1, 1))], "k long, v int, ts timestamp_ntz")
    run = lambda df: layers.rebuild_if_changed(df, "k", "ts", state, lambda: built.append(1))
    assert [run(src), run(src), run(src.withColumn("v", F.lit(6))), len(built)] == [True, False, True, 2]


def test_newest_files_by_name(spark, tmp_dir):
    for day in ("02", "10", "01"):
        with open(os.path.join(tmp_dir, f"run_202401{day}.log"), "w") as f:
            f.write("x")
    got = files.newest_files(spark, tmp_dir, 2)
    assert [os.path.basename(p) for p in got] == ["run_20240110.log", "run_20240102.log"]


def test_look_back_window_off_utc(spark):
    from stratum.plans import catalogue
    from tests.oracle_check import compare, duck
    before = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        assert not compare(catalogue.QUERIES["late_window"](spark, SF_SMALL), duck(SF_SMALL),
                           catalogue.ORACLE["late_window"])
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()


def test_audit_trail(spark, tmp_dir):
    log = audit.AuditLog(spark, os.path.join(tmp_dir, "audit"))
    with log.run("summary_refresh") as ctx:
        ctx.rows_loaded = 3
        ctx.status = "dq_warning"
    with pytest.raises(RuntimeError):
        with log.run("broken"):
            raise RuntimeError("boom")
    log.record_success("scheduled_2024_01_01", 10)
    runs = {r["pipeline"]: r for r in log.runs().collect()}
    assert runs["summary_refresh"]["status"] == "dq_warning"
    assert runs["summary_refresh"]["rows_loaded"] == 3
    assert runs["broken"]["status"] == "failed" and runs["broken"]["rows_loaded"] is None
    assert runs["scheduled_2024_01_01"]["status"] == "success"
    assert log.history(5).count() == 3
    m = spark.createDataFrame([(0, 2)], "null_names bigint, bad bigint")
    v = Q.verdicts(m, [Q.Check("no_null_names", "null_names = 0", "null_names"),
                       Q.Check("no_bad", "bad = 0", "bad")], "passengers")
    log.log_checks(v, ctx.run_id)
    checks = log.checks(8).collect()
    assert {(r["check_name"], r["passed"]) for r in checks} == {("no_null_names", True), ("no_bad", False)}


def test_streaming_ingest_only_new_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    schema = "id int, name string"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    for i, rows in enumerate([["1,a", "2,b"], ["3,c"]]):
        with open(os.path.join(src, f"part{i}.csv"), "w") as f:
            f.write("id,name\n" + "\n".join(rows) + "\n")
    target, ckpt = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "bronze_ckpt")
    assert ingest_available(spark, src, st, target, ckpt, run_ts="2024-01-01 00:00:00") == 3
    with open(os.path.join(src, "part9.csv"), "w") as f:
        f.write("id,name\n4,d\n")
    assert ingest_available(spark, src, st, target, ckpt) == 1
    out = spark.read.parquet(target)
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3, 4]
    assert {r["_source_file"] for r in out.collect()} == {"part0.csv", "part1.csv", "part9.csv"}


def test_sized_broadcast_checks_rows(spark):
    small = spark.range(10)
    assert fits(small, 10) and not fits(small, 9)
    assert "BroadcastExchange" in report.plan_text(spark.range(1000).join(sized_broadcast(small, 10), "id"))


def test_broadcast_is_bound_by_bytes_too(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("a.b"), F.array(F.lit("yy")).alias("n"))
    assert fits(wide, 10) and fits(wide, 10, 11_000) and not fits(wide, 10, 10_000)
    assert fits(wide.limit(0), 0, 0)
    assert "BroadcastHashJoin" not in report.plan_text(
        spark.range(1000).hint("merge").join(sized_broadcast(wide, 10, 10_000), "id"))
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(5)], "id int, parent int")
    walk = H.walk_tree(chain, node="id", parent="parent", label="id", broadcast_bytes=0)
    assert sorted(r["depth"] for r in walk.collect()) == [0, 1, 2, 3, 4]


def test_diff_from_group_mean_is_the_window(spark):
    df = spark.createDataFrame([("a", 1), ("a", 4), ("b", 7), ("b", None)], "k string, v long")
    got = W.diff_from_group_mean(df, ["k"], "v", "m", "d").select("k", "v", "m", "d").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("a", 1, 2.5, -1.5), ("a", 4, 2.5, 1.5), ("b", 7, 7.0, 0.0), ("b", None, 7.0, None)], key=str)


def test_plans_push_down_and_limit_windows(spark):
    q = entry.queries()
    from tests.conftest import SF_ORACLE
    yt = report.plan_text(q["yearly_trends"](spark, SF_ORACLE))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in yt
    for name in ("rank_dense", "dedup_lineitem", "first_per_group", "upsert_latest"):
        plan = report.plan_text(q[name](spark, SF_ORACLE), "simple")
        limits = [i for i, ln in enumerate(plan.splitlines()) if "WindowGroupLimit" in ln]
        exchanges = [i for i, ln in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in ln]
        assert len(limits) == 2 and limits[0] < exchanges[0] < limits[1], name  # map-side limit
    sp = report.plan_text(q["scan_pruned"](spark, SF_ORACLE))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string>" in sp
    seg = report.plan_text(q["segment_rates"](spark, SF_ORACLE), "simple")
    assert seg.count("FileScan parquet") == 1 and "Expand" in seg  # one scan for all groupings
    top = report.plan_text(q["top_entities"](spark, SF_ORACLE))
    assert "TakeOrderedAndProject" in top


def test_duplicate_and_relationship_tests(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert A.duplicate_count(a, ["k"]).collect()[0]["duplicate_rows"] == 2
    parent = spark.createDataFrame([(1,)], "k int")
    assert sorted(r["k"] for r in Q.test_relationships(a, "k", parent, "k").collect()) == [2]
    assert Q.row_count_at_least(a, 4) and not Q.row_count_at_least(a, 5)
    fresh = Q.freshness(spark.createDataFrame([(dt.datetime(2024, 1, 31),)], "ts timestamp_ntz"),
                        "ts", "t", "2024-02-01 06:00:00", 24).collect()[0]
    assert (fresh["age_hours"], fresh["is_stale"]) == (30, True)


def test_format_report(spark, tmp_dir):
    df = files.read_table(spark, SF_SMALL, "orders")
    rep = report.format_report(spark, df, os.path.join(tmp_dir, "fmt"), ["o_orderkey", "o_totalprice"])
    by = {r["format"]: r for r in rep}
    assert by["parquet"]["bytes"] < by["csv"]["bytes"]


def test_catalog_tables_and_checked_write(spark, tmp_dir):
    layers.drop_table(spark, "audit_runs_t")
    layers.ensure_table(spark, "audit_runs_t", "id STRING, status STRING, rows_loaded INT")
    layers.ensure_table(spark, "audit_runs_t", "id STRING, status STRING, rows_loaded INT")
    assert spark.table("audit_runs_t").count() == 0
    rows = spark.createDataFrame([("a", "success", 3)], "id string, status string, rows_loaded int")
    layers.load_table(rows, "audit_runs_t", "append")
    layers.load_table(rows, "audit_runs_t", "append")
    assert spark.table("audit_runs_t").count() == 2
    layers.load_table(rows, "audit_runs_t", "overwrite")
    assert spark.table("audit_runs_t").count() == 1
    layers.drop_table(spark, "audit_runs_t")
    assert layers.write_checked(spark.range(42), os.path.join(tmp_dir, "chk")) == 42


def test_checksum_rebuild_decision(spark):
    a = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))],
                              "k long, ts timestamp_ntz")
    b = a.union(spark.createDataFrame([(3, dt.datetime(2024, 1, 3))], "k long, ts timestamp_ntz"))
    assert Q.rebuild_needed(Q.checksum(a, "k", "ts"), None)
    assert not Q.rebuild_needed(Q.checksum(a, "k", "ts"), Q.checksum(a, "k", "ts"))
    assert Q.rebuild_needed(Q.checksum(b, "k", "ts"), Q.checksum(a, "k", "ts"))
    changed = a.withColumn("v", F.lit(10)), a.withColumn("v", F.when(F.col("k") == 1, 99).otherwise(10))
    assert Q.rebuild_needed(Q.checksum(changed[1], "k", "ts"), Q.checksum(changed[0], "k", "ts"))
    top = spark.createDataFrame([(2 ** 63 - 1, None), (2 ** 63 - 1, None)], "k long, ts timestamp_ntz")
    assert int(Q.checksum(top, "k", "ts").first()["key_sum"]) == 2 * (2 ** 63 - 1)


def test_csv_is_read_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "swapped.csv")
    with open(path, "w") as f:
        f.write("b,extra,a\n1,z,x\n")
    row = files.read_csv_typed(spark, path, "a string, b int").first()
    assert (row["a"], row["b"]) == ("x", 1)
    assert files.read_csv_strings(spark, path, ["a", "b"]).first().asDict() == {"a": "x", "b": "1"}
    with pytest.raises(ValueError):
        files.read_csv_typed(spark, path, "a string, missing int")


def test_log_keeps_lines_that_do_not_parse(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mixed.log")
    with open(path, "w") as f:
        f.write("2024-03-01 09:00:03 ERROR boom\nTraceback (most recent call last)\n\n  at line 3\n")
    logs = files.read_log(spark, path)
    assert logs.count() == 4
    assert files.log_filter(logs, "Traceback|09:00:03").count() == 2


def test_chain_of_forty_levels_is_walked_whole(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(41)], "id int, parent int")
    assert H.walk_tree(chain, node="id", parent="parent", label="id").agg(F.max("depth")).first()[0] == 40


def test_filter_after_load_plans_like_pushdown(spark):
    """P-17: filtering a loaded frame is pushed into the scan like a filtered read."""
    o = files.read_table(spark, SF_SMALL, "orders")
    late = o.select("o_orderkey", "o_totalprice").filter(F.col("o_totalprice") > 100000)
    early = o.filter(F.col("o_totalprice") > 100000).select("o_orderkey", "o_totalprice")
    pick = [ln for ln in report.plan_text(late, "simple").splitlines() if "FileScan" in ln]
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)]" in pick[0]
    strip = lambda t: [ln.split("#")[0] for ln in t.splitlines() if "FileScan" in ln]
    assert strip(report.plan_text(late, "simple")) == strip(report.plan_text(early, "simple"))


def test_split_count_literal_equals_regex(spark):
    from stratum.functions import columns as C
    df = spark.createDataFrame([("a|b|",), ("a",), ("",), ("  ",), (None,), ("||",), ("a||b",)], "v string")
    got = df.select(C.split_count("v", "|").alias("lit"), C.split_count("v", r"\|", regex=True).alias("rx"))
    rows = [(r["lit"], r["rx"]) for r in got.collect()]
    assert rows == [(3, 3), (1, 1), (0, 0), (0, 0), (0, 0), (3, 3), (3, 3)]


def test_clustered_write_has_disjoint_file_ranges(spark, tmp_dir):
    """K-9: range clustering gives each file its own value range, so min/max skip files."""
    path = os.path.join(tmp_dir, "clustered")
    df = files.read_table(spark, SF_SMALL, "orders").select("o_orderkey", "o_totalprice")
    layers.write_clustered(df, path, "o_totalprice", num_files=4)
    per_file = (spark.read.parquet(path).groupBy("_metadata.file_path")
                .agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
                .orderBy("lo").collect())
    assert len(per_file) == 4
    assert all(a["hi"] <= b["lo"] for a, b in zip(per_file, per_file[1:]))
    hit = spark.read.parquet(path).filter(F.col("o_totalprice") > per_file[-1]["lo"])
    assert hit.select("_metadata.file_path").distinct().count() == 1


def test_drop_sparse_columns_and_rows_per_file(spark, tmp_dir):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, 5, "z")], "a int, b int, c string")
    assert A.drop_sparse(df, 0.5).columns == ["a", "c"]
    path = os.path.join(tmp_dir, "files")
    spark.range(10).repartition(2).write.parquet(path)
    counts = audit.rows_per_file(spark.read.parquet(path)).collect()
    assert len(counts) == 2 and sum(r["n_rows"] for r in counts) == 10


def test_hot_key_spreads_over_range_layout(spark):
    """A key with 90% of the rows is one hash partition, but many range partitions."""
    from stratum.operators import sequence as S
    rows = [(0 if i % 10 else i % 7 + 1, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, t int")
    hashed = df.repartition(8, "k").groupBy(F.spark_partition_id().alias("p")).count().collect()
    laid = S.range_layout(df, ["k", "t"], 8).groupBy("_pid").count().collect()
    assert max(r["count"] for r in hashed) >= 3600
    assert max(r["count"] for r in laid) <= 2 * 4000 / 8


def test_shuffle_partitions_sized_from_input(spark):
    from stratum.session import input_bytes, size_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size = input_bytes(spark, [f"{SF_SMALL}/lineitem.parquet", f"{SF_SMALL}/orders.parquet"])
        assert size > 0
        assert size_shuffle_partitions(spark, 100 * (1 << 40), minimum=8) == 200_000
        assert size_shuffle_partitions(spark, 10 * (1 << 30), minimum=8) == 40
        assert size_shuffle_partitions(spark, size, minimum=8) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x01　+-.0123456789ae,#٣", max_size=8),
                min_size=1, max_size=60))
def test_guarded_safe_cast_equals_try_cast(spark, texts):
    from stratum.functions import columns as C
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for t in ("int", "bigint", "tinyint"):
        rows = df.select(F.col("v").try_cast(t).alias("a"), C.safe_cast("v", t).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in rows), t


def test_profile_shape_types_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "k int, s string")
    got = {r["column_name"]: tuple(r)[1:] for r in A.profile(df).collect()}
    assert got == {"k": ("int", 3, 0, 2), "s": ("string", 3, 1, 1)}


def test_checkpoint_dir_policy():
    from stratum.session import ensure_checkpoint_dir

    class Ctx:
        def __init__(self, master, current=None):
            self.master, self.current, self.set_to = master, current, None

        def getCheckpointDir(self):
            return self.set_to or self.current

        def setCheckpointDir(self, d):
            self.set_to = d

        def getConf(self):
            return {}

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Session:
        def __init__(self, master, conf_value=None, current=None):
            self.sparkContext = Ctx(master, current)
            self.conf = Conf(conf_value)

    assert ensure_checkpoint_dir(Session("yarn", current="hdfs://nn/ckpt")) == "hdfs://nn/ckpt"
    assert ensure_checkpoint_dir(Session("yarn", conf_value="s3a://b/ckpt")) == "s3a://b/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session("yarn"))  # never a machine-local folder on a cluster
    assert ensure_checkpoint_dir(Session("local[2]")).startswith("/tmp/run-ckpt-")


def test_bucketed_tables_join_without_exchange(spark):
    orders = files.read_table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cust = files.read_table(spark, SF_SMALL, "customer").select("c_custkey", "c_mktsegment")
    layers.write_bucketed(orders.withColumnRenamed("o_custkey", "custkey"), "orders_b", ["custkey"], 8)
    layers.write_bucketed(cust.withColumnRenamed("c_custkey", "custkey"), "customer_b", ["custkey"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("orders_b").join(spark.table("customer_b"), "custkey")
        plan = report.plan_text(joined, "simple")
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == orders.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        layers.drop_table(spark, "orders_b")
        layers.drop_table(spark, "customer_b")


def test_full_overwrite_drops_stale_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "by_class")
    first = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, cls int")
    layers.write_partitioned(first, path, ["cls"])
    layers.write_partitioned(first.filter("cls < 3"), path, ["cls"])  # full replace
    assert sorted(r["cls"] for r in spark.read.parquet(path).collect()) == [1, 2]
    layers.overwrite_partitions(first.filter("cls = 1").withColumn("id", F.lit(10)), path, ["cls"])
    assert sorted((r["cls"], r["id"]) for r in spark.read.parquet(path).collect()) == [(1, 10), (2, 2)]


def test_refresh_affected_rebuilds_only_touched_days(spark, tmp_dir):
    def daily(rows):
        return rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))

    src = spark.createDataFrame([(dt.datetime(2024, 1, d, h), d) for d in range(1, 8) for h in (1, 13)],
                                "ts timestamp_ntz, v int").withColumn("day", F.to_date("ts"))
    target = os.path.join(tmp_dir, "daily_mart")
    layers.overwrite_partitions(daily(src), target, ["day"])
    before = {str(r["day"]): r["_metadata"]["file_path"] for r in
              spark.read.parquet(target).select("day", "_metadata").collect()}
    late = spark.createDataFrame([(dt.datetime(2024, 1, 6, 20), 100)], "ts timestamp_ntz, v int") \
        .withColumn("day", F.to_date("ts"))
    layers.refresh_affected(src.unionByName(late), "ts", "day", "1 day", daily, target)
    after = {str(r["day"]): (r["n"], r["total"], r["_metadata"]["file_path"]) for r in
             spark.read.parquet(target).select("day", "n", "total", "_metadata").collect()}
    assert after["2024-01-06"][:2] == (3, 112) and after["2024-01-07"][:2] == (2, 14)
    assert after["2024-01-01"][2] == before["2024-01-01"]  # untouched partition not rewritten
    assert after["2024-01-06"][2] != before["2024-01-06"]


def test_streaming_ingest_in_several_batches(spark, tmp_dir):
    from pyspark.sql.types import _parse_datatype_string
    src = os.path.join(tmp_dir, "landing_many")
    os.makedirs(src)
    for i in range(4):
        with open(os.path.join(src, f"f{i}.csv"), "w") as f:
            f.write("id,name\n" + "\n".join(f"{i * 10 + j},n{j}" for j in range(3)) + "\n")
    target, ckpt = os.path.join(tmp_dir, "bronze_many"), os.path.join(tmp_dir, "bronze_many_ckpt")
    st = _parse_datatype_string("id int, name string")
    assert ingest_available(spark, src, st, target, ckpt, max_files_per_trigger=1) == 12
    assert ingest_available(spark, src, st, target, ckpt) == 0  # nothing new: nothing re-read
    ids = sorted(r["id"] for r in spark.read.parquet(target).collect())
    assert ids == sorted(i * 10 + j for i in range(4) for j in range(3))


def test_medallion_dedups_only_when_metrics_show_duplicates(spark):
    from stratum.plans import medallion
    orders = files.read_table(spark, SF_SMALL, "orders")
    unique_run = medallion.run(orders, "2024-01-01 00:00:00")
    assert "Window" not in report.plan_text(unique_run.silver, "simple")
    dup_run = medallion.run(orders.unionByName(orders.limit(3)), "2024-01-01 00:00:00")
    assert dup_run.status == "dq_warning"
    assert "Window" in report.plan_text(dup_run.silver, "simple")
    assert dup_run.silver.count() == unique_run.silver.count() == orders.count()


def test_final_plan_after_execution(spark):
    q = entry.queries()
    from tests.conftest import SF_ORACLE
    mart = q["class_summary"](spark, SF_ORACLE)
    assert "isFinalPlan=false" in report.plan_text(mart)
    assert "isFinalPlan=true" in report.final_plan_text(mart)


def test_stage_timings_from_event_log(spark):
    from tests.conftest import EVENT_LOG_DIR
    files.read_table(spark, SF_SMALL, "lineitem").groupBy("l_returnflag").count().collect()
    t = report.stage_timings(spark, EVENT_LOG_DIR)
    rows = t.collect()
    assert rows and all(r["duration_ms"] >= 0 and r["tasks"] >= 1 for r in rows)
    assert report.event_log_conf("/x")["spark.eventLog.dir"] == "/x"


def test_shuffle_volumes_stay_small_where_claimed(spark):
    """Scale claims as assertions, measured from the event log."""
    from tests.conftest import EVENT_LOG_DIR, SF_ORACLE
    q = entry.queries()
    sc = spark.sparkContext
    names = ["null_profile", "class_summary", "diff_from_avg", "dedup_lineitem"]
    for name in names:
        sc.setJobGroup(f"shuffle:{name}", name)
        q[name](spark, SF_ORACLE).write.format("noop").mode("overwrite").save()
    sc.setLocalProperty("spark.jobGroup.id", None)
    got = report.shuffle_bytes_by_group(spark, EVENT_LOG_DIR, "shuffle:")
    assert got.get("null_profile", 0) < 16_000      # markers, not the document text
    assert got.get("class_summary", 0) < 16_000     # partial aggregation
    assert got.get("diff_from_avg", 0) < 16_000     # broadcast means, map-side top-k
    assert got["dedup_lineitem"] > 100_000          # full rows must move for a dedup


def test_upsert_query_reduces_repeated_ids(spark, tmp_dir):
    from stratum.plans.catalogue import QUERIES
    rows = [(1, 7, "view", 1.0, "2024-01-01 00:00:00"), (1, 7, "view", 2.0, "2024-01-02 00:00:00"),
            (2, 7, "error", 3.0, "2024-01-01 00:00:00")]
    (spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, ts string")
     .withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_dir}/repeated/events.parquet"))
    got = QUERIES["upsert_latest"](spark, f"{tmp_dir}/repeated").collect()
    assert sorted((r["event_id"], r["value"]) for r in got) == [(1, 2.0), (2, 4.0)]
