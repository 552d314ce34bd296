"""Plan reports (G-9) and the file-format report (K-12)."""

from __future__ import annotations

import contextlib
import io
import time

from pyspark.sql import DataFrame, SparkSession


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints (simple, extended, codegen, cost, formatted)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan_has(df: DataFrame, *operators: str, mode: str = "formatted") -> dict[str, bool]:
    text = plan_text(df, mode)
    return {op: op in text for op in operators}


def timed_noop(df: DataFrame) -> float:
    """Seconds to execute ``df`` fully into the ``noop`` sink."""
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def format_report(spark: SparkSession, df: DataFrame, folder: str,
                  columns: list[str]) -> list[dict]:
    """Write ``df`` as CSV and Parquet under ``folder``; size and read times.

    Read variants: full scan of each format and a ``columns`` projection
    (where Parquet prunes and CSV cannot). Sizes come from file metadata.
    """
    from .layers import layer_report

    csv_path, pq_path = f"{folder}/csv", f"{folder}/parquet"
    df.write.mode("overwrite").option("header", True).csv(csv_path)
    df.write.mode("overwrite").parquet(pq_path)
    sizes = {r["layer"]: r["bytes"] for r in layer_report(spark, {"parquet": pq_path}).collect()}
    csv_files = spark.read.text(csv_path).select("_metadata.file_path", "_metadata.file_size").distinct()
    sizes["csv"] = csv_files.groupBy().sum("file_size").collect()[0][0]
    csv = spark.read.schema(df.schema).option("header", True).csv(csv_path)
    pq = spark.read.parquet(pq_path)
    return [
        {"format": "csv", "bytes": int(sizes["csv"]), "full_read_s": timed_noop(csv),
         "projected_read_s": timed_noop(csv.select(*columns))},
        {"format": "parquet", "bytes": int(sizes["parquet"]), "full_read_s": timed_noop(pq),
         "projected_read_s": timed_noop(pq.select(*columns))},
    ]


def final_plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The AQE *final* plan (G-9): runs the frame's own query, then explains it.

    Meant for bounded results (marts, metrics): the rows are collected. After
    execution the adaptive plan shows ``isFinalPlan=true`` with the runtime
    decisions (coalesced partitions, broadcast conversions, skew splits).
    """
    df.collect()
    return plan_text(df, mode)


def event_log_conf(folder: str) -> dict[str, str]:
    """Session settings that write Spark's event log to ``folder`` (no UI, no server).

    Plain JSON lines (no compression, no rolling), so Spark can read it back.
    """
    return {"spark.eventLog.enabled": "true", "spark.eventLog.dir": folder,
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}


def _events(spark: SparkSession, folder: str, event: str, schema) -> DataFrame:
    """Lines of one event type, parsed with an explicit schema.

    No schema inference over the whole log: different event types reuse keys
    that differ only in case (``timestamp``/``Timestamp``), which inference
    rejects.
    """
    from pyspark.sql import functions as F

    lines = spark.read.text(folder).filter(F.col("value").contains(f'"Event":"{event}"'))
    return lines.select(F.from_json("value", schema).alias("e")).select("e.*")


def stage_timings(spark: SparkSession, folder: str) -> DataFrame:
    """Per-stage wall time and task counts from the event log (EXPLAIN ANALYZE analogue).

    One row per completed stage: ``stage_id, attempt, stage_name, tasks, duration_ms``.
    """
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    info = T.StructType([T.StructField("Stage ID", T.IntegerType()),
                         T.StructField("Stage Attempt ID", T.IntegerType()),
                         T.StructField("Stage Name", T.StringType()),
                         T.StructField("Number of Tasks", T.IntegerType()),
                         T.StructField("Submission Time", T.LongType()),
                         T.StructField("Completion Time", T.LongType())])
    ev = _events(spark, folder, "SparkListenerStageCompleted",
                 T.StructType([T.StructField("Stage Info", info)]))
    i = "`Stage Info`"
    return ev.select(F.col(f"{i}.`Stage ID`").alias("stage_id"),
                     F.col(f"{i}.`Stage Attempt ID`").alias("attempt"),
                     F.col(f"{i}.`Stage Name`").alias("stage_name"),
                     F.col(f"{i}.`Number of Tasks`").alias("tasks"),
                     (F.col(f"{i}.`Completion Time`") - F.col(f"{i}.`Submission Time`"))
                     .alias("duration_ms"))


def shuffle_bytes_by_group(spark: SparkSession, folder: str, prefix: str) -> dict[str, int]:
    """Shuffle bytes written by the jobs of each job group starting with ``prefix``.

    Jobs are tagged with ``sparkContext.setJobGroup(prefix + name, ...)`` before
    running; returns ``{name: bytes}``. The per-group totals are one row each.
    """
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    jobs = _events(spark, folder, "SparkListenerJobStart", T.StructType([
        T.StructField("Stage IDs", T.ArrayType(T.IntegerType())),
        T.StructField("Properties", T.MapType(T.StringType(), T.StringType()))]))
    tagged = (jobs.select(F.explode("`Stage IDs`").alias("stage"),
                          F.col("Properties").getItem("spark.jobGroup.id").alias("g"))
                  .filter(F.col("g").startswith(prefix)).distinct())
    metrics = T.StructType([T.StructField("Shuffle Write Metrics", T.StructType([
        T.StructField("Shuffle Bytes Written", T.LongType())]))])
    tasks = _events(spark, folder, "SparkListenerTaskEnd", T.StructType([
        T.StructField("Stage ID", T.IntegerType()), T.StructField("Task Metrics", metrics)]))
    per = (tasks.select(F.col("`Stage ID`").alias("stage"),
                        F.col("`Task Metrics`.`Shuffle Write Metrics`.`Shuffle Bytes Written`")
                        .alias("b"))
                .join(tagged, "stage").groupBy("g").agg(F.sum("b").alias("b")).collect())
    return {r["g"][len(prefix):]: int(r["b"] or 0) for r in per}
