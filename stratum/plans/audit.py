"""Append-only audit trail of pipeline runs and data-quality checks (G-1..G-8).

Parquet has no UPDATE, so a run is a sequence of events (``running`` then
``success``/``dq_warning``/``failed``) and its current state is the latest
event per run id, computed with one aggregate. NOT NULL columns are enforced
by the schema when rows are created; ids are UUIDs instead of SERIAL.

Every event is a file of its own until ``compact`` folds them: the folded log is a published
version (see :mod:`stratum.plans.versions`), and readers take it together with the loose
files. An event that is in both counts once, so readers see the same history before, during
and after. A loose file is deleted by the compaction after the one that folded it.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import current_version, file_system, publish, read_published

RUN_EVENTS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("pipeline", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("rows_loaded", T.LongType(), True),
    T.StructField("started_at", T.TimestampNTZType(), True),
    T.StructField("finished_at", T.TimestampNTZType(), True),
    T.StructField("event_at", T.TimestampNTZType(), False),
    T.StructField("scheduled_for", T.DateType(), True),
])

DQ_LOG = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("details", T.StringType(), True),
    T.StructField("checked_at", T.TimestampNTZType(), False),
])

FOLDED = "_folded"
STATUSES = ("running", "success", "dq_warning", "failed")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class RunContext:
    run_id: str
    pipeline: str
    started_at: dt.datetime
    status: str = "success"
    rows_loaded: int | None = None
    extra: dict = field(default_factory=dict)


class AuditLog:
    """Run and check history under ``root`` (two Parquet tables)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.runs_path = root.rstrip("/") + "/pipeline_runs"
        self.checks_path = root.rstrip("/") + "/data_quality_log"

    # ------------------------------------------------------------ events
    def _append_run(self, row: tuple, scheduled_for: dt.date | None = None) -> None:
        row = (*row, scheduled_for)
        self.spark.createDataFrame([row], RUN_EVENTS).coalesce(1).write.mode("append").parquet(self.runs_path)

    def start(self, pipeline: str) -> RunContext:
        """G-1: a ``running`` event with a fresh run id."""
        ctx = RunContext(str(uuid.uuid4()), pipeline, _now())
        self._append_run((ctx.run_id, pipeline, "running", None, ctx.started_at, None, ctx.started_at))
        return ctx

    def finish(self, ctx: RunContext, status: str, rows_loaded: int | None = None) -> None:
        """G-2: the closing event (status, rows, finish time)."""
        if status not in STATUSES:
            raise ValueError(f"unknown status {status!r}")
        at = _now()
        self._append_run((ctx.run_id, ctx.pipeline, status, rows_loaded, ctx.started_at, at, at))

    def record_success(self, pipeline: str, rows_loaded: int | None, scheduled_for: dt.date | None = None) -> None:
        """G-5: one success row per scheduled run and date, without a start event."""
        at = _now()
        self._append_run((str(uuid.uuid4()), pipeline, "success", rows_loaded, None, at, at), scheduled_for)

    def succeeded(self, pipeline: str, scheduled_for: dt.date) -> bool:
        """Whether a success entry of the pipeline names the schedule date (G-5)."""
        return not self._events(self.runs_path, RUN_EVENTS).filter(
            (F.col("pipeline") == pipeline) & (F.col("status") == "success")
            & (F.col("scheduled_for") == F.lit(scheduled_for))).isEmpty()

    @contextlib.contextmanager
    def run(self, pipeline: str):
        """G-3: ``with audit.run("name") as ctx:`` marks failures and re-raises."""
        ctx = self.start(pipeline)
        try:
            yield ctx
        except BaseException:
            self.finish(ctx, "failed", None)
            raise
        self.finish(ctx, ctx.status, ctx.rows_loaded)

    def log_checks(self, verdict_rows: DataFrame, run_id: str | None = None) -> None:
        """Append verdict rows (``table_name, check_name, passed, details``)."""
        at = _now()
        def required(c: str):
            return F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} must not be NULL")))
        rows = verdict_rows.select(
            F.expr("uuid()").alias("id"), F.lit(run_id).cast("string").alias("run_id"),
            required("table_name").alias("table_name"), required("check_name").alias("check_name"),
            required("passed").cast("boolean").alias("passed"),
            F.col("details").cast("string").alias("details"),
            F.lit(str(at)).cast("timestamp_ntz").alias("checked_at"))
        rows.write.mode("append").parquet(self.checks_path)

    # ------------------------------------------------------------ folding
    def _loose(self, path: str) -> list[str]:
        try:
            return sorted(self.spark.read.parquet(path).inputFiles())
        except AnalysisException:  # no event yet
            return []

    def _events(self, path: str, schema: T.StructType) -> DataFrame:
        """Folded and loose events; one that is in both appears twice."""
        folded = read_published(self.spark, path + FOLDED) if current_version(self.spark, path + FOLDED) else None
        loose = self._loose(path)
        parts = [self.spark.read.schema(schema).parquet(*loose)] if loose else []
        parts += [] if folded is None else [folded]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    def compact(self) -> None:
        """Fold all events so far into one published version, while appends go on (G-1, G-2).

        Two compactions at once are told apart by the version they built on: one is refused.
        """
        for path, schema, event in ((self.runs_path, RUN_EVENTS, ["run_id", "status", "event_at"]),
                                    (self.checks_path, DQ_LOG, ["id"])):
            now, loose = current_version(self.spark, path + FOLDED), self._loose(path)
            if not loose:
                continue
            new = self.spark.read.schema(schema).parquet(*loose)
            done = []
            if now:
                old = self.spark.read.schema(schema).parquet(now[1])
                # a file may go if the version that readers have had since the last compaction holds all its events
                held = old.select(*event).distinct()
                missing = {r[0] for r in (new.select("*", F.col("_metadata.file_name").alias("_file"))
                                          .join(held, event, "left_anti").select("_file").distinct().collect())}
                done = [f for f in loose if f.rsplit("/", 1)[-1] not in missing]
                new = old.unionByName(new)
            publish(new.distinct(), path + FOLDED, expect=now[0] if now else 0)
            for name in done:
                fs, file, _ = file_system(self.spark, name)
                fs.delete(file, False)

    # ------------------------------------------------------------ views
    def runs(self) -> DataFrame:
        """Current state per run: latest event wins, start time from the first."""
        ev = self._events(self.runs_path, RUN_EVENTS)
        latest = F.max_by(F.struct("status", "rows_loaded", "finished_at"), "event_at")
        return (ev.groupBy("run_id", "pipeline")
                  .agg(F.min("started_at").alias("started_at"), latest.alias("_l"))
                  .select("run_id", "pipeline", "_l.status", "_l.rows_loaded", "started_at",
                          "_l.finished_at"))

    def history(self, n: int = 5) -> DataFrame:
        """G-4: newest ``n`` runs."""
        r = self.runs()
        order = F.coalesce("started_at", "finished_at")
        return r.orderBy(order.desc(), F.col("run_id").desc()).limit(n)

    def checks(self, n: int = 8) -> DataFrame:
        c = self._events(self.checks_path, DQ_LOG).dropDuplicates(["id"])
        return c.orderBy(F.col("checked_at").desc(), F.col("id").desc()).limit(n)


# ---------------------------------------------------------------- log files (G-7, G-8)

def level_counts(logs: DataFrame) -> DataFrame:
    """Events per level from parsed log lines (see ``sources.files.read_log``)."""
    return logs.filter(F.col("level").isNotNull()).groupBy("level").agg(F.count(F.lit(1)).alias("n_lines"))


def error_summary(logs: DataFrame, levels=("ERROR",)) -> DataFrame:
    return logs.filter(F.col("level").isin(list(levels))).orderBy("ts").select("ts", "level", "message")


def rows_per_file(df: DataFrame) -> DataFrame:
    """G-8: rows per source file of a file-based scan (report only)."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("n_rows"))
