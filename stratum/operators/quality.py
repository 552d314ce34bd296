"""Data-quality checks: one-pass metrics, verdict rows, gates and row tests.

Metrics are computed in a single aggregate; only that one-row result is ever
brought to the driver (for a gate). Row tests return the failing rows as a
DataFrame, so "passes" means "is empty" and can be checked with ``isEmpty()``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``metric`` (a column of the metrics row) must satisfy ``rule``.

    ``rule`` is a SQL predicate over the metrics row, e.g. ``"null_ids = 0"``.
    ``details`` is a SQL string expression used for the verdict text.
    ``severity`` is ``"error"`` (gate fails) or ``"warn"`` (status dq_warning).
    """

    name: str
    rule: str
    details: str
    severity: str = "error"


class DataQualityError(RuntimeError):
    pass


def metrics(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One-pass metrics row (D-1): ``{name: aggregate}``."""
    return df.agg(*[c.alias(n) for n, c in measures.items()])


def verdicts(metrics_row: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """Metrics row -> one verdict row per check (D-2), still distributed."""
    rows = [F.struct(F.lit(c.name).alias("check_name"),
                     F.expr(c.rule).alias("passed"),
                     F.expr(c.details).cast("string").alias("details"),
                     F.lit(c.severity).alias("severity")) for c in checks]
    return (metrics_row.select(F.explode(F.array(*rows)).alias("v"))
            .select(F.lit(table).alias("table_name"), "v.check_name", "v.passed",
                    "v.details", "v.severity"))


def gate(verdict_rows: DataFrame) -> str:
    """Raise on failed error checks (D-3); return ``success`` or ``dq_warning`` (D-4).

    The verdict frame has one row per check, so collecting it is bounded.
    """
    rows = verdict_rows.collect()
    failed = [r for r in rows if not r["passed"] and r["severity"] == "error"]
    if failed:
        listing = ", ".join(f"{r['check_name']} ({r['details']})" for r in failed)
        raise DataQualityError(f"DQ checks failed: {listing}")
    return "dq_warning" if any(not r["passed"] for r in rows) else "success"


def gate_status(verdict_rows: DataFrame) -> DataFrame:
    """The gate's outcome per table as rows: failed, dq_warning or success (D-3, D-4)."""
    bad = ~F.coalesce(F.col("passed"), F.lit(False))
    return verdict_rows.groupBy("table_name").agg(
        F.count_if(bad & (F.col("severity") == "error")).alias("n_errors"),
        F.count_if(bad & (F.col("severity") != "error")).alias("n_warnings")).withColumn(
        "status", F.when(F.col("n_errors") > 0, "failed").when(F.col("n_warnings") > 0, "dq_warning")
        .otherwise("success"))


# --------------------------------------------------------------- row tests (D-6..D-12)

def test_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def test_not_null(df: DataFrame, col: str, report: Sequence[str] = ()) -> DataFrame:
    return df.filter(F.col(col).isNull()).select(*(list(report) or df.columns))


def test_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values outside the accepted set (NULL is not_null's job), with counts."""
    bad = df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
    return bad.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def test_bounds(df: DataFrame, col: str, lo=None, hi=None,
                report: Sequence[str] = ()) -> DataFrame:
    """Rows with ``col`` outside ``[lo, hi]``; either bound may be open."""
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    return df.filter(bad).select(*(list(report) or df.columns))


def test_non_negative(df: DataFrame, col: str, report: Sequence[str] = ()) -> DataFrame:
    return test_bounds(df, col, lo=0, report=report)


def test_relationships(child: DataFrame, key: str, parent: DataFrame,
                       parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (``left_anti``); NULL keys are not_null's job."""
    parents = parent.select(F.col(parent_key).alias(key))
    # no pre-count: AQE broadcasts the parent keys at run time when they are small
    return child.filter(F.col(key).isNotNull()).join(parents, key, "left_anti")


def row_count_at_least(df: DataFrame, n: int) -> bool:
    """Minimum row guard (D-13) without a full count."""
    return df.limit(n).count() >= n


def row_guard(df: DataFrame, n: int, table: str) -> DataFrame:
    """The minimum row guard as one row; reads no more than ``n`` rows a task."""
    return df.limit(n).agg(F.lit(table).alias("table_name"), (F.count(F.lit(1)) >= n).alias("passed"))


def volume_class(n_rows: Column, small: int = 500) -> Column:
    """empty / small / full (D-14)."""
    return (F.when(n_rows == 0, F.lit("empty"))
             .when(n_rows < F.lit(small), F.lit("small"))
             .otherwise(F.lit("full")))


def freshness(df: DataFrame, ts_col: str, table: str, as_of: str,
              max_age_hours: int) -> DataFrame:
    """Newest timestamp vs. a fixed as-of instant (D-17); one row.

    The age is a TIMESTAMP_NTZ difference, so it does not depend on the
    session time zone.
    """
    newest = F.max(F.col(ts_col).cast("timestamp_ntz"))
    as_of_ts = F.lit(as_of).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", newest, as_of_ts)
    age_h = micros.cast("double") / F.lit(3_600_000_000.0)
    return df.agg(F.lit(table).alias("table_name"), newest.alias("newest_ts"),
                  F.floor(age_h).cast("long").alias("age_hours"),
                  (age_h > F.lit(float(max_age_hours))).alias("is_stale"))


def reconcile(source: DataFrame, mart: DataFrame, mart_total: str) -> DataFrame:
    """Source row count vs. the sum of a mart's totals (D-11), one row, no join.

    Both sides go through one aggregate over a union, so no cross join is needed.
    """
    s = source.select(F.lit(1).cast("long").alias("_src"), F.lit(0).cast("long").alias("_mart"))
    m = mart.select(F.lit(0).cast("long").alias("_src"), F.col(mart_total).cast("long").alias("_mart"))
    both = s.unionByName(m).agg(F.coalesce(F.sum("_src"), F.lit(0)).alias("source_rows"),
                                F.coalesce(F.sum("_mart"), F.lit(0)).alias("mart_rows"))
    return both.withColumn("rows_match", F.col("source_rows") == F.col("mart_rows"))


def reconcile_failures(source: DataFrame, mart: DataFrame, mart_total: str) -> DataFrame:
    """The singular-test form: a row only when the counts differ."""
    return reconcile(source, mart, mart_total).filter(~F.col("rows_match")).drop("rows_match")


def checksum(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Change detector (D-15): row count, key sum, newest timestamp, and a sum of row hashes.

    The hash of all columns makes updates in place visible; sums are DECIMAL(38,0), which
    neither grows past its range at any number of keys in use.
    """
    wide = lambda c: F.sum(c.cast("decimal(20,0)")).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), wide(F.col(key)).alias("key_sum"),
                  F.max(ts).alias("max_ts"), wide(F.xxhash64(*df.columns)).alias("row_hash_sum"))


def rebuild_needed(current: DataFrame, previous: DataFrame | None) -> bool:
    """True when there is no previous checksum or any checksum field changed.

    Both frames are the one-row output of :func:`checksum`.
    """
    if previous is None:
        return True
    a, b = current.collect()[0], previous.collect()[0]
    return tuple(a) != tuple(b)
