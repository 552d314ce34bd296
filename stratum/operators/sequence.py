"""Order-dependent windows that stay distributed.

A window with no PARTITION BY runs in one task, and a window partitioned by a
key runs each key in one task, so a key holding a third of the rows puts a third
of the table into one sort. Everything here instead lays the rows out once by
*range* over the full order (partition keys first), so a hot key spreads across
many range partitions, and then repairs the partition edges:

* ``range_layout`` range-partitions on a total order, sorts each partition and
  cuts lineage with a reliable ``checkpoint()`` (later passes must see the same
  layout; range bounds come from sampling). Each row gets ``_pid`` and ``_pos``
  (its position inside the partition: the low 33 bits of
  ``monotonically_increasing_id``, which count records within a partition).
* One aggregate pass gives per-partition counts, hence the global ``_row``.
  The counts table has one row per partition, a proven bound, so it is broadcast.
* Frames that look back/forward ``k`` rows (lag, lead, moving aggregates) get a
  *halo*: rows within ``k`` positions of a partition edge are replicated into
  the neighbouring partition (``2k`` copies per partition at most) in the same
  scan, and an ordinary window then runs per (``_pid``, key).
* Running sums add the total of the same key in earlier partitions. Only the
  first key of a partition can continue from an earlier one, so that carry
  table also has at most one row per partition.

There is one path for every size of group, so results never depend on how much data
there is; the number of ranges follows the planner's estimate of the input's bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

PID, POS, ROW, N, START, TOTAL, HALO = "_pid", "_pos", "_row", "_n", "_start", "_total", "_halo"
INTERNAL = (PID, POS, ROW, N, START, TOTAL, HALO)
_LOW33 = (1 << 33) - 1
_FAR = 1 << 62
# the planner gives a checkpointed frame the largest long, less the share of columns left out
_UNKNOWN = 1 << 55
# estimated input bytes that one range should hold
RANGE_BYTES = 256 << 20


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _num_partitions(df: DataFrame, wanted: int | None) -> int:
    """``wanted``, or as many ranges as the planner's size estimate of the input asks for.

    Never fewer than the session's shuffle partitions; the estimate is taken from file
    sizes, without a job.
    """
    if wanted:
        return wanted
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # inputs of unknown size are left at the setting
    return least if estimate >= _UNKNOWN else max(least, -(-estimate // RANGE_BYTES))


def range_layout(df: DataFrame, order: Sequence[Column | str],
                 num_partitions: int | None = None) -> DataFrame:
    """Range-partitioned, locally sorted, checkpointed copy with ``_pid``/``_pos``.

    ``order`` must be a total order (add a unique tie-breaker) so that the
    layout, and every result derived from it, is deterministic.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = _cols(order)
    laid = (df.repartitionByRange(_num_partitions(df, num_partitions), *keys)
            .sortWithinPartitions(*keys)
            .checkpoint(eager=True))
    return (laid.withColumn(PID, F.spark_partition_id())
                .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))


def starts_from_counts(counts: DataFrame) -> DataFrame:
    """(``_pid``, ``_n``) -> adds ``_start`` (rows before) and ``_total``.

    ``counts`` has one row per non-empty partition, so the un-partitioned
    windows here run over a table bounded by the partition count.
    """
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn(START, F.coalesce(F.sum(N).over(before), F.lit(0)).cast("long"))
                  .withColumn(TOTAL, F.sum(N).over(Window.partitionBy(F.lit(1))).cast("long")))


def partition_starts(laid: DataFrame) -> DataFrame:
    return starts_from_counts(laid.groupBy(PID).agg(F.count(F.lit(1)).alias(N)))


def with_row_index(laid: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Adds ``_row`` (1-based global position), ``_n``, ``_start`` and ``_total``."""
    starts = partition_starts(laid) if starts is None else starts
    # one row per partition: a bound fixed by the layout, safe to broadcast
    return (laid.join(F.broadcast(starts), PID)
                .withColumn(ROW, F.col(START) + F.col(POS) + F.lit(1)))


def _strip(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in (*INTERNAL, *extra) if c in df.columns])


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` without a single-partition exchange."""
    idx = with_row_index(range_layout(df, order, num_partitions))
    return _strip(idx.withColumn(name, F.col(ROW)))


def global_ntile(df: DataFrame, order: Sequence[Column | str], buckets: int,
                 name: str = "ntile", num_partitions: int | None = None) -> DataFrame:
    """``ntile(buckets) OVER (ORDER BY order)``, distributed.

    With ``N`` rows, ``q = N div k`` and ``r = N mod k``: the first ``r`` tiles
    hold ``q + 1`` rows, the rest ``q``.
    """
    k = int(buckets)
    if k <= 0:
        raise ValueError("buckets must be positive")
    idx = with_row_index(range_layout(df, order, num_partitions))
    q, r = f"({TOTAL} div {k})", f"({TOTAL} % {k})"
    tile = F.expr(
        f"""CASE WHEN {ROW} <= {r} * ({q} + 1) THEN ({ROW} - 1) div ({q} + 1) + 1
                 ELSE {r} + ({ROW} - {r} * ({q} + 1) - 1) div {q} + 1 END""")
    return _strip(idx.withColumn(name, tile.cast("int")))


def _edge_targets(starts: DataFrame, back: int, ahead: int) -> DataFrame:
    """Per source partition, the neighbours it lends edge rows to.

    For destination ``q``: its back halo is the ``back`` rows before
    ``_start[q]``, found in the previous ``back`` non-empty partitions; its
    ahead halo is the ``ahead`` rows after its end, in the next ones. Output:
    ``(_src, _targets: array<struct<_dst, _lo, _hi, _h>>)``, positions inclusive.
    """
    w = Window.orderBy(PID)
    nb = starts.select(PID, N, START,
                       *[F.lag(PID, i).over(w).alias(f"_bp{i}") for i in range(1, back + 1)],
                       *[F.lag(START, i).over(w).alias(f"_bs{i}") for i in range(1, back + 1)],
                       *[F.lead(PID, i).over(w).alias(f"_ap{i}") for i in range(1, ahead + 1)],
                       *[F.lead(START, i).over(w).alias(f"_as{i}") for i in range(1, ahead + 1)])
    entries = []
    for i in range(1, back + 1):
        entries.append(F.struct(F.col(f"_bp{i}").alias("_src"), F.col(PID).alias("_dst"),
                                (F.col(START) - F.lit(back) - F.col(f"_bs{i}")).alias("_lo"),
                                F.lit(_FAR).alias("_hi")))
    for i in range(1, ahead + 1):
        entries.append(F.struct(F.col(f"_ap{i}").alias("_src"), F.col(PID).alias("_dst"),
                                F.lit(0).cast("long").alias("_lo"),
                                (F.col(START) + F.col(N) + F.lit(ahead) - F.lit(1)
                                 - F.col(f"_as{i}")).alias("_hi")))
    flat = (nb.select(F.explode(F.array(*entries)).alias("t")).select("t.*")
                  .filter(F.col("_src").isNotNull()))
    return flat.groupBy("_src").agg(F.collect_list(
        F.struct(F.col("_dst").cast("int").alias("_dst"), F.col("_lo").cast("long").alias("_lo"),
                 F.col("_hi").cast("long").alias("_hi"), F.lit(True).alias("_h"))).alias("_targets"))


def _with_halo(idx: DataFrame, starts: DataFrame, back: int, ahead: int) -> DataFrame:
    """Own rows plus replicated edge rows, each tagged with the partition it serves."""
    if back <= 0 and ahead <= 0:
        return idx.withColumn(HALO, F.lit(False))
    targets = _edge_targets(starts, back, ahead)
    own = F.array(F.struct(F.col(PID).cast("int").alias("_dst"), F.lit(0).cast("long").alias("_lo"),
                           F.lit(_FAR).cast("long").alias("_hi"), F.lit(False).alias("_h")))
    tagged = idx.join(F.broadcast(targets), idx[PID] == targets["_src"], "left")
    # only rows within `back` of a partition's end or `ahead` of its start can
    # serve a neighbour; interior rows pass through without the explode fan-out
    edge = (F.col(POS) >= F.col(N) - F.lit(back)) | (F.col(POS) < F.lit(ahead))
    arr = (F.when(F.col("_targets").isNull() | ~edge, own)
            .otherwise(F.concat(own, F.col("_targets"))))
    keep = [c for c in idx.columns if c != PID]
    return (tagged.select(*keep, F.explode(arr).alias("_t"))
                  .filter((F.col(POS) >= F.col("_t._lo")) & (F.col(POS) <= F.col("_t._hi")))
                  .select(*keep, F.col("_t._dst").alias(PID), F.col("_t._h").alias(HALO)))


def sequence_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    build: Callable[[Window], Mapping[str, Column]] | None = None,
                    back: int = 0, ahead: int = 0,
                    running: Mapping[str, Column] | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Bounded-frame window expressions and running sums, safe on hot keys.

    ``build(w)`` receives a ``WindowSpec`` (partitioned by key, ordered by the
    global position) and returns ``{name: column}``; its frames must not reach
    further than ``back`` rows behind or ``ahead`` rows ahead. ``running`` maps
    output names to value columns summed from the start of each key.
    ``order`` with ``keys`` must be a total order.
    """
    running = dict(running or {})
    vals = {f"_v{i}": c for i, c in enumerate(running.values())}
    base = df.select("*", *[c.alias(n) for n, c in vals.items()])
    laid = range_layout(base, [*keys, *order], num_partitions)
    if running:
        part = laid.groupBy(PID, *keys).agg(F.count(F.lit(1)).alias("_cnt"),
                                            *[F.sum(v).alias(f"_p{v}") for v in vals])
        starts = starts_from_counts(part.groupBy(PID).agg(F.sum("_cnt").alias(N)))
        earlier = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
        # only a partition's first key can continue an earlier partition, so the
        # carry table has at most one row per partition: bounded, broadcast
        carry = (part.select(PID, *keys, F.sum("_cnt").over(earlier).alias("_seen"),
                             *[F.sum(f"_p{v}").over(earlier).alias(f"_c{v}") for v in vals])
                     .filter(F.col("_seen") > 0).drop("_seen"))
        # fresh names: carry shares lineage with the rows, so same-named columns
        # would resolve to the same attributes in the join condition
        ck = {k: f"_ck{i}" for i, k in enumerate(keys)}
        carry = carry.select(F.col(PID).alias("_cpid"), *[F.col(k).alias(ck[k]) for k in keys],
                             *[F.col(f"_c{v}") for v in vals])
        cond = F.col(PID) == F.col("_cpid")
        for k in keys:  # NULL is a key of its own, as in PARTITION BY
            cond = cond & F.col(k).eqNullSafe(F.col(ck[k]))
        idx = (with_row_index(laid, starts).join(F.broadcast(carry), cond, "left")
               .drop("_cpid", *ck.values()))
    else:
        starts = partition_starts(laid)
        idx = with_row_index(laid, starts)
    framed = _with_halo(idx, starts, back, ahead)
    w = Window.partitionBy(PID, *keys).orderBy(ROW)
    exprs = dict(build(w)) if build else {}
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for (name, _), v in zip(running.items(), vals):
        local = F.sum(F.when(~F.col(HALO), F.col(v))).over(upto)
        carry_in = F.col(f"_c{v}")
        # NULL only while every value so far is NULL, here and in the earlier partitions
        exprs[name] = F.when(local.isNotNull() | carry_in.isNotNull(),
                             F.coalesce(local, F.lit(0)) + F.coalesce(carry_in, F.lit(0)))
    out = framed.select("*", *[c.alias(n) for n, c in exprs.items()]).filter(~F.col(HALO))
    return _strip(out, [*vals, *[f"_c{v}" for v in vals]])


def running_range(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  running: Mapping[str, Column], num_partitions: int | None = None) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys ORDER BY order)`` with the default RANGE frame.

    Rows that tie on ``order`` are peers and share one sum, so values are summed per
    (keys, order) first, combined in their tasks; the running sum is taken over those and
    joined back to the rows, where adaptive execution splits a hot peer group. ``order``
    need not be total.
    """
    at = [*keys, *order]
    vals = {f"_t{i}": c for i, c in enumerate(running.values())}
    base = df.select("*", *[c.alias(n) for n, c in vals.items()])
    totals = base.groupBy(*at).agg(*[F.sum(n).alias(n) for n in vals])
    summed = sequence_window(totals, keys, order, running={r: F.col(n) for r, n in zip(running, vals)},
                             num_partitions=num_partitions)
    named = {c: f"_at{i}" for i, c in enumerate(at)}
    summed = summed.select(*[F.col(c).alias(n) for c, n in named.items()], *running)
    same = None
    for c, n in named.items():
        eq = F.col(c).eqNullSafe(F.col(n))
        same = eq if same is None else same & eq
    return df.join(summed, same).select(*df.columns, *running)


def lag_lead(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
             value: str, offset: int = 1, lag_name: str = "prev_value",
             lead_name: str = "next_value", num_partitions: int | None = None) -> DataFrame:
    """``lag``/``lead`` of ``value`` per key, distributed over range partitions."""
    return sequence_window(
        df, keys, order,
        lambda w: {lag_name: F.lag(value, offset).over(w),
                   lead_name: F.lead(value, offset).over(w)},
        back=offset, ahead=offset, num_partitions=num_partitions)


def exact_median(df: DataFrame, col: str, num_partitions: int | None = None) -> DataFrame:
    """One-row frame with the interpolated median of non-NULL ``col``.

    Unlike ``percentile``, no task holds every value: the column is range
    sorted, and only the one or two middle rows are read back.
    """
    vals = df.select(F.col(col).alias("_x")).filter(F.col("_x").isNotNull())
    idx = with_row_index(range_layout(vals, ["_x"], num_partitions))
    lo = F.expr(f"({TOTAL} + 1) div 2")
    hi = F.expr(f"{TOTAL} div 2 + 1")
    mid = idx.filter((F.col(ROW) == lo) | (F.col(ROW) == hi))
    return mid.agg(((F.min("_x") + F.max("_x")) / F.lit(2.0)).alias("median"))
