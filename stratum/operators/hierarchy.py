"""Hierarchy walks over adjacency lists (R-1, R-2, J-1).

``walk_tree`` is a frontier loop: each level is one distributed join of the
current frontier with the edge table, so a level with millions of nodes is
still just a join. Each level is checkpointed, which keeps plans (and recovery
after an executor loss) short. A ``max_depth`` guard stops cycles, which the
recursive SQL form would follow until its own limit.

``walk_paths`` walks whole trees by doubling: every inner node's pointer to an ancestor
is joined with the table of pointers itself, so a depth of d takes log2 d rounds, whatever
the number of levels; leaves meet their parent's path once, at the end.

``walk_tree_sql`` is the same walk as one ``WITH RECURSIVE`` statement (Spark
4.1), handy for small trees and for parity with SQL-first users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, row_bytes, sized_broadcast


CYCLE_CHECK_DEPTH = 256


def _materialise(df: DataFrame, which: Column | None = None) -> tuple[DataFrame, int, int]:
    """Checkpoint ``df``; the number and bytes of its rows (or of ``which``) come from the same job."""
    obs = Observation()
    of = which if which is not None else F.lit(True)
    done = df.observe(obs, F.count_if(of).alias("n"),
                      F.sum(F.when(of, row_bytes(df.schema))).alias("bytes")).checkpoint(eager=True)
    return done, int(obs.get["n"] or 0), int(obs.get["bytes"] or 0)


def walk_tree(edges: DataFrame, node: str, parent: str, label: str,
              separator: str = " → ", max_depth: int | None = None,
              roots: DataFrame | None = None,
              broadcast_rows: int = BROADCAST_MAX_ROWS,
              broadcast_bytes: int = BROADCAST_MAX_BYTES,
              on_limit: str = "raise") -> DataFrame:
    """Walk from roots (``parent`` IS NULL, or ``roots``) down to every descendant.

    Returns the edge columns plus ``depth`` (root = 0) and ``path`` (labels
    joined by ``separator``). By default depth is not limited; a walk longer than
    the table has edges is a cycle and raises. With ``max_depth``, rows below it
    raise too, unless ``on_limit="stop"`` asks for a depth-limited walk.

    The edges are checkpointed once (the root count observed in the same job),
    so the (possibly expensive) edge derivation is not recomputed per level.
    Each level's frontier is
    checkpointed too, its rows and bytes observed in the same job; when both
    are small the frontier is broadcast, so the child
    table is streamed without a shuffle and a parent with a huge fan-out is no
    hotter than any other rows. A large frontier takes a shuffle join, where
    AQE splits skewed partitions.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    if roots is None:
        # one job: checkpoint the edges and count the roots while writing them
        edges, size, held = _materialise(edges, F.col(parent).isNull())
        start = edges.filter(F.col(parent).isNull())
    else:
        edges = edges.checkpoint(eager=True)
        start, size, held = roots, None, 0
    frontier = start.select(*edges.columns, F.lit(0).alias("depth"),
                            F.col(label).cast("string").alias("path"))
    if size is None:
        frontier, size, held = _materialise(frontier)
    children = edges.filter(F.col(parent).isNotNull())
    levels = [frontier]
    depth, limit = 0, max_depth
    while size:
        if limit is None and depth == CYCLE_CHECK_DEPTH:
            # no path without a cycle is longer than the number of edges
            limit = edges.count()
        if limit is not None and depth >= limit:
            break
        depth += 1
        step = frontier.select(F.col(node).alias("_up"), F.col("path").alias("_path"))
        if size <= broadcast_rows and held <= broadcast_bytes:  # the level's size is known
            step = F.broadcast(step)
        frontier, size, held = _materialise(
            children.join(step, children[parent] == step["_up"], "inner")
                    .select(*[children[c] for c in edges.columns],
                            F.lit(depth).alias("depth"),
                            F.concat(F.col("_path"), F.lit(separator),
                                     F.col(label).cast("string")).alias("path")))
        if size:
            levels.append(frontier)
    if size and on_limit != "stop":
        below = children.join(frontier.select(F.col(node).alias("_up")),
                              children[parent] == F.col("_up"), "left_semi")
        if not below.isEmpty():
            raise RecursionError(f"tree walk has rows below max_depth={limit} "
                                 "(a cycle or a deeper tree); raise max_depth or pass "
                                 "on_limit='stop'")
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def walk_paths(edges: DataFrame, node: str, parent: str, label: str | None = None,
               separator: str = " → ") -> DataFrame:
    """The edge columns, ``depth`` (root = 0) and, with ``label``, ``path`` of every node below a root.

    A root has no ``parent``. Rows whose line of parents ends at a node that is not there are
    left out, as the walk from the roots never meets them; a circle raises, and its nodes are
    named. Pointers are kept for nodes with children only, one checkpoint a round; a parent
    with a great many children is one row of the side that its children are joined with, so
    adaptive execution may split them.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    text = F.col(label).cast("string") if label else F.lit(None).cast("string")
    open_, closed = F.col("__up").isNotNull(), F.col("__up").isNull()
    inner = edges.select(F.col(parent).alias("__is")).filter("__is is not null").distinct()
    at = edges.join(inner, F.col(node) == F.col("__is"), "left_semi").select(
        F.col(node).alias("__node"), F.col(parent).alias("__up"), text.alias("__path"), F.lit(0).alias("__depth")).checkpoint()
    size, span = at.count(), 1
    done, at = at.filter(closed), at.filter(open_)
    while not at.isEmpty():
        if span > size:  # no line of parents is longer than there are nodes
            met = [str(r[0]) for r in at.select("__up").distinct().orderBy("__up").limit(20).collect()]
            raise RecursionError(f"circle of parents through {', '.join(met)}{' ...' if len(met) == 20 else ''}")
        far = at.unionByName(done)
        far = far.select(*[F.col(c).alias("__far" + c) for c in far.columns])
        # a finished line has no pointer; __depth counts the steps that the path spans
        both = at.join(far, F.col("__up") == F.col("__far__node")).select(
            "__node", F.col("__far__up").alias("__up"),
            F.concat(F.col("__far__path"), F.lit(separator), "__path").alias("__path"),
            (F.col("__depth") + F.col("__far__depth") + 1).alias("__depth")).checkpoint()
        done, at, span = done.unionByName(both.filter(closed)), both.filter(open_), span * 2
    extra = [F.lit(0).alias("depth"), *([text.alias("path")] if label else [])]
    roots = edges.filter(F.col(parent).isNull()).select(*edges.columns, *extra)
    above = sized_broadcast(done.select("__node", "__path", "__depth"))
    below = edges.filter(F.col(parent).isNotNull()).join(above, F.col(parent) == F.col("__node")).select(
        *edges.columns, (F.col("__depth") + 1).alias("depth"),
        *([F.concat(F.col("__path"), F.lit(separator), text).alias("path")] if label else []))
    return roots.unionByName(below)


def walk_tree_sql(spark, edges_view: str, node: str, parent: str, label: str,
                  separator: str = " → ", max_level: int = 100) -> DataFrame:
    """``WITH RECURSIVE`` form over a registered view."""
    return spark.sql(f"""
        WITH RECURSIVE walk MAX RECURSION LEVEL {int(max_level)} AS (
            SELECT e.*, 0 AS depth, CAST(e.{label} AS STRING) AS path
            FROM {edges_view} e WHERE e.{parent} IS NULL
            UNION ALL
            SELECT e.*, w.depth + 1, w.path || :sep || CAST(e.{label} AS STRING)
            FROM {edges_view} e JOIN walk w ON e.{parent} = w.{node}
        )
        SELECT * FROM walk""", args={"sep": separator})
