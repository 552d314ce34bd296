"""A small model graph: named sources, models with dependencies, tests (S-8, K-5).

Models are functions ``fn(**upstream) -> DataFrame``. ``run`` executes them in
dependency order; a ``view`` model is a lazy temp view, a ``table`` model is
published to Parquet (staged, validated, swapped) and re-read, which also cuts
the lineage for everything downstream. Tests are functions returning failing
rows; all test counts of a run come back in one small frame.
"""

from __future__ import annotations

import graphlib
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import test_unique
from .versions import publish, read_published


class ModelFailures(RuntimeError):
    """Nodes that failed, and their descendants that were left out."""

    def __init__(self, failed: dict[str, Exception], skipped: list[str]):
        self.failed, self.skipped = failed, skipped
        super().__init__(f"failed: {sorted(failed)}, left out: {skipped}")


TestFn = Callable[[DataFrame], DataFrame]


def column_tests(rules: Mapping[str, Sequence]) -> dict[str, TestFn | Column]:
    """Declared tests by column: ``"unique"``, ``"not_null"``, or a list of accepted values.

    Row conditions come back as columns (true on a failing row), which a run counts in one
    aggregate per model; uniqueness needs a grouping of its own.
    """
    out: dict[str, TestFn | Column] = {}
    for name, tests in rules.items():
        for t in tests:
            if t == "unique":
                out[f"unique_{name}"] = lambda d, name=name: test_unique(d.filter(F.col(name).isNotNull()), [name])
            elif t == "not_null":
                out[f"not_null_{name}"] = F.col(name).isNull()
            else:
                out[f"accepted_{name}"] = F.col(name).isNotNull() & ~F.col(name).isin(list(t))
    return out


@dataclass
class Model:
    name: str
    fn: Callable[..., DataFrame]
    deps: tuple[str, ...]
    materialize: str = "view"
    partition_by: tuple[str, ...] = ()
    tests: dict[str, TestFn | Column] = field(default_factory=dict)


class Project:
    def __init__(self, spark: SparkSession, target_dir: str | None = None):
        self.spark = spark
        self.target_dir = target_dir
        self.sources: dict[str, Callable[[], DataFrame]] = {}
        self.models: dict[str, Model] = {}
        self.frames: dict[str, DataFrame] = {}

    # ------------------------------------------------------------ declaration
    def source(self, name: str, loader: Callable[[], DataFrame]) -> None:
        if name in self.sources or name in self.models:
            raise ValueError(f"duplicate node {name}")
        self.sources[name] = loader

    def model(self, name: str, deps: Sequence[str] = (), materialize: str = "view",
              partition_by: Sequence[str] = (), tests: dict[str, TestFn | Column] | None = None):
        if materialize not in ("view", "table"):
            raise ValueError("materialize must be 'view' or 'table'")

        def deco(fn):
            if name in self.sources or name in self.models:
                raise ValueError(f"duplicate node {name}")
            self.models[name] = Model(name, fn, tuple(deps), materialize, tuple(partition_by),
                                      dict(tests or {}))
            return fn
        return deco

    def add_test(self, model: str, name: str, fn: TestFn | Column) -> None:
        self.models[model].tests[name] = fn

    # ------------------------------------------------------------ execution
    def order(self) -> list[str]:
        graph = {m.name: set(m.deps) for m in self.models.values()}
        for name in self.sources:
            graph.setdefault(name, set())
        unknown = {d for deps in graph.values() for d in deps} - set(graph)
        if unknown:
            raise KeyError(f"unknown dependencies: {sorted(unknown)}")
        return list(graphlib.TopologicalSorter(graph).static_order())

    def _build(self, name: str) -> DataFrame:
        if name in self.sources:
            return self.sources[name]()
        m = self.models[name]
        df = m.fn(**{d: self.frames[d] for d in m.deps})
        if m.materialize == "table":
            if not self.target_dir:
                raise ValueError("table models need a target_dir")
            path = f"{self.target_dir.rstrip('/')}/{name}"
            publish(df, path, m.partition_by)
            df = read_published(self.spark, path)
        return df

    def run(self, threads: int = 1) -> dict[str, DataFrame]:
        """Build all nodes, up to ``threads`` independent ones at once, each in a pool of its own.

        With more than one thread a failing node stops its descendants only: the others are
        built, and then ``ModelFailures`` names what failed and what was left out. Pools share
        the executors evenly where ``spark.scheduler.mode`` is FAIR.
        """
        if threads <= 1:
            for name in self.order():
                self._keep(name, self._build(name))
            return self.frames
        self.order()  # names unknown dependencies before anything is built
        graph = graphlib.TopologicalSorter({**{n: () for n in self.sources}, **{m.name: m.deps for m in self.models.values()}})
        graph.prepare()
        failed: dict[str, Exception] = {}
        skipped, running = set(), {}

        def build(name: str) -> DataFrame:
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            return self._build(name)

        with ThreadPoolExecutor(threads) as pool:
            while graph.is_active():
                for name in graph.get_ready():
                    deps = self.models[name].deps if name in self.models else ()
                    if any(d in failed or d in skipped for d in deps):
                        skipped.add(name)
                        graph.done(name)
                    else:
                        running[pool.submit(inheritable_thread_target(self.spark)(build), name)] = name
                if not running:
                    continue
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(future)
                    if future.exception():
                        failed[name] = future.exception()
                    else:
                        self._keep(name, future.result())
                    graph.done(name)
        if failed:
            raise ModelFailures(failed, sorted(skipped))
        return self.frames

    def _keep(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)
        self.frames[name] = df

    def test(self) -> DataFrame:
        """(model, test_name, failures) for every test, as one frame.

        The row conditions of a model are counted in one aggregate, hence one scan.
        """
        out = None
        for m in self.models.values():
            rows = {n: c for n, c in m.tests.items() if isinstance(c, Column)}
            if rows:
                counts = self.frames[m.name].agg(*[F.count_if(c).alias(n) for n, c in rows.items()]).unpivot(
                    [], list(rows), "test_name", "failures").select(F.lit(m.name).alias("model"), "test_name", "failures")
                out = counts if out is None else out.unionByName(counts)
            for tname, fn in m.tests.items():
                if tname in rows:
                    continue
                row = fn(self.frames[m.name]).agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(m.name).alias("model"), F.lit(tname).alias("test_name"), "failures")
                out = row if out is None else out.unionByName(row)
        if out is None:
            return self.spark.createDataFrame([], "model string, test_name string, failures bigint")
        return out
