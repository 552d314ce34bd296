"""All-or-nothing table replacement by a pointer (G-6, K-4).

Every published version lies in a folder of its own, which is never moved or changed. A
version becomes the table's current one by the last step alone: a numbered pointer file,
made by create-if-absent and naming the folder. Readers take the filled pointer of the
greatest number, so they see one complete version at every moment, whatever a writer was
doing when it stopped. Two writers never share a number: the one that comes second takes
the next, or, where it built on a version that is no longer current (``expect``), is told
so. A pointer that stays empty longer than ``LEASE_S`` is a stopped writer's and is passed
over.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VERSION, POINTERS = "_v-", "_pointers"
LEASE_S = 60


class StaleVersion(RuntimeError):
    """The version that a writer built on is no longer the current one."""


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already."""
    fs, p, jvm = file_system(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":  # Hadoop's local files check and create in two steps
        return jvm.java.io.File(p.toUri().getPath()).createNewFile()
    try:
        fs.create(p, False).close()
        return True
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise


def _numbers(spark: SparkSession, base: str) -> list[int]:
    """Numbers of all pointers, the newest first; there are at most ``keep`` and those in the making."""
    fs, p, _ = file_system(spark, f"{base}/{POINTERS}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _pointer(base: str, number: int) -> str:
    return f"{base}/{POINTERS}/{number:012d}"


def _folder(spark: SparkSession, base: str, number: int) -> str | None:
    """Folder that a pointer names; None while it is empty, or once it is gone."""
    fs, p, jvm = file_system(spark, _pointer(base, number))
    try:
        stream = fs.open(p)
    except Py4JJavaError:
        if fs.exists(p):
            raise
        return None
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    # the closing newline tells a whole name from one being written
    return f"{base}/{name.strip()}" if name.endswith("\n") else None


def current_version(spark: SparkSession, target: str) -> tuple[int, str] | None:
    """(number, folder) of the current version; None if nothing was published."""
    base = target.rstrip("/")
    for n in _numbers(spark, base):
        folder = _folder(spark, base, n)
        if folder:
            return n, folder
    return None


def published_path(spark: SparkSession, target: str) -> str:
    """Folder of the current version, or ``target`` itself, a table that is no published one."""
    now = current_version(spark, target)
    return now[1] if now else target


def read_published(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(published_path(spark, target))


def _point(spark: SparkSession, base: str, folder_name: str, expect: int | None) -> None:
    """Make the folder the current version, as the successor of version ``expect`` if given."""
    while True:
        numbers = _numbers(spark, base)
        if expect is not None and (current_version(spark, base) or (0,))[0] != expect:
            raise StaleVersion(f"{base}: version {expect} is no longer current")
        if expect is not None and numbers and numbers[0] > expect:
            fs, p, _ = file_system(spark, _pointer(base, numbers[0]))
            if time.time() - fs.getFileStatus(p).getModificationTime() / 1000 < LEASE_S:
                raise StaleVersion(f"{base}: another writer is replacing version {expect}")
        at = _pointer(base, (numbers[0] if numbers else 0) + 1)
        if create_if_absent(spark, at):
            fs, p, _ = file_system(spark, at)
            stream = fs.create(p, True)
            stream.write(bytearray(f"{folder_name}\n".encode()))
            stream.close()
            return


def publish(df: DataFrame, target: str, partition_cols: Sequence[str] = (),
            validate: Callable[[DataFrame, int], None] | None = None, keep: int = 2, expect: int | None = None) -> int:
    """Write ``df`` as a new version, check it, and make it the current one; returns its rows.

    ``validate(written, rows)`` may raise, which leaves the table as it was. Rows are counted
    while they are written. ``keep`` versions stay for readers that began earlier. With
    ``expect`` (the number of :func:`current_version` that ``df`` was built on, 0 for none)
    the new version is withdrawn where another one came between.
    """
    spark, base, run = df.sparkSession, target.rstrip("/"), uuid.uuid4().hex
    folder, obs = f"{base}/{VERSION}{run}", Observation(f"publish-{run}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_cols:
        # adaptive execution splits a hot value over several tasks
        writer = writer.hint("rebalance", *partition_cols).write.partitionBy(*partition_cols)
    else:
        writer = writer.write
    fs, p, _ = file_system(spark, folder)
    try:
        writer.parquet(folder)
        rows = int(obs.get["rows"])
        if validate is not None:
            validate(spark.read.parquet(folder), rows)
        _point(spark, base, f"{VERSION}{run}", expect)
    except Exception:
        fs.delete(p, True)  # no pointer names it
        raise
    _clean(spark, base, keep)
    return rows


def _clean(spark: SparkSession, base: str, keep: int) -> None:
    """Deletes all but the newest ``keep`` versions, folder before pointer."""
    for n in _numbers(spark, base)[keep:]:
        folder = _folder(spark, base, n)
        for path in filter(None, (folder, _pointer(base, n))):
            fs, p, _ = file_system(spark, path)
            fs.delete(p, True)
