"""Session construction and cluster-safe scratch locations.

Nothing here hard-codes a master: on a cluster the launcher supplies it.
The defaults favour correctness (ANSI on, UTC) and scale (AQE with
partition coalescing and skew-join splitting).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in the library relies on. Shuffle partitions is only an
# initial value: AQE coalesces small partitions and splits skewed ones at run time.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    # checkpoints of frames that nothing refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "stratum", conf: dict[str, str] | None = None,
                  master: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only for tests and local benches; leave it ``None`` when the
    job is submitted to a cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only for local runs.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temp folder would not survive the
    loss of an executor, so we refuse instead of guessing.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running jobs that cut lineage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (Hadoop FileSystem summary, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def size_shuffle_partitions(spark: SparkSession, total_input_bytes: int,
                            target_bytes: int = 256 << 20, minimum: int | None = None,
                            maximum: int = 200_000) -> int:
    """Set ``spark.sql.shuffle.partitions`` to about one partition per ``target_bytes``.

    This is the initial count; AQE still coalesces small partitions and splits
    skewed ones. Compressed Parquet inflates when shuffled, so the target is a
    little above the advisory partition size. Returns the value set.
    """
    floor = minimum if minimum is not None else spark.sparkContext.defaultParallelism
    n = max(floor, min(maximum, -(-total_input_bytes // target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
