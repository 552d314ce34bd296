"""File sources: Parquet tables, CSV (typed or all-string), text logs.

All readers are lazy; nothing is counted or collected here. CSV readers take an
explicit schema so no inference job runs over the input.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The driver-provided star-schema tables.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet scan (S-3). Column pruning and filter pushdown are Catalyst's."""
    return spark.read.parquet(table_path(base, name))


class Tables:
    """Attribute access to the tables under one folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.base, name)

    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base, name)


def register_tables(spark: SparkSession, base: str, names: Iterable[str] = TABLES) -> list[str]:
    """Named-source registry (S-8): one temp view per table."""
    done = []
    for n in names:
        read_table(spark, base, n).createOrReplaceTempView(n)
        done.append(n)
    return done


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                   mode: str = "PERMISSIVE") -> DataFrame:
    """Header CSV with an explicit schema (S-1), read by column name. Doubled quotes are escapes (S14).

    Columns may stand in any order, and further ones are left out; a header without one of
    the schema's columns raises here, and files whose headers differ raise when read.
    """
    fields = (spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema).fields
    return _read_by_name(spark, path, {f.name: f for f in fields}, {"mode": mode})


def read_csv_strings(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """Every column as STRING; only the empty field is NULL, 'NA' is kept (S-2, S15)."""
    fields = {c: T.StructField(c, T.StringType(), True) for c in columns}
    return _read_by_name(spark, path, fields, {"nullValue": ""})


def _read_by_name(spark: SparkSession, path: str, fields: dict[str, T.StructField],
                  options: dict[str, str]) -> DataFrame:
    header = read_csv_header(spark, path) or list(fields)
    missing = [c for c in fields if c not in header]
    if missing:
        raise ValueError(f"{path}: header {header} has no {missing}")
    found = T.StructType([fields.get(c, T.StructField(c, T.StringType(), True)) for c in header])
    rows = (spark.read.schema(found).option("header", True).option("enforceSchema", False)
            .option("escape", '"').options(**options).csv(path))
    return rows.select(*[F.col(f"`{c}`") for c in fields])


def read_csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line only (one small read of the first line)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return []
    import csv
    return next(csv.reader([first[0][0]]))


LOG_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\s+([A-Z]+)\s+(.*)$"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Text log (S-9) -> (ts TIMESTAMP, level, message, _file, line), a row for every line.

    A line that is no ``ts level message`` has NULL ts and level, and is its own message.
    """
    raw = spark.read.text(path)
    parts = [F.regexp_extract("value", LOG_PATTERN, i) for i in (1, 2, 3)]
    return (raw.select(F.try_to_timestamp(F.nullif(parts[0], F.lit("")),
                                          F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
                       F.nullif(parts[1], F.lit("")).alias("level"),
                       F.when(F.col("value").rlike(LOG_PATTERN), parts[2]).otherwise(F.col("value")).alias("message"),
                       F.col("_metadata.file_name").alias("_file"), F.col("value").alias("line")))


def log_filter(logs: DataFrame, pattern: str, ignore_case: bool = False,
               invert: bool = False) -> DataFrame:
    """grep-like filter over whole log lines (P-18)."""
    rx = f"(?i){pattern}" if ignore_case else pattern
    pred = F.col("line").rlike(rx)
    return logs.filter(~pred if invert else pred)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Table or query from a JDBC database (S-6, H7), read in parallel.

    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    range queries in parallel instead of one full-table query on one task.
    Filters and projections applied afterwards are pushed into the SQL.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower, upper and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def newest_files(spark: SparkSession, path: str, n: int) -> list[str]:
    """The ``n`` last files below ``path`` by name (G-8), such as logs named by their time.

    Only names are read; ``n`` bounds what reaches the driver.
    """
    names = spark.read.format("binaryFile").load(path).select("path")
    last = names.orderBy(F.element_at(F.split("path", "/"), -1).desc(), "path").limit(n)
    return [r["path"] for r in last.collect()]
