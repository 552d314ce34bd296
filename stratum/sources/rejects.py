"""CSV reading that sets malformed lines aside instead of blanking their fields (S-1, S-2).

The files are parsed once. Every line comes out as a typed row or, when it is too short, too
long or holds a value that its type does not read, as a reject with its file, raw text and
reason; ``split_csv`` stores both sides in one write, as two folders of a staging table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import read_csv_header

RAW, FILE, REASON, BAD = "_raw", "_file", "_reason", "_rejected"
ESCAPE = {"escape": '"'}


@dataclass(frozen=True)
class Split:
    """The two sides of a read; together they hold every line but the headers."""

    accepted: DataFrame
    rejected: DataFrame

    def ratio(self) -> DataFrame:
        """One row (n_accepted, n_rejected, reject_ratio), as a quality check's metrics; no line: NULL ratio."""
        n = self.accepted.agg(F.count(F.lit(1)).alias("n_accepted")).crossJoin(
            self.rejected.agg(F.count(F.lit(1)).alias("n_rejected")))  # one row each
        total = F.col("n_accepted") + F.col("n_rejected")
        return n.withColumn("reject_ratio", F.try_divide(F.col("n_rejected").cast("double"), total))


def field_count(line: Column) -> Column:
    """Fields of a CSV line: commas outside of quotes, and one."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def reasons(header: list[str], fields: dict[str, T.StructField]) -> Column:
    """Why a line was rejected: its field count, else the columns whose text their type does not read."""
    text = F.from_csv(F.col(RAW), F.lit(", ".join(f"c{i} string" for i in range(len(header)))), ESCAPE)
    wrong = F.array_compact(F.array(*[
        F.when(F.col(f"`{c}`").isNull() & text.getField(f"c{i}").isNotNull(),
               F.lit(f"{c} is no {fields[c].dataType.simpleString()}"))
        for i, c in enumerate(header) if c in fields and not isinstance(fields[c].dataType, T.StringType)]
        or [F.lit(None).cast("string")]))
    n = field_count(F.col(RAW))
    return (F.when(n < len(header), F.concat(F.lit("short: "), n.cast("string"), F.lit(f" of {len(header)} fields")))
            .when(n > len(header), F.concat(F.lit("long: "), n.cast("string"), F.lit(f" of {len(header)} fields")))
            .when(F.size(wrong) > 0, F.array_join(wrong, ", ")).otherwise(F.lit("malformed")))


def read_csv_marked(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The columns of ``schema``, ``_rejected``, ``_file``, ``_raw`` and ``_reason`` (both NULL on good rows).

    Lines are read by column name; further columns of the header are parsed and left out. A
    quoted line break ends a line here, so both of its halves are rejects. Empty lines are no rows.
    """
    fields = {f.name: f for f in (spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema).fields}
    header = read_csv_header(spark, path) or list(fields)
    missing = [c for c in fields if c not in header]
    if missing:
        raise ValueError(f"{path}: header {header} has no {missing}")
    found = T.StructType([fields.get(c, T.StructField(c, T.StringType(), True)) for c in header]
                         + [T.StructField(RAW, T.StringType(), True)])
    # every field is parsed: a pruned read would not see faults in columns left out
    rows = (spark.read.schema(found).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).option("columnPruning", False)
            .options(**ESCAPE).csv(path))
    bad = F.col(RAW).isNotNull()
    return rows.select(*[F.col(f"`{c}`") for c in fields], bad.alias(BAD),
                       F.col("_metadata.file_name").alias(FILE), F.col(RAW),
                       F.when(bad, reasons(header, fields)).alias(REASON))


def split_csv(spark: SparkSession, path: str, schema: T.StructType | str, staging: str) -> Split:
    """Parse the files once into ``staging`` and return its typed rows and its rejects (file, raw line, reason)."""
    marked = read_csv_marked(spark, path, schema)
    columns = [f"`{c}`" for c in marked.columns if c not in (BAD, FILE, RAW, REASON)]
    marked.write.mode("overwrite").partitionBy(BAD).parquet(staging)
    # the schema is given, so an empty input needs no file to take it from
    stored = spark.read.schema(marked.schema).parquet(staging)
    return Split(stored.filter(~F.col(BAD)).select(*columns),
                 stored.filter(F.col(BAD)).select(FILE, RAW, REASON))
