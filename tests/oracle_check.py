"""Run a catalogue query on Spark and its SQL on DuckDB; compare exactly.

Columns are compared by name (sorted), rows as multisets, values exactly
(floats included), and Spark/DuckDB types through a small equivalence map.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal

import duckdb

from stratum.sources.files import TABLES, table_path

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT",
}


def duck(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(base, t)}')")
    return con


def _norm(v):
    if isinstance(v, float) and v != v:
        return "NaN"
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()) if v == v else "NaN")
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _spark_type(dtype) -> str:
    s = dtype.simpleString()
    if s.startswith("decimal"):
        return "DECIMAL" + s[len("decimal"):]
    return SPARK_TO_DUCK.get(s, s.upper())


def compare(spark_df, con, sql: str) -> list[str]:
    """Return a list of problems (empty when the results match)."""
    problems = []
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = {d[0]: str(d[1]) for d in rel.description}
    s_cols = spark_df.columns
    if sorted(s_cols) != sorted(d_cols):
        return [f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"]
    s_types = {f.name: _spark_type(f.dataType) for f in spark_df.schema.fields}
    for c in s_cols:
        if s_types[c] != d_types[c]:
            problems.append(f"type {c}: spark={s_types[c]} duck={d_types[c]}")
    s_rows = spark_df.collect()
    order = sorted(s_cols)
    s_idx = [s_cols.index(c) for c in order]
    d_idx = [d_cols.index(c) for c in order]
    sc = collections.Counter(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
    dc = collections.Counter(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} duck={len(d_rows)}")
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        problems.append(f"values differ ({sum((sc - dc).values())} rows); cols={order}; "
                        f"spark-only={only_s} duck-only={only_d}")
    return problems


def compare_pandas(spark_df, con, sql: str) -> list[str]:
    """The same check through pandas (``toPandas`` vs DuckDB ``df()``), values as text.

    Catches type choices that convert differently on the two sides (DATE,
    DECIMAL, NULL integers) even when the Python row values agree.
    """
    def norm(df):
        df = df[sorted(df.columns)].astype(str)
        return sorted(map(tuple, df.values.tolist()))
    a, b = norm(spark_df.toPandas()), norm(con.execute(sql).df())
    if a == b:
        return []
    only_a = [x for x in a if x not in set(b)][:2]
    only_b = [x for x in b if x not in set(a)][:2]
    return [f"pandas text differs: spark-only={only_a} duck-only={only_b}"]
