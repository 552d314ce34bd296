"""SQL fragments shared by the oracle statements (DuckDB dialect).

They mirror :mod:`stratum.functions.numeric` exactly: money sums in
DECIMAL(18,2), quotients in DOUBLE, rounding as floor(x * 10^d + 0.5) / 10^d in DOUBLE.
"""

from __future__ import annotations


def r(x: str, digits: int) -> str:
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(floor(CAST(({x}) AS DOUBLE) * {scale} + CAST(0.5 AS DOUBLE)) / {scale})"


def money_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({money_sum(x)} / CAST(COUNT({x}) AS DOUBLE))"


def pct(num: str, den: str, digits: int = 1) -> str:
    return r(f"CAST({num} AS DOUBLE) * 100.0 / CAST({den} AS DOUBLE)", digits)


def flag(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def cnt(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"
