"""Small SQL text helpers for writing the DuckDB oracle twins."""

from __future__ import annotations


def D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def FS(x: str) -> str:
    """pandas-style sum as double."""
    return f"CAST(COALESCE(SUM({x}), 0) AS DOUBLE)"


def MEAN(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / CAST(COUNT({x}) AS DOUBLE)"


def PCT(a: str, b: str) -> str:
    return f"{D(a)} / NULLIF({D(b)}, 0) * 100.0"


def EDGE_BINS(x: str, lo: str, w: str, bins: int) -> str:
    parts = " + ".join(f"(CASE WHEN {x} > CAST({j} AS DOUBLE) * {w} + {lo} THEN 1 ELSE 0 END)"
                       for j in range(1, bins))
    return f"(1 + {parts})"


def TRIM_WS(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def QUANT(xs: str, n: str, p: float, midpoint_median: bool = False) -> str:
    """numpy-linear quantile from a sorted list ``xs`` of ``n`` values."""
    pos = f"(CAST({n} - 1 AS DOUBLE) * {float(p)})"
    a = f"{xs}[CAST(FLOOR({pos}) AS BIGINT) + 1]"
    b = f"{xs}[CAST(CEIL({pos}) AS BIGINT) + 1]"
    t = f"({pos} - FLOOR({pos}))"
    mid = f"WHEN {a} IS NOT NULL AND {float(p)} = 0.5 THEN ({a} + {b}) / 2.0 " if midpoint_median else ""
    return (f"(CASE WHEN FLOOR({pos}) = CEIL({pos}) THEN {a} {mid}"
            f"WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * (1.0 - {t}) "
            f"ELSE {a} + ({b} - {a}) * {t} END)")
