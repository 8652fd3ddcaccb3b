"""Pieces of SQL shared by the oracles."""

from __future__ import annotations


def half_up(num: str, den: str, digits: int) -> str:
    """``num / den`` of non-negative whole numbers, rounded half up in whole-number arithmetic."""
    power = 10**digits
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"CASE WHEN ({den}) <> 0 THEN CAST((2 * {n} * {power} + {d}) // (2 * {d}) AS DOUBLE) / {power} END"
    )


def cents(col: str) -> str:
    return f"CAST(CAST({col} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def with_ctes(*ctes: str, query: str) -> str:
    return f"WITH {', '.join(c.strip() for c in ctes)} {query}"
