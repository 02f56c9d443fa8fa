"""The same helpers as SQL expression text, for wide projections.

A projection of many computed columns written with Column objects costs one
driver round trip per operation while the plan is built; the same projection
as ``selectExpr`` text is parsed in the JVM in one call. These functions
produce the SQL for the rules of ``text``, ``dates`` and ``numbers``.
"""

from __future__ import annotations


def lit(s: str | None) -> str:
    """SQL string literal (NULL for None)."""
    if s is None:
        return "CAST(NULL AS STRING)"
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def otrim(x: str) -> str:
    return f"NULLIF(TRIM({x}), '')"


def ocat(*parts: str) -> str:
    """``||`` with NULL operands as empty; parts are SQL expressions."""
    return f"NULLIF(concat_ws('', {', '.join(f'CAST({p} AS STRING)' for p in parts)}), '')"


def fit(x: str, n: int) -> str:
    return f"substring(CAST({x} AS STRING), 1, {n})"


def code_eq(x: str, value: str) -> str:
    return f"(rtrim({x}) = {lit(value)})"


def decode_cyyddd(x: str) -> str:
    return (f"date_add(make_date(1900 + CAST(floor(CAST({x} AS INT) / 1000) AS INT), 1, 1), "
            f"CAST(CAST({x} AS INT) % 1000 - 1 AS INT))")


def amount(x: str) -> str:
    """Integer cents / 100 as an exact decimal(20,2)."""
    return f"CAST(CAST({x} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(20,2))"


MONEY = "DECIMAL(38,4)"
PERCENT = "DECIMAL(10,4)"
