"""String helpers that reproduce the source dialect's blank/NULL rules.

The ledger queries were written for a dialect where an empty string *is*
NULL and ``||`` skips NULL operands. Spark keeps ``''`` distinct from NULL and
its ``concat`` propagates NULL, so every use goes through these helpers
(SURVEY §1.5, rules B1-B8).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def otrim(c: ColumnOrName) -> Column:
    """TRIM whose empty result is NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def ocat(*parts: Column | str) -> Column:
    """``a || b || ...`` where NULL operands count as empty.

    Python strings are literals, Columns are columns (pass ``F.col(name)``).
    Non-string columns are rendered with ``CAST(... AS STRING)``. An empty
    result is NULL, as in the source dialect.
    """
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.nullif(F.concat_ws("", *cols), F.lit(""))


def fit(c: ColumnOrName, n: int) -> Column:
    """``CAST(x AS VARCHAR2(n))``: keep the first n characters."""
    return F.substring(_c(c).cast("string"), 1, n)


def code_eq(c: ColumnOrName, value: str) -> Column:
    """Fixed-width code equality: trailing blanks are ignored.

    The stored column keeps its padding (B8); only the comparison is trimmed.
    The ``startswith`` beside it says nothing more, but reaches the Parquet scan.
    """
    return _c(c).startswith(value) & (F.rtrim(_c(c)) == F.lit(value))


def code_in(c: ColumnOrName, values: Iterable[str]) -> Column:
    """``code IN (...)`` ignoring trailing blanks; NULL stays unknown.

    As in ``code_eq``, prefixes stand beside the test for the scan.
    """
    values = list(values)
    prefix = reduce(lambda a, b: a | b, [_c(c).startswith(v) for v in values])
    return prefix & F.rtrim(_c(c)).isin(values)


def code_not_in(c: ColumnOrName, values: Iterable[str]) -> Column:
    """``code NOT IN (...)``; a NULL code is dropped, as SQL does."""
    return ~F.rtrim(_c(c)).isin(list(values))


def not_in_or_null(c: ColumnOrName, values: Iterable[str], sentinel: str = "§§") -> Column:
    """``NVL(TRIM(x), sentinel) NOT IN (...)``: NULL or blank *passes*."""
    return ~F.coalesce(otrim(c), F.lit(sentinel)).isin(list(values))


def trimmed_not_in(c: ColumnOrName, values: Iterable[str]) -> Column:
    """``TRIM(x) NOT IN (...)``: a blank x is NULL, so the row is dropped (B2)."""
    return ~otrim(c).isin(list(values))


def blank_key(c: ColumnOrName) -> Column:
    """Join key on which blank never matches blank (B1)."""
    return otrim(c)
