"""Encoded-date codec and calendar helpers.

ERP dates are stored as integers ``CYYDDD``: C = centuries after 1900,
YY = year in century, DDD = day of year. 116031 is 2016-01-31 and
99365 is 1999-12-31. Decoding is arithmetic, so both 5- and 6-digit codes
work and the result stays a ``DateType`` that Parquet filters understand.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c


def decode_cyyddd(c: ColumnOrName) -> Column:
    """Integer CYYDDD -> date."""
    n = _c(c).cast("int")
    year = F.lit(1900) + F.floor(n / 1000).cast("int")
    day = (n % 1000) - 1
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day)


def encode_cyyddd(c: ColumnOrName) -> Column:
    """Date (or timestamp) -> integer CYYDDD."""
    d = _c(c).cast("date")
    return ((F.year(d) - 1900) * 1000 + F.dayofyear(d)).cast("int")


def encode_date(d: _dt.date) -> int:
    """Python-side encoder for parameters (literals pushed to Parquet)."""
    return (d.year - 1900) * 1000 + d.timetuple().tm_yday


def decode_int(n: int) -> _dt.date:
    return _dt.date(1900 + n // 1000, 1, 1) + _dt.timedelta(days=n % 1000 - 1)


def month_key(c: ColumnOrName) -> Column:
    """``TO_CHAR(d, 'YYYY-MM')``."""
    return F.date_format(_c(c), "yyyy-MM")
