"""Run parameters.

The source query keeps six hand-typed literals (date from/to, encoded
from/to, fiscal year, period) that can drift apart. Here only the date range
is given; everything else is derived from it.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from ..functions.dates import encode_date


@dataclass(frozen=True)
class PeriodParams:
    """Half-open date range ``[date_from, date_to)``, normally one month."""

    date_from: _dt.date
    date_to: _dt.date
    # Offset subtracted from the calendar year to get the balance table's
    # fiscal year (GBFY). The source query uses year - 1900; a different
    # encoding of that column only needs a different offset.
    fiscal_year_offset: int = 1900

    def __post_init__(self):
        if self.date_to <= self.date_from:
            raise ValueError("date_to must be after date_from")

    @classmethod
    def month(cls, year: int, month: int, **kw) -> "PeriodParams":
        start = _dt.date(year, month, 1)
        end = _dt.date(year + (month == 12), month % 12 + 1, 1)
        return cls(start, end, **kw)

    @property
    def jul_from(self) -> int:
        return encode_date(self.date_from)

    @property
    def jul_to(self) -> int:
        """Last included day, encoded (the source's JUL_FIM)."""
        return encode_date(self.date_to - _dt.timedelta(days=1))

    @property
    def fiscal_year(self) -> int:
        return self.date_from.year - self.fiscal_year_offset

    @property
    def period(self) -> int:
        return self.date_from.month

    def months(self) -> list[tuple[int, int]]:
        """(calendar year, month) of every month with a day in the range; a range that
        starts mid-month holds that month's balance, as in the source (its period is the
        start date's month)."""
        out = []
        y, m = self.date_from.year, self.date_from.month
        while _dt.date(y, m, 1) < self.date_to:
            out.append((y, m))
            y, m = (y + 1, 1) if m == 12 else (y, m + 1)
        return out


@dataclass(frozen=True)
class DetailParams:
    """Open-ended (or bounded) range for the journal-detail ledger."""

    since: _dt.date
    until: _dt.date | None = None

    @property
    def jul_from(self) -> int:
        return encode_date(self.since)

    @property
    def jul_to(self) -> int | None:
        return None if self.until is None else encode_date(self.until - _dt.timedelta(days=1))
