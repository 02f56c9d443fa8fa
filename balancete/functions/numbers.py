"""Money and percentage helpers.

Money is exact decimal end to end: integer cents ``decimal(20,0)`` become
``decimal(20,2)`` amounts, and ledger values are ``decimal(38,4)``. No double
ever enters a union, so no column silently turns into a double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .text import ColumnOrName, _c, otrim

CENTS = DecimalType(20, 0)
AMOUNT = DecimalType(20, 2)
MONEY = DecimalType(38, 4)
# A rate keeps 14 integer and 12 decimal digits; only the product is rounded.
RATE = DecimalType(26, 12)
PERCENT = DecimalType(10, 4)

# FIXED VALUE (must equal the source): accepted shapes of a percentage text:
# digits, optional decimal part with '.' or ',', optional trailing '%'.
PERCENT_PATTERN = r"^[0-9]+([.,][0-9]+)?%?$"


def cents_to_amount(c: ColumnOrName) -> Column:
    """Integer cents / 100 as an exact decimal(20,2)."""
    return (_c(c).cast(CENTS) * F.lit(Decimal("0.01"))).cast(AMOUNT)


def to_money(c: ColumnOrName) -> Column:
    return _c(c).cast(MONEY)


def parse_percent(c: ColumnOrName) -> Column:
    """Percentage text -> decimal, NULL when the text is not a percentage.

    '20' -> 20, '20,5' -> 20.5, '20%' -> 20, ' 7.25% ' -> 7.25; blank, NULL,
    'x', '1.2.3' and '-5' -> NULL. A percentage that RATE cannot hold in full (over 14
    integer or 12 decimal digits, leading and trailing zeros aside) raises.
    """
    t = F.trim(_c(c))
    cleaned = F.replace(F.replace(t, F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    fits = cleaned.rlike(r"^0*[0-9]{1,14}([.][0-9]{1,12}0*)?$")
    return F.when(F.coalesce(otrim(c), F.lit("x")).rlike(PERCENT_PATTERN),
                  F.when(fits, cleaned.try_cast(RATE))
                  .otherwise(F.raise_error(F.concat(F.lit("percentage out of range: "), t)).cast(RATE)))


def apply_rate(amount: ColumnOrName, rate: ColumnOrName) -> Column:
    """``ROUND(amount * rate / 100, 4)`` in exact decimals, as money.

    The integer part of the rate is multiplied apart: its product has four
    decimals at most and needs no rounding, and neither product passes 38 digits.
    """
    a, r = _c(amount).cast(AMOUNT), _c(rate).cast(RATE)
    whole = F.floor(r).cast("decimal(14,0)")
    part = (r - whole).cast("decimal(12,12)")
    cent = F.lit(Decimal("0.01"))
    return (a * whole * cent + F.round(a * part * cent, 4)).cast(MONEY)
