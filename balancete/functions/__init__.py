from .dates import decode_cyyddd, encode_cyyddd, encode_date, decode_int, month_key
from .numbers import (AMOUNT, CENTS, MONEY, PERCENT, RATE, apply_rate,
                      cents_to_amount, parse_percent, to_money)
from .text import (blank_key, code_eq, code_in, code_not_in, fit, not_in_or_null,
                   ocat, otrim, trimmed_not_in)

__all__ = [
    "decode_cyyddd", "encode_cyyddd", "encode_date", "decode_int", "month_key",
    "AMOUNT", "CENTS", "MONEY", "PERCENT", "RATE", "apply_rate", "cents_to_amount",
    "parse_percent", "to_money", "blank_key", "code_eq", "code_in", "code_not_in",
    "fit", "not_in_or_null", "ocat", "otrim", "trimmed_not_in",
]
