"""Tolerant number parsing as plain column expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal and exponent notation only: no digit separators, type suffixes or hex.
_PLAIN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_NAN = r"(?i)^[+-]?nan$"
_INFINITE = r"(?i)^[+-]?inf(inity)?$"
_BLANKS = " \t\n\r\f\x0b"

# Fixed values of the feeds.
NULL_TOKENS = ("", ".")
MISSING_TOKEN = "-999"
MISSING_AT_OR_BELOW = -999.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_thousands(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit(""))


def strip_quotes(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit('"'))


def parse_double(c: Column | str) -> Column:
    """Text to double; ``nan`` and ``inf`` spellings are numbers here, anything else null."""
    text = F.btrim(_col(c), F.lit(_BLANKS))
    return (
        F.when(text.rlike(_PLAIN), text.try_cast("double"))
        .when(text.rlike(_NAN), F.lit(float("nan")))
        .when(
            text.rlike(_INFINITE),
            F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
        )
    )


def finite(c: Column | str) -> Column:
    """Null for NaN and the infinities (NaN sorts above every number in Spark)."""
    value = _col(c)
    return F.when(F.abs(value) <= F.lit(sys.float_info.max), value)


def safe_double(c: Column | str) -> Column:
    """Text to a finite double, otherwise null."""
    text = F.btrim(_col(c), F.lit(_BLANKS))
    return finite(F.when(text.rlike(_PLAIN), text.try_cast("double")))


def number_or_null(c: Column | str, null_tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Text to double with listed tokens as null; NaN and the infinities are kept."""
    text = _col(c)
    return F.when(~text.isin(*null_tokens), parse_double(text))


def null_if_token(c: Column | str, token: str = MISSING_TOKEN) -> Column:
    """Exact spelling of the missing marker to null, before any number parsing."""
    text = _col(c)
    return F.when(text != F.lit(token), text)


def null_if_at_or_below(c: Column | str, bound: float = MISSING_AT_OR_BELOW) -> Column:
    """Numeric missing marker to null: every value at or below ``bound``."""
    value = _col(c)
    return F.when(value > F.lit(bound), value)


def scrub_reading(c: Column | str, bound: float = MISSING_AT_OR_BELOW) -> Column:
    """A finite reading, with the numeric missing marker taken out."""
    return null_if_at_or_below(safe_double(c), bound)
