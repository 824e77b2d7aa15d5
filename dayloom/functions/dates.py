"""Date and timestamp parsing as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DMY = r"^\d{1,2}/\d{1,2}/\d{4}$"
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}$"
_COMPACT = r"^\d{8}$"
_EPOCH_DAYS = r"^-?\d{1,7}$"
_EPOCH_SECONDS = r"^-?\d+(\.\d+)?$"
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)$"

# First and last day of a four-digit year, as days since 1970-01-01.
_FIRST_DAY, _LAST_DAY = -719162, 2932896


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _guarded(text: Column, shape: str, pattern: str) -> Column:
    return F.when(text.rlike(shape), F.try_to_date(text, pattern))


def date_from_dmy(c: Column | str) -> Column:
    """``d/m/yyyy`` with one- or two-digit day and month."""
    return _guarded(_col(c), _DMY, "d/M/yyyy")


def date_from_iso(c: Column | str) -> Column:
    """``yyyy-m-d`` with one- or two-digit month and day."""
    return _guarded(_col(c), _ISO, "yyyy-M-d")


def date_from_compact(c: Column | str) -> Column:
    """``yyyymmdd``."""
    return _guarded(_col(c), _COMPACT, "yyyyMMdd")


def date_from_epoch_days(c: Column | str) -> Column:
    days = _col(c).try_cast("int")
    return F.when(days.between(_FIRST_DAY, _LAST_DAY), F.date_from_unix_date(days))


def date_from_wire(c: Column | str) -> Column:
    """Date of a message: whole days since 1970 as digits, else the first ten characters."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_EPOCH_DAYS), date_from_epoch_days(text)).otherwise(
        date_from_iso(F.substring(text, 1, 10))
    )


def date_from_year_doy(year: Column | str, doy: Column | str, strict_doy: bool = False) -> Column:
    """Year and day of year; day 366 of a common year and day 0 roll over unless strict."""
    y, d = _col(year), _col(doy)
    start = F.when(y.between(1, 9999), F.make_date(y, F.lit(1), F.lit(1)))
    number = F.unix_date(start).cast("bigint") + d.cast("bigint") - 1
    in_range = number.between(_FIRST_DAY, _LAST_DAY)
    if strict_doy:
        days_in_year = F.dayofyear(F.make_date(y, F.lit(12), F.lit(31)))
        in_range = in_range & F.when(y.between(1, 9999), d.between(F.lit(1), days_in_year))
    return F.when(in_range, F.date_from_unix_date(number.cast("int")))


def normalise_timestamp(c: Column | str) -> Column:
    """Epoch seconds, ISO with or without zone, ``... UTC``; without a zone means UTC."""
    text = F.trim(_col(c).cast("string"))
    plain = F.regexp_replace(text, r" UTC$", "Z")
    full = F.when(F.length(plain) == 10, F.concat(plain, F.lit("T00:00:00"))).otherwise(plain)
    zoned = F.when(full.rlike(r"\d{2}:\d{2}.*" + _ZONE), full).otherwise(F.concat(full, F.lit("Z")))
    return F.when(
        text.rlike(_EPOCH_SECONDS), F.timestamp_seconds(text.try_cast("decimal(20,6)"))
    ).otherwise(F.try_to_timestamp(zoned))


def within_lookback(c: Column | str, as_of: Column, days: int) -> Column:
    """True from ``as_of`` minus ``days`` to ``as_of``, both ends in."""
    return _col(c).between(F.date_sub(as_of, days), as_of)


def calendar_parts(c: Column | str) -> dict[str, Column]:
    """Day of week (1 = Sunday) and month, both as text so that models see categories."""
    day = _col(c)
    return {"dow": F.dayofweek(day).cast("string"), "mon": F.month(day).cast("string")}
