from dayloom.functions.dates import (
    calendar_parts,
    date_from_compact,
    date_from_dmy,
    date_from_epoch_days,
    date_from_iso,
    date_from_wire,
    date_from_year_doy,
    normalise_timestamp,
    within_lookback,
)
from dayloom.functions.numbers import (
    finite,
    null_if_at_or_below,
    null_if_token,
    number_or_null,
    parse_double,
    safe_double,
    scrub_reading,
    strip_quotes,
    strip_thousands,
)
from dayloom.functions.once import compute_once

__all__ = [
    "calendar_parts",
    "compute_once",
    "date_from_compact",
    "date_from_dmy",
    "date_from_epoch_days",
    "date_from_iso",
    "date_from_wire",
    "date_from_year_doy",
    "finite",
    "normalise_timestamp",
    "null_if_at_or_below",
    "null_if_token",
    "number_or_null",
    "parse_double",
    "safe_double",
    "scrub_reading",
    "strip_quotes",
    "strip_thousands",
    "within_lookback",
]
