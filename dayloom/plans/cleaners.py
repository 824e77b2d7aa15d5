"""The three batch cleaners: raw input to curated rows and quarantine rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.functions import (
    compute_once,
    date_from_dmy,
    date_from_iso,
    date_from_year_doy,
    null_if_at_or_below,
    number_or_null,
    parse_double,
    safe_double,
    strip_thousands,
)
from dayloom.functions.numbers import finite
from dayloom.operators.dedup import dedup
from dayloom.operators.quality import (
    Rule,
    apply_rules,
    assert_complete,
    quarantine_union,
    require_complete,
    rule_date,
    rule_date_range,
    rule_malformed,
    rule_finite,
    rule_number,
    rule_positive,
    rule_present,
    split,
    to_quarantine,
)
from dayloom.schemas import FIRST_VALID_DAY, LAST_VALID_DAY
from dayloom.session import scratch_path
from dayloom.sources.documents import explode_records
from dayloom.sources.lines import parse_csv_line, parse_plain_line
from dayloom.sources.tables import read_marked, remove_path, write_curated, write_marked

# Columns with this prefix hold the text a value was read from.
RAW = "_raw_"


def settle(
    valid: DataFrame,
    invalid: DataFrame,
    values: tuple[str, ...],
    policy: str,
    order: list[str] | None = None,
    reason_date: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Duplicate handling by date: curated rows, and quarantine rows of both causes.

    Quarantine rows show the raw text where the frame has it, since that is easier to
    repair than a half-parsed value.
    """
    kept, repeated = dedup(valid, ["date"], policy, list(order or []), reason_date)
    rejected = quarantine_union(invalid, repeated.select(invalid.columns))
    shown = [
        F.col(f"{RAW}{c}" if f"{RAW}{c}" in rejected.columns else c).alias(c)
        for c in ("date", *values)
    ]
    return kept.select("date", *values), to_quarantine(rejected.select(*shown, "errors"))


def run_cleaner(
    spark: SparkSession, judged: DataFrame, curated: str, quarantine: str, **settling
) -> None:
    """Replaces the curated and the quarantine table of a feed.

    The judged rows are written once, split by the flag; both tables are made from that
    copy, so the raw text is read and parsed a single time. A kept row without a date or a
    value ends the job before anything is replaced. The copy is removed at the end.
    """
    staged = scratch_path(spark, "judged")
    write_marked(judged, staged)
    sides = [read_marked(spark, staged, flag) for flag in (True, False)]
    kept, rejected = settle(sides[0].drop("errors"), sides[1], **settling)
    checked = scratch_path(spark, "checked")
    try:
        # Written aside first: a failed check leaves the curated table as it is.
        write_curated(assert_complete(kept, ["date", *settling["values"]]), checked)
        write_curated(spark.read.schema(kept.schema).parquet(checked), curated)
        write_curated(rejected, quarantine)
    finally:
        remove_path(spark, staged)
        remove_path(spark, checked)


def judge_price_lines(
    lines: DataFrame,
    line: str = "line",
    value: str = "price_a",
    label: str = "Euro_Price",
    pick: tuple[int, int] = (0, 4),
    keep: tuple[str, ...] = (),
    allow_non_finite: bool = False,
) -> DataFrame:
    """Quoted CSV lines to date and price, with the reasons against each line."""
    to_number = parse_double if allow_non_finite else safe_double
    record = parse_csv_line(line, {"date": pick[0], "value": pick[1]})
    parsed = compute_once(lines.select(*keep, line), {"_record": record})
    typed = compute_once(
        parsed,
        {
            f"{RAW}date": F.coalesce(F.col("_record.date"), F.col(line)),
            f"{RAW}{value}": F.col("_record.value"),
            "date": date_from_dmy("_record.date"),
            value: to_number(strip_thousands("_record.value")),
        },
    )
    readable = F.col("_record").isNotNull()
    rules = [
        rule_date(f"{RAW}date", "date", echo=True),
        rule_number(value, label),
        rule_positive(value, label),
    ]
    judged = apply_rules(
        typed,
        [rule_malformed("_record"), *[Rule(readable & r.bad_when, r.message) for r in rules]],
    )
    return judged.drop("_record", line)


def clean_price_lines(
    lines: DataFrame,
    line: str = "line",
    value: str = "price_a",
    label: str = "Euro_Price",
    pick: tuple[int, int] = (0, 4),
    order: list[str] | None = None,
    allow_non_finite: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Quoted CSV prices. One row per date is kept, in ``order``; the rest are rejected."""
    order = list(order or [])
    judged = judge_price_lines(lines, line, value, label, pick, tuple(order), allow_non_finite)
    return settle(*split(judged), (value,), "keep_first", [*order, value], "date")


def judge_observations(
    documents: DataFrame,
    records: str = "observations",
    value: str = "price_b",
    label: str = "Brent_Price",
    lo: dt.date = FIRST_VALID_DAY,
    hi: dt.date = LAST_VALID_DAY,
    allow_non_finite: bool = False,
) -> DataFrame:
    """Documents of observations to rows, with the reasons against each row.

    NaN and the infinities are numbers that no price has; they are rejected as invalid.
    """
    raw = explode_records(documents, records)
    typed = compute_once(
        raw.select(F.col("date").alias(f"{RAW}date"), F.col("value").alias(f"{RAW}{value}")),
        {
            "date": date_from_iso(f"{RAW}date"),
            value: number_or_null(f"{RAW}{value}", (".",)),
        },
    )
    rules = [
        rule_date_range("date", lo, hi),
        rule_date(f"{RAW}date", "date"),
        rule_present(value, label),
    ]
    if not allow_non_finite:
        rules.append(rule_finite(value, label))
    return apply_rules(typed, rules)


def clean_observations(
    documents: DataFrame, records: str = "observations", value: str = "price_b", **options
) -> tuple[DataFrame, DataFrame]:
    """Documents of observations. A date that occurs twice is rejected with all its rows."""
    judged = judge_observations(documents, records, value, **options)
    return settle(*split(judged), (value,), "reject_all", reason_date="date")


def to_dated_rows(
    df: DataFrame,
    year: str = "year",
    doy: str = "doy",
    values: tuple[str, ...] = ("precipitation", "soil_moisture"),
    strict_doy: bool = False,
) -> DataFrame:
    """Year and day of year to a date; rows for which no date exists are left out."""
    dated = df.select(date_from_year_doy(year, doy, strict_doy).alias("date"), *values)
    return dated.filter(F.col("date").isNotNull())


def judge_weather_lines(
    lines: DataFrame,
    line: str = "line",
    values: tuple[str, ...] = ("precipitation", "soil_moisture"),
    lo: dt.date = FIRST_VALID_DAY,
    hi: dt.date = LAST_VALID_DAY,
    quarantine_incomplete: bool = False,
    strict_doy: bool = False,
    threshold: bool = True,
    allow_non_finite: bool = False,
) -> DataFrame:
    """Plain CSV readings by year and day of year, with the reasons against each row.

    Incomplete rows are left out, or judged with ``quarantine_incomplete``; readings that are
    NaN or infinite are rejected. With
    ``threshold`` every value at or below the missing marker is missing, not only its exact
    spelling.
    """
    parsed = parse_plain_line(lines.select(line), line, numbers=values, allow_non_finite=True)
    dated = to_dated_rows(parsed, values=values, strict_doy=strict_doy)
    if threshold:
        # The marker is a number; what is none is judged below.
        dated = dated.withColumns(
            {v: F.when(finite(v).isNull(), F.col(v)).otherwise(null_if_at_or_below(v)) for v in values}
        )
    if not quarantine_incomplete:
        dated = require_complete(dated, list(values))
    rules = [
        rule_date_range("date", lo, hi, echo=True),
        *[rule_present(v, f"{v} value") for v in values],
    ]
    if not allow_non_finite:
        rules += [rule_finite(v, f"{v} value") for v in values]
    return apply_rules(dated, rules)


def clean_weather_lines(
    lines: DataFrame,
    line: str = "line",
    values: tuple[str, ...] = ("precipitation", "soil_moisture"),
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Plain CSV readings. A date that occurs twice is rejected with all its rows."""
    judged = judge_weather_lines(lines, line, values, **options)
    kept, quarantine = settle(*split(judged), values, "reject_all")
    return assert_complete(kept, ["date", *values]), quarantine
