"""Row rules that collect every reason, and the split into valid and rejected rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.functions import compute_once
from dayloom.functions.numbers import finite

# The reasons, and the separators of listed fields and reasons.
MALFORMED = "Malformed line"
INVALID_DATE = "Invalid date format"
DATE_OUT_OF_RANGE = "Date out of range"
INVALID = "Invalid {}"
NOT_POSITIVE = "{} must be positive"
MISSING = "Missing {}"
MISSING_FIELDS = "Missing fields: "
NOT_A_NUMBER = "{} is not a float"
DUPLICATE_RECORD = "Duplicate record for date "
DUPLICATE_DATE = "Duplicate date"
FIELD_SEPARATOR = ", "
REASON_SEPARATOR = "; "


def _no_reasons() -> Column:
    return F.array().cast("array<string>")


@dataclass(frozen=True)
class Rule:
    """``message`` is added when ``bad_when`` is true; a null condition counts as not bad."""

    bad_when: Column
    message: Column | str

    def as_reasons(self) -> Column:
        """One reason or none, as an array."""
        text = F.lit(self.message) if isinstance(self.message, str) else self.message
        return F.when(self.bad_when, F.array(text)).otherwise(_no_reasons())


def rule_malformed(record: str) -> Rule:
    return Rule(F.col(record).isNull(), MALFORMED)


def rule_date(raw: str, parsed: str, echo: bool = False) -> Rule:
    """The date could not be read; ``echo`` repeats the raw text."""
    text = F.lit(INVALID_DATE)
    if echo:
        text = F.concat(text, F.lit(": "), F.coalesce(F.col(raw), F.lit("")))
    return Rule(F.col(parsed).isNull(), text)


def rule_number(parsed: str, label: str) -> Rule:
    return Rule(F.col(parsed).isNull(), INVALID.format(label))


def rule_finite(parsed: str, label: str) -> Rule:
    """A number was read, but it is NaN or infinite."""
    return Rule(F.col(parsed).isNotNull() & finite(parsed).isNull(), INVALID.format(label))


def rule_positive(parsed: str, label: str) -> Rule:
    return Rule(F.col(parsed) <= 0, NOT_POSITIVE.format(label))


def rule_date_range(parsed: str, lo: dt.date, hi: dt.date, echo: bool = False) -> Rule:
    """Outside [lo, hi], both ends in; ``echo`` names the bounds."""
    text = f"{DATE_OUT_OF_RANGE} ({lo} to {hi})" if echo else DATE_OUT_OF_RANGE
    return Rule(~F.col(parsed).between(F.lit(lo), F.lit(hi)), text)


def rule_present(column: str, label: str) -> Rule:
    return Rule(F.col(column).isNull(), MISSING.format(label))


def rule_numeric(raw: str, parsed: str, label: str) -> Rule:
    """Something was given, but it is not a number."""
    return Rule(F.col(raw).isNotNull() & F.col(parsed).isNull(), NOT_A_NUMBER.format(label))


def rule_fields(columns: list[str]) -> Rule:
    """Lists the required fields a record lacks."""
    absent = F.concat_ws(FIELD_SEPARATOR, *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return Rule(absent != "", F.concat(F.lit(MISSING_FIELDS), absent))


def apply_rules(df: DataFrame, rules: list[Rule], errors: str = "errors") -> DataFrame:
    """Adds the reasons of all broken rules, in rule order; an empty array means valid."""
    return compute_once(df, {errors: F.concat(_no_reasons(), *[r.as_reasons() for r in rules])})


def joined(errors: str = "errors") -> Column:
    return F.array_join(errors, REASON_SEPARATOR)


def split(df: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Valid rows without the reasons, and rejected rows with them."""
    return df.filter(F.size(errors) == 0).drop(errors), df.filter(F.size(errors) > 0)


def to_quarantine(
    df: DataFrame, columns: list[str] | None = None, errors: str = "errors"
) -> DataFrame:
    """Every column as text, and the reasons as one text."""
    names = [c for c in (columns or df.columns) if c != errors]
    reasons = joined(errors) if df.schema[errors].dataType.typeName() == "array" else F.col(errors)
    return df.select(*[F.col(c).cast("string").alias(c) for c in names], reasons.alias(errors))


def quarantine_union(*parts: DataFrame) -> DataFrame:
    """Rejected rows of several steps, as a bag."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def require_complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Silently leaves out rows with a null in any of the columns."""
    return df.dropna(subset=columns)


def require_text(df: DataFrame, column: str) -> DataFrame:
    """Leaves out rows whose column is null or empty."""
    return df.filter(F.col(column).cast("string") != "")


def failing(df: DataFrame, bad: Column, message: Column | str) -> DataFrame:
    """Fails the job on the first row for which ``bad`` is true.

    The check is a filter, so it runs whichever columns are read afterwards.
    """
    text = F.lit(message) if isinstance(message, str) else message
    fail = F.raise_error(text).cast("boolean")
    return df.filter(F.when(bad, fail).otherwise(F.lit(True)))


def assert_complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fails the job on the first row with a null in any of the columns."""
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    message = F.concat(F.lit("Invalid record: "), F.get(absent, F.lit(0)), F.lit(" is null"))
    return failing(df, F.size(absent) > 0, message)
