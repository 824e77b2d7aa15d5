"""Lags, moving averages, lead target and calendar parts of dense daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from dayloom.functions import calendar_parts
from dayloom.operators.series import over_series

# Fixed values of the feature set.
LAGS = (1, 7, 28)
AVERAGE_ROWS = 7
HORIZON = 40


def _lags(column: str, lags, spec: WindowSpec) -> dict:
    return {f"{column}_lag{k}": F.lag(column, k).over(spec) for k in lags}


def _averages(columns: dict[str, str], rows: int, spec: WindowSpec) -> dict:
    frame = spec.rowsBetween(-(rows - 1), 0)
    return {out: F.avg(c).over(frame) for out, c in columns.items()}


def _target(column: str, horizon: int, spec: WindowSpec) -> dict:
    return {f"target_{horizon}": F.lead(column, horizon).over(spec)}


def add_lags(
    df: DataFrame,
    column: str,
    lags: tuple[int, ...] = LAGS,
    order: str = "date",
    by: list[str] | None = None,
    stretch_days: int | None = None,
) -> DataFrame:
    build = lambda spec: _lags(column, lags, spec)
    return over_series(df, build, order, list(by or []), back=max(lags), stretch_days=stretch_days)


def add_moving_avg(
    df: DataFrame,
    columns: dict[str, str],
    rows: int = AVERAGE_ROWS,
    order: str = "date",
    by: list[str] | None = None,
    stretch_days: int | None = None,
) -> DataFrame:
    """``columns`` maps a new name to the column averaged over the last ``rows`` rows."""
    build = lambda spec: _averages(columns, rows, spec)
    return over_series(df, build, order, list(by or []), back=rows - 1, stretch_days=stretch_days)


def add_lead_target(
    df: DataFrame,
    column: str,
    horizon: int = HORIZON,
    order: str = "date",
    by: list[str] | None = None,
    stretch_days: int | None = None,
) -> DataFrame:
    build = lambda spec: _target(column, horizon, spec)
    return over_series(df, build, order, list(by or []), ahead=horizon, stretch_days=stretch_days)


def feature_matrix(
    df: DataFrame,
    column: str,
    averaged: dict[str, str],
    date: str = "date",
    by: list[str] | None = None,
    lags: tuple[int, ...] = LAGS,
    rows: int = AVERAGE_ROWS,
    horizon: int = HORIZON,
    stretch_days: int | None = None,
) -> DataFrame:
    """Value, lags, moving averages, calendar parts and the value ``horizon`` days ahead.

    Every window shares one partitioning and one sort, so they are one window operator.
    The series must hold one row per day.
    """
    by = list(by or [])
    series = df.select(
        *by, date, F.col(column).alias("y"), *[c for c in averaged.values() if c != column]
    )
    averaged = {out: "y" if c == column else c for out, c in averaged.items()}

    def build(spec: WindowSpec) -> dict:
        return {
            **_lags("y", lags, spec),
            **_averages(averaged, rows, spec),
            **_target("y", horizon, spec),
        }

    wide = over_series(
        series, build, date, by, max(max(lags), rows - 1), horizon, stretch_days
    ).withColumns(calendar_parts(date))
    return wide.select(
        *by,
        date,
        "y",
        *[f"y_lag{k}" for k in lags],
        *averaged,
        "dow",
        "mon",
        f"target_{horizon}",
    )
