"""Forecast, backtest and error metric."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.operators.features import HORIZON
from dayloom.operators.ridge import fit_ridge, predict


def last_days(
    df: DataFrame, days: int, date: str = "date", by: list[str] | None = None
) -> DataFrame:
    """Rows of the last ``days`` calendar days, counted back from each key's newest date."""
    if by:
        top = F.max(date).over(Window.partitionBy(*by))
        marked = df.withColumn("_top", top)
        return marked.filter(F.col(date) >= F.date_sub("_top", days - 1)).drop("_top")
    top = df.agg(F.max(date)).scalar()
    return df.filter(F.col(date) >= F.date_sub(top, days - 1))


def forecast(
    df: DataFrame,
    model: DataFrame,
    numeric: list[str],
    categorical: list[str] | None = None,
    horizon: int = HORIZON,
    date: str = "date",
    by: list[str] | None = None,
    output: str = "forecast",
) -> DataFrame:
    """Estimates from the last ``horizon`` days, dated ``horizon`` days later."""
    newest = last_days(df, horizon, date, by)
    scored = predict(newest, model, numeric, output, categorical, by)
    return scored.select(*(by or []), F.date_add(date, horizon).alias("forecast_date"), output)


def score_history(
    df: DataFrame,
    model: DataFrame,
    numeric: list[str],
    categorical: list[str] | None = None,
    horizon: int = HORIZON,
    date: str = "date",
    by: list[str] | None = None,
) -> DataFrame:
    """Estimates for every day, with the day they were made and the day they are for."""
    output = f"yhat_{horizon}"
    scored = predict(df, model, numeric, output, categorical, by)
    return scored.select(
        *(by or []),
        F.col(date).alias("prediction_date"),
        F.date_add(date, horizon).alias("forecast_date"),
        output,
    )


def backtest(
    predictions: DataFrame,
    actuals: DataFrame,
    value: str = "y",
    date: str = "date",
    by: list[str] | None = None,
    train_until: dt.date | None = None,
) -> DataFrame:
    """Estimates next to what came true; days still to come have no actual.

    ``train_until`` marks estimates whose outcome lay within the training data.
    """
    by = list(by or [])
    truth = actuals.select(
        *by, F.col(date).alias("forecast_date"), F.col(value).alias("actual")
    )
    out = predictions.join(truth, [*by, "forecast_date"], "left")
    columns = [*by, "prediction_date", "forecast_date"]
    rest = [c for c in predictions.columns if c not in columns]
    out = out.select(*columns, *rest, "actual")
    if train_until is not None:
        out = out.withColumn("in_sample", F.col("forecast_date") <= F.lit(train_until))
    return out


def mape(
    df: DataFrame,
    actual: str,
    estimate: str,
    by: list[str] | None = None,
    output: str = "mape",
) -> DataFrame:
    """Mean of |actual - estimate| / actual in percent; an actual of zero or null is left out."""
    error = F.try_divide(F.abs(F.col(actual) - F.col(estimate)), F.col(actual))
    known = df.filter(F.col(actual).isNotNull())
    return known.groupBy(*(by or [])).agg((F.avg(error) * 100).alias(output))


def held_out(date: Column | str, parts: int) -> Column:
    """True for one day in ``parts``, the same days on every run."""
    day = F.col(date) if isinstance(date, str) else date
    return F.pmod(F.unix_date(day), F.lit(parts)) == 0


def split_rows(df: DataFrame, parts: int, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Training rows and held-out rows."""
    return df.filter(~held_out(date, parts)), df.filter(held_out(date, parts))


def has_labels(df: DataFrame, label: str) -> bool:
    """Whether a labelled row exists; stops at the first one."""
    return not df.filter(F.col(label).isNotNull()).select(label).isEmpty()


def train_if_labelled(
    df: DataFrame, numeric: list[str], label: str, **options
) -> DataFrame | None:
    """The model, or None when no row has a label, so that earlier outputs are left alone."""
    return fit_ridge(df, numeric, label, **options) if has_labels(df, label) else None
