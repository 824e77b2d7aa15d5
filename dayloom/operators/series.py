"""Ordered windows over daily series, whole or cut into overlapping stretches of time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from dayloom.operators.quality import failing

_STRETCH, _COPY = "_stretch", "_copy"


def series_window(by: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order)


def assert_dense(df: DataFrame, order: str, by: list[str]) -> DataFrame:
    """Fails the job when a series skips or repeats a day."""
    step = F.datediff(F.col(order), F.lag(order).over(series_window(by, order)))
    stepped = df.withColumn("_step", step)
    return failing(stepped, F.col("_step") != 1, "series is not one row per day").drop("_step")


def over_series(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    order: str,
    by: list[str],
    back: int = 0,
    ahead: int = 0,
    stretch_days: int | None = None,
) -> DataFrame:
    """Adds the window columns that ``columns`` builds.

    Keyed series use one window per key: a series holds one row per day, so its length is
    bounded by the calendar. Without a key, or with few very long series, ``stretch_days``
    cuts each series into stretches. A stretch gets copies of the ``back`` days before it
    and the ``ahead`` days after it, which makes row offsets up to that reach exact on a
    series with one row per day; the copies are dropped again. All of it is one shuffle.
    """
    if stretch_days is None:
        return df.withColumns(columns(series_window(by, order)))
    if stretch_days < max(back, ahead):
        raise ValueError("a stretch must be at least as long as the reach of the window")
    day = F.unix_date(F.col(order))
    place = F.pmod(day, F.lit(stretch_days))
    own = F.floor(day / F.lit(stretch_days))
    none = F.lit(None).cast("bigint")
    targets = F.array_compact(
        F.array(
            own,
            F.when(place >= stretch_days - back, own + 1).otherwise(none),
            F.when(place < ahead, own - 1).otherwise(none),
        )
    )
    spread = df.select("*", F.posexplode(targets).alias(_COPY, _STRETCH))
    spec = Window.partitionBy(*by, _STRETCH).orderBy(order)
    return spread.withColumns(columns(spec)).filter(F.col(_COPY) == 0).drop(_COPY, _STRETCH)
