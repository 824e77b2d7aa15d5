"""One row per day: bounds, the spine itself, joins on it, and the latest known values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.operators.dedup import any_value_by_key
from dayloom.operators.series import series_window

#: Days that a task sorts of dense series: some 200 MB for four values.
DAYS_PER_TASK = 1 << 20


def _day(value: Column | dt.date) -> Column:
    return F.lit(value) if isinstance(value, dt.date) else value


def spine_bounds(
    sources: list[tuple[DataFrame, str]], start: Column | dt.date, as_of: Column | None = None
) -> DataFrame:
    """One row (lo, hi): the greatest date of all sources, or ``as_of`` when all are empty."""
    tops = None
    for df, date in sources:
        top = df.agg(F.max(date).cast("date").alias("hi"))
        tops = top if tops is None else tops.unionByName(top)
    today = F.current_date() if as_of is None else as_of
    return tops.agg(F.coalesce(F.max("hi"), today).alias("hi")).select(
        _day(start).alias("lo"), "hi"
    )


def bounds_by_key(df: DataFrame, by: list[str], date: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.min(date).cast("date").alias("lo"), F.max(date).cast("date").alias("hi")
    )


def date_spine(
    bounds: DataFrame,
    by: list[str] | None = None,
    lo: str = "lo",
    hi: str = "hi",
    name: str = "date",
) -> DataFrame:
    """All days from ``lo`` to ``hi`` per row of ``bounds``; none where ``lo`` is after ``hi``."""
    days = F.when(F.col(lo) <= F.col(hi), F.sequence(lo, hi, F.expr("interval 1 day")))
    return bounds.select(*(by or []), F.explode(days).alias(name))


def join_on_spine(
    spine: DataFrame, sources: list[tuple[DataFrame, list[str]]], keys: list[str]
) -> DataFrame:
    """Left joins of sources cut down to one row per key, so the spine keeps its rows."""
    out = spine
    for df, columns in sources:
        out = out.join(any_value_by_key(df, keys, columns), keys, "left")
    return out


def series_parts(df: DataFrame, n_series: int, lo: dt.date, hi: dt.date | None) -> int | None:
    """Parts for dense series of all days, so that a task sorts about ``DAYS_PER_TASK`` of them.

    Partitions are sized by the observed days that are shuffled, but each of those becomes as many
    dense days as pass until the next. None where the cores at hand already make as many parts.
    """
    days = n_series * ((hi - lo).days + 1) if hi is not None else 0
    parts = -(-days // DAYS_PER_TASK)
    return parts if parts > df.sparkSession.sparkContext.defaultParallelism else None


def as_of_daily(
    sources: list[tuple[DataFrame, list[str]]],
    date: str,
    by: list[str] | None = None,
    lo: Column | dt.date | None = None,
    hi: Column | dt.date | None = None,
    parts: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Latest known value of every column on every day from ``lo`` to ``hi``.

    The result is that of a spine, one left join per source and a forward fill. Here the
    sources are stacked and grouped once, the fill runs over the observed days only, and
    each observed day is then repeated until the next one. That is one shuffle by
    (key, day) and one by key, whatever the number of sources, and no join.

    Without ``lo``/``hi`` each key runs from its own first to its own last day. Days before
    the first observation hold nulls. Without a key the observed days, one row each, are
    filled in one task: the calendar bounds them.

    Very many series take ``parts``, see ``series_parts``. ``unique`` says that a single keyed
    source has one row per key and day already, so that its rows are not grouped again.
    """
    by = list(by or [])
    names = [c for _, columns in sources for c in columns]
    stacked = None
    for df, columns in sources:
        part = df.select(*by, F.col(date).cast("date").alias(date), *columns)
        part = part.filter(F.col(date).isNotNull())
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    if lo is not None:
        stacked = stacked.filter(F.col(date) >= _day(lo))
    if hi is not None:
        stacked = stacked.filter(F.col(date) <= _day(hi))
    if not by and lo is not None:
        # An empty calendar still has its days: one row without values opens it.
        opening = stacked.sparkSession.range(1).select(
            _day(lo).cast("date").alias(date),
            *[F.lit(None).cast(stacked.schema[c].dataType).alias(c) for c in names],
        )
        stacked = stacked.unionByName(opening)
    grouped = unique and by and len(sources) == 1
    observed = stacked if grouped else any_value_by_key(stacked, [*by, date], names)
    if parts and by:
        observed = observed.repartition(parts, *by)
    return repeat_until_next(observed, date, names, by, lo, hi)


def repeat_until_next(
    observed: DataFrame,
    date: str,
    names: list[str],
    by: list[str],
    lo: Column | dt.date | None,
    hi: Column | dt.date | None,
) -> DataFrame:
    spec = series_window(by, date)
    so_far = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {f"_k_{c}": F.last(c, ignorenulls=True).over(so_far) for c in names}
    columns["_next"] = F.lead(date).over(spec)
    columns["_prev"] = F.lag(date).over(spec)
    filled = observed.withColumns(columns)
    start = F.col(date)
    if lo is not None:
        start = F.when(F.col("_prev").isNull(), F.least(F.col(date), _day(lo))).otherwise(start)
    last_day = F.col(date) if hi is None else _day(hi)
    until = F.coalesce(F.date_sub("_next", 1), last_day)
    days = F.when(start <= until, F.sequence(start, until, F.expr("interval 1 day")))
    dense = filled.select(
        *by, F.col(date).alias("_seen"), *[f"_k_{c}" for c in names], F.explode(days).alias(date)
    )
    seen = F.col(date) >= F.col("_seen")
    return dense.select(*by, date, *[F.when(seen, F.col(f"_k_{c}")).alias(c) for c in names])
