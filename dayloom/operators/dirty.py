"""Which days a change reaches: through forward fill, windows and a growing calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_POINT, _CHANGE = 0, 1


def changed_values(
    existing: DataFrame, newest: DataFrame, keys: list[str], date: str, columns: list[str], keep_existing_on_null: bool = False
) -> DataFrame:
    """(keys, column) for each value that a merge of ``newest`` into ``existing`` changes.

    An added row changes all its columns, also those that are null: it may open a key.
    """
    old = existing.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in columns], F.lit(True).alias("_known"))
    both = newest.select(*keys, *columns).join(old, keys, "left")

    def differs(c: str) -> Column:
        new = F.coalesce(F.col(c), F.col(f"_old_{c}")) if keep_existing_on_null else F.col(c)
        return F.when(F.col("_known").isNull() | ~new.eqNullSafe(F.col(f"_old_{c}")), F.lit(c))

    found = F.array_compact(F.array(*[differs(c) for c in columns]))
    return both.filter(F.col(date).isNotNull()).select(*keys, F.explode(found).alias("column"))


def observed_points(df: DataFrame, by: list[str], date: str, columns: list[str], more: list[str] | None = None) -> DataFrame:
    """(by, column, date) of every value that is there."""
    there = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns]))
    return df.select(*by, *(more or []), F.explode(there).alias("column"), F.col(date))


def fill_reach(changes: DataFrame, points: DataFrame, by: list[str], date: str, last: dt.date) -> DataFrame:
    """(by, lo, hi): a changed value is carried to the day before its column's next observation.

    ``points`` may leave out observations, but must have the first after each change; both are
    stacked, so a key's points and changes meet in one window and nothing is joined.
    """
    stacked = points.select(*by, "column", date, F.lit(_POINT).alias("_kind")).unionByName(
        changes.select(*by, "column", date, F.lit(_CHANGE).alias("_kind")))
    ordered = Window.partitionBy(*by, "column").orderBy(F.unix_date(date))
    after = ordered.rangeBetween(1, Window.unboundedFollowing)
    following = F.min(F.when(F.col("_kind") == _POINT, F.col(date))).over(after)
    reach = stacked.withColumn("_next", following).filter(F.col("_kind") == _CHANGE)
    return reach.select(*by, F.col(date).alias("lo"), F.coalesce(F.date_sub("_next", 1), F.lit(last)).alias("hi"))


def widened(intervals: DataFrame, back: int, ahead: int) -> DataFrame:
    """Days whose windows see one of the intervals: ``ahead`` days before it to ``back`` days after it."""
    return intervals.withColumns({"lo": F.date_sub("lo", ahead), "hi": F.date_add("hi", back)})


def months_of(intervals: DataFrame, first: dt.date, last: dt.date) -> list[str]:
    """Months that the intervals touch between two days: a list that the calendar bounds."""
    cut = intervals.select(F.greatest("lo", F.lit(first)).alias("lo"), F.least("hi", F.lit(last)).alias("hi")).filter("lo <= hi")
    firsts = F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("interval 1 month"))
    months = cut.select(F.explode(F.transform(firsts, lambda d: F.date_format(d, "yyyy-MM"))))
    return sorted(r[0] for r in months.distinct().collect())


def month_span(month: str) -> tuple[dt.date, dt.date]:
    """First and last day of a month."""
    year, number = int(month[:4]), int(month[5:])
    following = dt.date(year + number // 12, number % 12 + 1, 1)
    return dt.date(year, number, 1), following - dt.timedelta(days=1)


def months_between(lo: dt.date, hi: dt.date) -> list[str]:
    out, day = [], lo.replace(day=1)
    while day <= hi:
        out.append(day.strftime("%Y-%m"))
        day = month_span(out[-1])[1] + dt.timedelta(days=1)
    return out


def runs(months: list[str]) -> list[list[str]]:
    """Months in stretches without a gap."""
    out: list[list[str]] = []
    for month in sorted(set(months)):
        if out and month_span(out[-1][-1])[1] + dt.timedelta(days=1) == month_span(month)[0]:
            out[-1].append(month)
        else:
            out.append([month])
    return out
