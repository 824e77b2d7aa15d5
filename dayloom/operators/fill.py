"""Forward fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.operators.skew import range_buckets

_BUCKET, _CARRY = "_bucket", "_carry"


def forward_fill(
    df: DataFrame,
    columns: list[str],
    order: str,
    by: list[str] | None = None,
    bucket: Column | None = None,
    ranges: int | bool = False,
    whole: bool = False,
) -> DataFrame:
    """The last non-null value up to each row, per key; leading nulls stay.

    A plain window needs the rows of a key in one task, which suits daily series, whose
    length the calendar bounds; keyed fills use it unless told otherwise, fills without a
    key only with ``whole``. With ``bucket`` (a column that never decreases along ``order``)
    or ``ranges`` (of equal size, as many as given or as the data needs, see
    ``range_buckets``; the default without a key) no task needs more than a bucket: rows are filled within (key, bucket), the last
    value of each bucket is carried over the bucket summary into the next. ``order`` must
    be unique within a key.
    """
    by = list(by or [])
    if bucket is None and not ranges and (by or whole):
        spec = Window.partitionBy(*by).orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return df.withColumns({c: F.last(c, ignorenulls=True).over(spec) for c in columns})

    if bucket is None:
        # The key breaks ties, so that rows of one moment need not share a range.
        count = None if isinstance(ranges, bool) else ranges
        cut = range_buckets(df, [order, *by], _BUCKET, count)
    else:
        cut = df.withColumn(_BUCKET, bucket)
    # One row per (key, bucket), combined before the shuffle: the last value it holds, and
    # from that the value it receives.
    summary = cut.groupBy(*by, _BUCKET).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    )
    before = Window.partitionBy(*by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *by,
        _BUCKET,
        *[F.last(c, ignorenulls=True).over(before).alias(c) for c in columns],
        F.lit(True).alias(_CARRY),
    )
    # Received values go in as the first row of each bucket, so nothing is joined.
    rows = cut.withColumn(_CARRY, F.lit(False)).unionByName(carry, allowMissingColumns=True)
    inside = Window.partitionBy(*by, _BUCKET).orderBy(F.col(_CARRY).desc(), order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    return filled.filter(~F.col(_CARRY)).select(*df.columns)
