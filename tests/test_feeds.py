import datetime as dt

import pytest
from pyspark.sql import functions as F

from support import values
from dayloom.operators.freshness import (
    baseline_table, capture_baseline, feed_status, feed_summary, new_rows, new_rows_by, ready,
)

T0 = dt.datetime(2024, 1, 1, 12)


def feed(spark, hours):
    return spark.createDataFrame([(T0 + dt.timedelta(hours=h),) for h in hours], "ingestion_time timestamp")


def test_baseline(spark):
    got = values(capture_baseline({"a": feed(spark, [0, 2]), "b": feed(spark, [])}))
    assert got == [("a", T0 + dt.timedelta(hours=2)), ("b", None)]


def test_new_rows_strictly_after(spark):
    df = feed(spark, [0, 1, 2])
    count = lambda base: new_rows(df, F.lit(base).cast("timestamp")).first().new_rows
    assert (count(T0), count(T0 + dt.timedelta(hours=2)), count(None)) == (2, 0, 3)


def several(spark):
    rows = [("a", T0), ("a", T0 + dt.timedelta(hours=1)), ("b", T0), ("z", T0)]
    return spark.createDataFrame(rows, "feed string, ts timestamp")


def test_gate(spark):
    base = baseline_table(spark, {"a": T0, "b": T0, "c": None})
    counts = new_rows_by(several(spark), "feed", "ts", base)
    assert values(counts, "feed", "new_rows") == [("a", 1), ("b", 0), ("c", 0)]
    status = feed_status(counts)
    assert values(feed_summary(status), "feed", "state") == [("a", "success"), ("b", "skipped"), ("c", "skipped")]
    assert ready(status).first().ready and not ready(status, require_all=True).first().ready
    assert not ready(feed_status(counts, 2)).first().ready
    assert not ready(status.limit(0)).first().ready


def test_feed_without_baseline_counts_all(spark):
    base = baseline_table(spark, {"a": None})
    assert new_rows_by(several(spark), "feed", "ts", base).first().new_rows == 2


def test_many_feeds_and_a_null_one(spark):
    rows = spark.range(6000).selectExpr("cast(id % 3000 as string) as feed", "timestamp'2024-01-02 00:00:00' as ts")
    rows = rows.unionByName(spark.sql("select cast(null as string) as feed, timestamp'2024-01-03 00:00:00' as ts"))
    base = spark.range(2500).selectExpr("cast(id as string) as feed", "timestamp'2024-01-01 00:00:00' as baseline")
    base = base.unionByName(spark.sql("select cast(null as string) as feed, cast(null as timestamp) as baseline"))
    got = new_rows_by(rows, "feed", "ts", base)
    assert got.count() == 2501 and got.where("new_rows = 2").count() == 2500
    assert got.where("feed is null").first().new_rows == 1
