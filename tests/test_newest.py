"""Newest row per key as keyed state: shuffled arrivals, changed keys only, lateness."""

import datetime as dt
import random

from pyspark.sql import types as T

from dayloom.operators.dedup import latest_per_key
from dayloom.streaming.ingest import read_feed_stream
from dayloom.streaming.newest import newest_changes, upsert_newest
from support import values

SCHEMA = T.StructType([
    T.StructField("k", T.StringType()), T.StructField("part", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("n", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("_order", T.StringType())])


def row(k, day, n, v=1.0, order="x"):
    ts = None if day is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
    return (k, None if k is None else k[:1], ts, n, v, order)


def land(spark, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def changes(spark, tmp_path, batches, lateness):
    """What each micro-batch emits, with its number; one landing file after the other."""
    folder, seen = str(tmp_path / "in"), []

    def keep(batch, number):
        seen.extend((number, *r) for r in batch.collect())

    for rows in batches:
        land(spark, folder, [rows])
        stream = newest_changes(
            read_feed_stream(spark, folder, SCHEMA, "parquet", 1).drop("_order"), ["k"], ["ts", "n"], "ts", lateness)
        query = stream.writeStream.foreachBatch(keep).outputMode("update").option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    return [(r[1], r[4]) for r in seen]


def test_shuffled_arrivals_equal_batch(spark, tmp_path):
    dice = random.Random(3)
    rows = [row(dice.choice(["a1", "a2", "b1", None]), dice.choice([None, *range(40)]), n % 50, dice.choice([None, float(n)]))
            for n in range(300)]
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, folder, [rows[i::4] for i in range(4)])
    stream = read_feed_stream(spark, folder, SCHEMA, "parquet", 1).drop("_order")
    upsert_newest(stream, target, ["k"], ["ts", "n"], "ts", "3650 days", "part", str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(target)
    batch = latest_per_key(spark.createDataFrame(rows, SCHEMA).drop("_order"), ["k"], ["ts", "n"])
    assert values(got, "k", "ts", "n") == values(batch, "k", "ts", "n") and got.count() == 4


def test_only_changed_keys_are_emitted(spark, tmp_path):
    got = changes(spark, tmp_path, [
        [row("a", 5, 1), row("b", 5, 1), row("a", 6, 2)],
        [row("a", 6, 2), row("a", 4, 9), row("b", 7, 3)],   # a repeat, an older one, a newer one
        [row("c", None, 1), row("c", None, 2)],
    ], "100 days")
    assert sorted(got) == [("a", 2), ("b", 1), ("b", 3), ("c", 2)]


def test_rows_beyond_the_lateness_are_left_out(spark, tmp_path):
    got = changes(spark, tmp_path, [
        [row("a", 0, 1)],
        [row("b", 50, 2)],                                  # moves the watermark to day 40
        [row("a", 30, 3), row("c", 45, 4)],                 # the first is too late, its key's state is gone
        [row("a", 60, 5)],
    ], "10 days")
    assert sorted(got) == [("a", 1), ("a", 5), ("b", 2), ("c", 4)]


def test_empty_stream(spark, tmp_path):
    land(spark, str(tmp_path / "in"), [[]])
    assert changes(spark, tmp_path, [[]], "1 day") == []
