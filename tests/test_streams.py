import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from support import values
from dayloom.operators.dedup import latest_per_key
from dayloom.schemas import FEEDS
from dayloom.sources.messages import decode_payload, to_staging_row
from dayloom.sources.tables import create_table
from dayloom.streaming.ingest import append_staging, ingest_feed, read_feed_stream, read_rejected, read_staged
from dayloom.streaming.merge import merge_batch, upsert_stream

FEED = FEEDS["price_a"]
TEXT = T.StructType([T.StructField("value", T.StringType())])


def write_messages(folder, name, items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(items) + "\n")


def message(day, price, **more):
    return json.dumps({"date": day, "price_a": price, **more})


def test_append_needs_an_existing_table(spark, tmp_path):
    write_messages(tmp_path / "in", "a.txt", [message("2024-01-01", 1.0)])
    stream = read_feed_stream(spark, str(tmp_path / "in"), TEXT, "text")
    with pytest.raises(FileNotFoundError):
        append_staging(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    with pytest.raises(FileNotFoundError):
        ingest_feed(spark, FEED, stream, str(tmp_path / "out"), str(tmp_path / "cp"))


def test_append_equals_batch_and_does_not_repeat(spark, tmp_path):
    source, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    write_messages(source, "a.txt", [message("2024-01-01", 1.0), message("19724", 2.0)])
    create_table(spark, out, FEED.staging_schema)

    def run():
        stream = read_feed_stream(spark, str(source), TEXT, "text", 1)
        rows = to_staging_row(decode_payload(stream, "value", FEED.wire_schema), FEED)
        append_staging(rows, out, cp).awaitTermination()

    run()
    run()
    write_messages(source, "b.txt", [message("2024-01-03", None, raw_payload="kept")])
    run()
    got = spark.read.parquet(out)
    batch = to_staging_row(decode_payload(spark.read.text(str(source)), "value", FEED.wire_schema), FEED)
    columns = ["date", "price_a", "raw_payload"]
    assert values(got, *columns) == values(batch, *columns)
    assert got.count() == 3 and got.filter("ingestion_time is null").count() == 0
    assert got.filter("price_a is null").first().raw_payload == "kept"


def test_ingest_keeps_bad_messages_apart(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_messages(source, "a.txt", [message("2024-01-01", 1.0), "{broken"])
    write_messages(source, "b.txt", [message("soon", 2.0), message("2024-01-02T05:00", 3.0)])
    create_table(spark, out, FEED.staging_schema)

    def run():
        stream = read_feed_stream(spark, str(source), TEXT, "text", 1)
        ingest_feed(spark, FEED, stream, out, str(tmp_path / "cp")).awaitTermination()

    run()
    run()
    assert values(read_staged(spark, out, FEED), "date", "price_a") == [
        (dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 2), 3.0)]
    assert values(read_rejected(spark, out)) == [
        (message("soon", 2.0), "Invalid date format"), ("{broken", "Undecodable message")]


ARRIVALS = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("month", T.StringType()),
    T.StructField("v", T.DoubleType()), T.StructField("t", T.IntegerType())])


def arrivals(spark, rows):
    data = [(dt.date(2024, m, d), f"{m:02d}", float(v), t) for m, d, v, t in rows]
    return spark.createDataFrame(data, ARRIVALS)


def test_upsert_stream_keeps_the_newest(spark, tmp_path):
    batches = [
        [(1, 1, 10, 1), (1, 2, 11, 1), (2, 1, 12, 1)],
        [(1, 1, 20, 3), (3, 1, 21, 1), (1, 1, 22, 2)],
        [(1, 1, 30, 2), (2, 1, 31, 9)],
    ]
    source, target = str(tmp_path / "in"), str(tmp_path / "t")
    for rows in batches:
        arrivals(spark, rows).coalesce(1).write.mode("append").parquet(source)
    stream = read_feed_stream(spark, source, ARRIVALS, "parquet", 1)
    upsert_stream(stream, target, ["date"], ["t"], "month",
                  str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(ARRIVALS).parquet(target).select(*ARRIVALS.fieldNames())
    whole = latest_per_key(spark.read.schema(ARRIVALS).parquet(source), ["date"], ["t"])
    assert values(got) == values(whole) and got.count() == 4


def test_merging_a_batch_twice_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    run = lambda rows, n: merge_batch(
        spark, arrivals(spark, rows), target, str(tmp_path / f"s{n}"), ["date"], ["t"], "month")
    run([(1, 1, 1, 1), (2, 1, 2, 1)], 0)
    before = sorted((tmp_path / "t" / "month=02").glob("*.parquet"))
    run([(1, 1, 5, 2), (1, 2, 6, 1)], 1)
    once = values(spark.read.schema(ARRIVALS).parquet(target).select("date", "v", "t"))
    run([(1, 1, 5, 2), (1, 2, 6, 1)], 2)
    assert values(spark.read.schema(ARRIVALS).parquet(target).select("date", "v", "t")) == once
    assert once == [(dt.date(2024, 1, 1), 5.0, 2), (dt.date(2024, 1, 2), 6.0, 1), (dt.date(2024, 2, 1), 2.0, 1)]
    # A month without arrivals is not rewritten.
    assert sorted((tmp_path / "t" / "month=02").glob("*.parquet")) == before


def test_merge_cut_off_half_way_loses_nothing(spark, tmp_path, monkeypatch):
    """The old part is gone, the new one not yet in place, and the batch is run again."""
    import shutil

    monkeypatch.setattr("dayloom.streaming.merge.remove_path", lambda *_: None)
    target, staged = tmp_path / "t", str(tmp_path / "s1")
    run = lambda rows, path: merge_batch(
        spark, arrivals(spark, rows), str(target), path, ["date"], ["t"], "month")
    run([(1, 1, 1, 1), (1, 2, 2, 1)], str(tmp_path / "s0"))
    run([(1, 1, 9, 2)], staged)
    want = values(spark.read.schema(ARRIVALS).parquet(str(target)).select("date", "v", "t"))
    shutil.rmtree(target / "month=01")
    run([(1, 1, 9, 2)], staged)
    assert values(spark.read.schema(ARRIVALS).parquet(str(target)).select("date", "v", "t")) == want
    assert len(want) == 2


NAMED = "k int, part string, t int"


def test_parts_without_a_name_keep_their_rows(spark, tmp_path):
    """A batch that touches the part without a name must not lose what it held before."""
    target = str(tmp_path / "t")
    run = lambda rows, n: merge_batch(
        spark, spark.createDataFrame(rows, NAMED), target, str(tmp_path / f"s{n}"), ["k", "part"], ["t"], "part")
    run([(1, None, 1), (2, "a", 1), (3, "b", 1), (None, None, 1)], 0)
    run([(4, None, 2), (2, "a", 2), (None, None, 3)], 1)
    got = values(spark.read.schema(NAMED).parquet(target).select("k", "part", "t"))
    assert got == sorted([(1, None, 1), (4, None, 2), (None, None, 3), (2, "a", 2), (3, "b", 1)], key=repr)
    # Nothing staged is left behind.
    assert not (tmp_path / "s0").exists() and not (tmp_path / "s1").exists()


def test_a_stream_may_run_on(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = lambda *ks: spark.createDataFrame([(k, "a", k) for k in ks], NAMED).coalesce(1).write.mode("append").parquet(source)
    rows(1)
    stream = read_feed_stream(spark, source, spark.createDataFrame([], NAMED).schema, "parquet", 1)
    query = upsert_stream(stream, target, ["k"], ["t"], "part", str(tmp_path / "cp"), {"processingTime": "100 milliseconds"})
    try:
        query.processAllAvailable()
        rows(2)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert spark.read.schema(NAMED).parquet(target).count() == 2
