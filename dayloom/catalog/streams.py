"""Streaming ingest and merge, run to the end of what the source holds."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.catalog.registry import query, table
from dayloom.schemas import FeedSpec
from dayloom.session import scratch_path
from dayloom.sources.messages import record_json, to_staging_row
from dayloom.sources.tables import create_table
from dayloom.streaming.ingest import (
    append_staging,
    ingest_feed,
    read_feed_stream,
    read_rejected,
    read_staged,
)
from dayloom.streaming.merge import upsert_stream
from dayloom.streaming.newest import upsert_newest

FEED = FeedSpec("events", ("value",))
ID = T.StructType([T.StructField("event_id", T.LongType())])
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
MIN_BATCHES = 4


def event_stream(spark, folder):
    # A file source takes a folder or a pattern, not one file by name.
    return read_feed_stream(spark, f"{folder}/events.parq*", EVENTS, "parquet")


@query(
    "stream_append_staging",
    """
    SELECT event_id, CAST(ts AS DATE) AS date, value,
           CASE WHEN event_type = 'click' THEN props ELSE strftime(ts, '%Y-%m-%d') END AS payload,
           TRUE AS stamped
    FROM events
    """,
)
def stream_append_staging(spark, folder):
    # Clicks bring a payload of their own; the others get the record as JSON.
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        "value",
        F.lit(None).cast("string").alias("ingestion_time"),
        F.when(F.col("event_type") == "click", F.col("props"))
        .when(F.col("event_type") == "view", F.lit(""))
        .alias("raw_payload"),
    )
    decoded = event_stream(spark, folder).select("event_id", record.alias("record"))
    path, checkpoint = scratch_path(spark, "staging"), scratch_path(spark, "checkpoint")
    create_table(spark, path, T.StructType([*ID.fields, *FEED.staging_schema.fields]))
    append_staging(
        to_staging_row(decoded, FEED, keep=("event_id",)), path, checkpoint
    ).awaitTermination()
    payload_date = F.substring(F.get_json_object("raw_payload", "$.date"), 1, 10)
    return spark.read.parquet(path).select(
        "event_id",
        "date",
        "value",
        F.coalesce(payload_date, F.col("raw_payload")).alias("payload"),
        F.col("ingestion_time").isNotNull().alias("stamped"),
    )


@query(
    "stream_decode_quarantine",
    """
    SELECT event_id,
           CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(ts AS DATE) END AS date,
           CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS value,
           CASE event_type WHEN 'error' THEN 'Undecodable message'
                           WHEN 'view' THEN 'Invalid date format' END AS errors
    FROM events
    """,
)
def stream_decode_quarantine(spark, folder):
    events = event_stream(spark, folder)
    kind = F.col("event_type")
    shaped = events.select(
        "event_id",
        "event_type",
        F.when(kind == "view", F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias(
            "date"
        ),
        "value",
    )
    whole = record_json(["date", "value"])
    messages = shaped.select(
        "event_id",
        F.when(kind == "error", F.substring_index(whole, ",", 1)).otherwise(whole).alias("value"),
    )
    path, checkpoint = scratch_path(spark, "staging"), scratch_path(spark, "checkpoint")
    create_table(spark, path, FEED.staging_schema)
    ingest_feed(spark, FEED, messages, path, checkpoint, ("event_id",)).awaitTermination()
    good = read_staged(spark, path, FEED, ID).select("event_id", "date", "value")
    bad = read_rejected(spark, path, ID).select("event_id", "errors")
    return good.unionByName(bad, allowMissingColumns=True)


def shuffled_arrivals(spark, folder):
    """All events in several micro-batches, in no order of time."""
    landing = scratch_path(spark, "landing")
    files = max(MIN_BATCHES, spark.sparkContext.defaultParallelism)
    table(spark, folder, "events").repartition(files, "event_id").write.parquet(landing)
    arrivals = read_feed_stream(spark, landing, EVENTS, "parquet", -(-files // MIN_BATCHES))
    # Some arrivals have no date; they share the part without a name.
    day = F.when(F.col("event_id") % 97 != 0, F.to_date("ts"))
    return arrivals.select(
        "event_type", day.alias("date"), "event_id", "ts", "value", F.date_format(day, "yyyy-MM").alias("month")
    )


LATEST = """
    WITH dated AS (
      SELECT event_type, CASE WHEN event_id % 97 <> 0 THEN CAST(ts AS DATE) END AS date, event_id, ts, value
      FROM events)
    SELECT * FROM dated
    QUALIFY row_number() OVER (PARTITION BY event_type, date ORDER BY ts DESC, event_id DESC) = 1
    """


@query("stream_upsert_latest", LATEST)
def stream_upsert_latest(spark, folder):
    rows = shuffled_arrivals(spark, folder)
    target, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "checkpoint")
    upsert_stream(
        rows,
        target,
        ["event_type", "date"],
        ["ts", "event_id"],
        "month",
        checkpoint,
    ).awaitTermination()
    merged = spark.read.schema(T.StructType([*rows.schema.fields])).parquet(target)
    return merged.select("event_type", "date", "event_id", "ts", "value")


@query("stream_newest_state", LATEST)
def stream_newest_state(spark, folder):
    """The newest row per key kept in the state store; the target gets changed keys only."""
    rows = shuffled_arrivals(spark, folder)
    target, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "checkpoint")
    # Arrivals come in no order, so that lateness spans the whole table.
    upsert_newest(
        rows, target, ["event_type", "date"], ["ts", "event_id"], "ts", "36500 days", "month", checkpoint
    ).awaitTermination()
    merged = spark.read.schema(T.StructType([*rows.schema.fields])).parquet(target)
    return merged.select("event_type", "date", "event_id", "ts", "value")
