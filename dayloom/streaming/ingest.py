"""Feeds as streams: read, decode, shape, append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dayloom.operators.quality import INVALID_DATE
from dayloom.schemas import FeedSpec
from dayloom.sources.messages import decode_payload, to_staging_row
from dayloom.sources.tables import VALID_FLAG, table_exists
from dayloom.streaming.staging import Staging


def read_feed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded file source with a declared schema."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_broker_stream(spark: SparkSession, **options: str) -> DataFrame:
    """Unbounded broker source; needs the Kafka package on the cluster."""
    return spark.readStream.format("kafka").options(**options).load()


def _require_table(spark: SparkSession, path: str) -> None:
    if not table_exists(spark, path):
        raise FileNotFoundError(f"staging table does not exist: {path}")


# Ends with what the source holds; ``trigger`` takes the arguments of Spark's trigger instead.
BACKLOG = {"availableNow": True}


def append_staging(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Appends to an existing table; the file sink commits each batch exactly once."""
    _require_table(stream.sparkSession, path)
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**(trigger or BACKLOG))
        .start()
    )


def stage_messages(decoded: DataFrame, feed: FeedSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Staging rows and unreadable messages in one frame, told apart by a flag.

    A date that cannot be read sends its message to quarantine as well.
    """
    rows = to_staging_row(decoded, feed, keep=(*keep, "message", "decode_error"))
    error = F.coalesce(
        F.col("decode_error"),
        F.when(F.col("date").isNull(), F.lit(INVALID_DATE)),
    )
    return rows.withColumn("errors", error).drop("decode_error").withColumn(
        VALID_FLAG, F.col("errors").isNull()
    )


def ingest_feed(
    spark: SparkSession,
    feed: FeedSpec,
    messages: DataFrame,
    path: str,
    checkpoint: str,
    keep: tuple[str, ...] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Message stream (column ``value``) to a staging table with a quarantine side.

    Each batch is decoded once and written to its own folder, split by the flag. A batch
    that is run again replaces its folder, so rows are neither lost nor doubled. ``staging_table``
    compacts the folders of past batches, also while the query runs.
    """
    _require_table(spark, path)
    text = messages.select(*keep, F.col("value").cast("string").alias("message"))
    staged = stage_messages(decode_payload(text, "message", feed.wire_schema), feed, keep)

    staging = staging_table(spark, path, feed, T.StructType([messages.schema[k] for k in keep]))
    return (
        staged.writeStream.foreachBatch(staging.write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BACKLOG))
        .start()
    )


_REJECTED = [T.StructField("message", T.StringType()), T.StructField("errors", T.StringType())]


def staging_table(spark: SparkSession, path: str, feed: FeedSpec, keep: T.StructType = T.StructType()) -> Staging:
    """What ``ingest_feed`` writes to: batches, their compaction and their figures."""
    return Staging(spark, path, T.StructType([*keep.fields, *feed.staging_schema.fields, *_REJECTED]))


def read_staged(
    spark: SparkSession, path: str, feed: FeedSpec, keep: T.StructType = T.StructType()
) -> DataFrame:
    """Rows that ``ingest_feed`` has accepted."""
    names = [*keep.fieldNames(), *feed.staging_schema.fieldNames()]
    return staging_table(spark, path, feed, keep).read(True).select(*names)


def read_rejected(
    spark: SparkSession, path: str, keep: T.StructType = T.StructType()
) -> DataFrame:
    """Messages that ``ingest_feed`` has set aside, with the reason."""
    schema = T.StructType([*keep.fields, *_REJECTED])
    return Staging(spark, path, schema).read(False).select(*schema.fieldNames())
