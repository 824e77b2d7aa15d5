"""Event envelopes: building them, and decoding them again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.functions import compute_once, date_from_wire, finite
from dayloom.schemas import FeedSpec

CORRUPT = "_corrupt"
UNDECODABLE = "Undecodable message"


def record_json(columns: list[str]) -> Column:
    """The record as JSON text, null fields included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def payload_or_record(payload: str, columns: list[str]) -> Column:
    """The payload, or the record itself when the payload is null or empty."""
    return F.coalesce(F.nullif(F.col(payload), F.lit("")), record_json(columns))


def build_envelope(
    df: DataFrame,
    date: str,
    values: list[str],
    stamp: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Message columns: ISO date, values, producer time and the observation as JSON text."""
    moment = F.current_timestamp() if stamp is None else stamp
    iso = F.date_format(F.col(date), "yyyy-MM-dd")
    observation = F.struct(iso.alias("date"), *[F.col(v) for v in values])
    return df.select(
        *keep,
        iso.alias("date"),
        *values,
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingestion_time"),
        F.to_json(observation, {"ignoreNullFields": "false"}).alias("raw_payload"),
    )


def encode_messages(envelopes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One text ``value`` per envelope, the shape a message sink takes."""
    columns = [c for c in envelopes.columns if c not in keep]
    return envelopes.select(*keep, record_json(columns).alias("value"))


def publish(messages: DataFrame, sink: str, **options: str) -> None:
    """Sends encoded messages to a batch sink: files, or a broker whose package is deployed."""
    messages.write.format(sink).options(**options).mode("append").save()


def decode_avro(df: DataFrame, payload: str, feed: FeedSpec) -> DataFrame:
    """As ``decode_payload`` for Avro bytes; needs the Avro package on the cluster."""
    from pyspark.sql.avro.functions import from_avro

    decoded = from_avro(F.col(payload), feed.avro_schema, {"mode": "PERMISSIVE"})
    parsed = compute_once(df, {"record": decoded})
    # A record whose fields are all null is what an unreadable message turns into.
    empty = F.lit(True)
    for field in feed.wire_schema.fieldNames():
        empty = empty & F.col(f"record.{field}").isNull()
    return parsed.select(
        *df.columns, "record", F.when(empty, F.lit(UNDECODABLE)).alias("decode_error")
    )


def decode_payload(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """Adds ``record`` (struct) and ``decode_error`` (null for a readable message).

    Bytes are read as UTF-8. Unreadable messages stay in the frame, so that the caller
    sends them to quarantine rather than losing them.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col(payload).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = compute_once(df, {"_parsed": F.from_json(text, with_corrupt, options)})
    bad = F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull()
    record = F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields])
    return parsed.select(
        *df.columns,
        F.when(~bad, record).alias("record"),
        F.when(bad, F.lit(UNDECODABLE)).alias("decode_error"),
    )


def to_staging_row(
    decoded: DataFrame,
    feed: FeedSpec,
    stamp: Column | None = None,
    keep: tuple[str, ...] = (),
    allow_non_finite: bool = True,
) -> DataFrame:
    """Staging columns of readable messages; the consumer's clock replaces the producer's."""
    fields = [f.name for f in feed.wire_schema.fields]
    flat = decoded.select(*keep, *[F.col(f"record.{n}").alias(n) for n in fields])
    number = (lambda v: F.col(v)) if allow_non_finite else finite
    return flat.select(
        *keep,
        date_from_wire("date").alias("date"),
        *[number(v).alias(v) for v in feed.values],
        (F.current_timestamp() if stamp is None else stamp).alias("ingestion_time"),
        payload_or_record("raw_payload", fields).alias("raw_payload"),
    )
