"""Feeds and the schemas of their messages and tables. Schemas are declared, never inferred."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import types as T

# The days a curated table may hold and the first day of the calendar.
FIRST_VALID_DAY = dt.date(2014, 1, 1)
LAST_VALID_DAY = dt.date(2025, 12, 31)
CALENDAR_START = dt.date(2014, 1, 1)


@dataclass(frozen=True)
class FeedSpec:
    """One input feed: its name, its value columns and the table the messages land in."""

    key: str
    values: tuple[str, ...]
    date: str = "date"
    staging_table: str | None = None
    curated_table: str | None = None
    trigger: str | None = None

    @property
    def wire_schema(self) -> T.StructType:
        """Message record; every field may be missing."""
        return T.StructType(
            [
                T.StructField("date", T.StringType()),
                *[T.StructField(v, T.DoubleType()) for v in self.values],
                T.StructField("ingestion_time", T.StringType()),
                T.StructField("raw_payload", T.StringType()),
            ]
        )

    @property
    def avro_schema(self) -> str:
        """The same record for messages in Avro: every field a union with null, default null."""
        kinds = {"string": "string", "double": "double"}
        fields = [
            {"name": f.name, "type": ["null", kinds[f.dataType.typeName()]], "default": None}
            for f in self.wire_schema.fields
        ]
        return json.dumps({"type": "record", "name": self.key, "fields": fields})

    @property
    def staging_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("date", T.DateType()),
                *[T.StructField(v, T.DoubleType()) for v in self.values],
                T.StructField("ingestion_time", T.TimestampType()),
                T.StructField("raw_payload", T.StringType()),
            ]
        )

    @property
    def curated_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.date, T.DateType()),
                *[T.StructField(v, T.DoubleType()) for v in self.values],
            ]
        )

    @property
    def quarantine_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, T.StringType()) for c in (self.date, *self.values, "errors")]
        )


FEEDS: dict[str, FeedSpec] = {
    feed.key: feed
    for feed in (
        FeedSpec("price_a", ("price_a",)),
        FeedSpec("price_b", ("price_b",)),
        FeedSpec("weather", ("precipitation", "soil_moisture")),
    )
}

FEED_SCHEMAS: dict[str, T.StructType] = {key: feed.wire_schema for key, feed in FEEDS.items()}

# One document holds a list of observations, dates and values both as text.
OBSERVATION_DOCUMENT = T.StructType(
    [
        T.StructField(
            "observations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("date", T.StringType()),
                        T.StructField("value", T.StringType()),
                    ]
                )
            ),
        )
    ]
)
