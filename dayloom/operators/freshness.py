"""Whether feeds have brought new rows, and whether a build may go ahead."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows that count as progress, and the names of the two states.
MIN_NEW_ROWS = 1
PASSED, WAITING = "success", "skipped"


def capture_baseline(feeds: dict[str, DataFrame], stamp: str = "ingestion_time") -> DataFrame:
    """Newest stamp per feed, null for an empty feed: one row per feed."""
    out = None
    for key, df in feeds.items():
        row = df.agg(F.max(stamp).alias("baseline")).select(F.lit(key).alias("feed"), "baseline")
        out = row if out is None else out.unionByName(row)
    return out


def capture_baseline_by(df: DataFrame, feed: str, stamp: str) -> DataFrame:
    """The same for one table that holds several feeds."""
    return df.groupBy(F.col(feed).alias("feed")).agg(F.max(stamp).alias("baseline"))


def baseline_table(spark, baselines: dict[str, dt.datetime | None]) -> DataFrame:
    """Baselines kept by the caller, as a frame; its size is that of the feed registry."""
    schema = T.StructType(
        [T.StructField("feed", T.StringType()), T.StructField("baseline", T.TimestampType())]
    )
    return spark.createDataFrame(list(baselines.items()), schema)


def new_rows(df: DataFrame, baseline: Column, stamp: str = "ingestion_time") -> DataFrame:
    """One row: how many rows are strictly newer; without a baseline all rows count."""
    newer = baseline.isNull() | (F.col(stamp) > baseline)
    return df.agg(F.count_if(newer).alias("new_rows"))


def new_rows_by(df: DataFrame, feed: str, stamp: str, baselines: DataFrame) -> DataFrame:
    """New rows per feed of a table that holds several feeds.

    Rows meet the baselines, one per registered feed, and are counted in the same task;
    only counts are shuffled after that. Spark sends a small registry to every task; beyond
    its own limit adaptive execution splits a feed with very many rows. Feeds without rows
    count zero, and a null feed is a feed of its own.
    """
    rows = df.select(F.col(feed).alias("_feed"), F.col(stamp).alias("_stamp"))
    met = rows.join(baselines, F.col("_feed").eqNullSafe(F.col("feed")))
    newer = F.col("baseline").isNull() | (F.col("_stamp") > F.col("baseline"))
    counted = met.groupBy(F.col("feed").alias("_feed")).agg(F.count_if(newer).alias("new_rows"))
    return baselines.join(counted, F.col("feed").eqNullSafe(F.col("_feed")), "left").select(
        "feed", "baseline", F.coalesce("new_rows", F.lit(0)).cast("bigint").alias("new_rows")
    )


def feed_status(counts: DataFrame, minimum: int = MIN_NEW_ROWS) -> DataFrame:
    return counts.withColumn("passed", F.col("new_rows") >= minimum)


def ready(status: DataFrame, require_all: bool = False) -> DataFrame:
    """One row: go ahead when any feed has passed, or when all have."""
    rule = F.bool_and("passed") if require_all else F.bool_or("passed")
    return status.agg(F.coalesce(rule, F.lit(False)).alias("ready"))


def feed_summary(status: DataFrame) -> DataFrame:
    state = F.when(F.col("passed"), F.lit(PASSED)).otherwise(F.lit(WAITING))
    return status.withColumn("state", state)
