"""Late and repeated arrivals merged into a table that holds the newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dayloom.operators.dedup import latest_per_key
from dayloom.sources.tables import remove_path, table_exists, write_curated


def merge_batch(
    spark: SparkSession,
    batch: DataFrame,
    target: str,
    staged: str,
    keys: list[str],
    order: list[str],
    part: str,
) -> None:
    """Rewrites the parts of the target that a batch touches.

    ``part`` must be a function of the keys. The merged parts go to ``staged`` first, so
    nothing is overwritten while it is read. A batch that is run again ends in the same
    rows, also when it was cut off while parts of the target were being replaced: merged
    parts that are complete are not made again from a target that may lack some. Readers
    may see some parts replaced before others; the staged copy goes once all are in place.
    """
    if not table_exists(spark, f"{staged}/_SUCCESS"):
        _merge(spark, batch, target, staged, keys, order, part)
    # Schemas are given throughout: part names must not be read back as another type.
    (
        spark.read.schema(batch.schema)
        .parquet(staged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part)
        .parquet(target)
    )
    # The mark goes first: a copy that is removed in part must not be taken for a whole one.
    remove_path(spark, f"{staged}/_SUCCESS")
    remove_path(spark, staged)


def _merge(
    spark: SparkSession,
    batch: DataFrame,
    target: str,
    staged: str,
    keys: list[str],
    order: list[str],
    part: str,
) -> None:
    newest = latest_per_key(batch, keys, order).persist()
    try:
        merged = newest
        if table_exists(spark, target):
            merged = latest_per_key(
                _touched(spark, newest, target, part).unionByName(newest), keys, order
            )
        # Few files per part; adaptive execution splits a part that holds very many rows.
        write_curated(merged.hint("rebalance", part), staged, [part])
    finally:
        newest.unpersist()


def _touched(spark: SparkSession, newest: DataFrame, target: str, part: str) -> DataFrame:
    """Rows of those parts of the target that the batch has rows for."""
    known = spark.read.schema(newest.schema).parquet(target).select(*newest.columns)
    parts = newest.select(part).distinct()
    named = known.join(parts, part, "left_semi").select(*newest.columns)
    # An equality never meets the part without a name, so that one is matched on its own.
    unnamed = parts.where(F.col(part).isNull()).select(F.lit(True).alias("_unnamed"))
    rest = known.where(F.col(part).isNull()).withColumn("_unnamed", F.lit(True))
    return named.unionByName(rest.join(unnamed, "_unnamed", "left_semi").select(*newest.columns))


def upsert_stream(
    stream: DataFrame,
    target: str,
    keys: list[str],
    order: list[str],
    part: str,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Keeps ``target`` at the newest row per key, batch by batch.

    Merged parts are staged below the checkpoint, whose batch numbers they carry. By default
    the query ends with what the source holds; ``trigger`` takes the arguments of Spark's
    trigger, such as ``{"processingTime": "1 minute"}``, for one that runs on.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        staged = f"{checkpoint}/merged/batch_id={batch_id}"
        merge_batch(batch.sparkSession, batch, target, staged, keys, order, part)

    return (
        stream.writeStream.foreachBatch(write_batch)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
