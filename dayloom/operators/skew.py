"""Spreading rows of which one key, or one stretch of time, may hold very many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.session import scratch_path

# A hot key's rows end up in this many parts; its first rows, one per part, meet in one task.
DEFAULT_SALTS = 4096


def content_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def salt(content: Column, salts: int) -> Column:
    """A part number from the hash of the row's content and its input partition.

    The content spreads distinct rows of a key, the partition spreads exact copies.
    """
    content = F.pmod(content, F.lit(salts))
    place = F.pmod(F.spark_partition_id(), F.lit(salts))
    return F.pmod(content + place, F.lit(salts)).cast("int")


def salted_join(
    df: DataFrame, per_key: DataFrame, by: list[str], salts: int, how: str = "inner"
) -> DataFrame:
    """Joins a frame of one row per key onto rows of which one key may hold very many.

    The rows of a key are spread over ``salts`` parts and its one row is copied to each.
    """
    spread = df.withColumn("_part", salt(content_hash(df), salts))
    copies = per_key.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_part"))
    return spread.join(copies, [*by, "_part"], how).drop("_part")


def range_buckets(
    df: DataFrame, order: list[str], name: str = "_bucket", parts: int | None = None
) -> DataFrame:
    """Numbers consecutive ranges of ``order`` that hold about equally many rows.

    The ranges follow the data, so a busy hour is cut finer than a quiet one. They come from
    a sample and would differ in a second evaluation; the numbered rows are therefore
    written to the scratch folder, and every later step reads the same numbers. Without
    ``parts`` there are as many as shuffle partitions, fewer where those would be small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    cut = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    ranged = cut.withColumn(name, F.spark_partition_id())
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)
