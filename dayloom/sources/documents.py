"""JSON documents: lists of observations and maps keyed by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.functions import within_lookback
from dayloom.operators.dedup import latest_per_key


def read_json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Documents that span lines, one row per document."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def explode_records(df: DataFrame, records: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per struct of an array column; an absent array gives no rows."""
    element = df.schema[records].dataType.elementType
    absent = F.array().cast(T.ArrayType(element))
    return df.select(*keep, F.inline(F.coalesce(F.col(records), absent)))


def day_map(document: Column | str, path: str) -> Column:
    """The map of day to number found at ``path`` (for example ``$.a.b``) of a JSON text."""
    return F.from_json(F.get_json_object(document, path), "map<string,double>")


def unpivot_json_maps(
    df: DataFrame, document: str, paths: dict[str, str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per day held by *all* maps of a document, one column per map.

    The key sets meet inside the row, so nothing is shuffled.
    """
    names = list(paths)
    maps = df.select(*keep, *[day_map(document, p).alias(f"_m_{n}") for n, p in paths.items()])
    common = F.map_keys(f"_m_{names[0]}")
    for name in names[1:]:
        common = F.array_intersect(common, F.map_keys(f"_m_{name}"))
    days = maps.select("*", F.explode(common).alias("day"))
    return days.select(
        *keep,
        "day",
        *[F.try_element_at(F.col(f"_m_{n}"), F.col("day")).alias(n) for n in names],
    )


def recent(df: DataFrame, date: str, days: int, as_of: Column) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``."""
    return df.filter(within_lookback(date, as_of, days))


def latest_observation(
    df: DataFrame,
    by: list[str],
    order: list[str],
    date: str,
    days: int | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Newest row per key, looking back ``days`` days from ``as_of`` when given."""
    window = df if days is None else recent(df, date, days, as_of)
    return latest_per_key(window, by, order)
