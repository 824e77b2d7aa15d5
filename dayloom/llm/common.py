"""What the operators share: words, scratch tables and id filters of fixed size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.session import scratch_path

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def named(column: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """All words of a text in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Jobs run inside send few rows at a time to Python, for rows that hold whole texts.

    The session's own setting is back afterwards.
    """
    before = spark.conf.get(BATCH_ROWS, None)
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_ROWS)
        else:
            spark.conf.set(BATCH_ROWS, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once to the shared scratch folder and read back.

    Later steps read the files, so a lost executor costs a task and not the steps before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lists(values) -> pd.Series:
    """A column of arrays, also where there are none or all are of one length."""
    out = np.empty(len(values), object)
    for i, v in enumerate(values):
        out[i] = v
    return pd.Series(out)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def gram_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` consecutive words."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[j : j + n]
    return mix(out)


#: Bits of an id filter. Its size never depends on the data: 2 MB for each broadcast.
FILTER_BITS = 1 << 24
FILTER_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def _slots(ids: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(ids.astype(np.int64).view(np.uint64) + np.uint64(seed)) & np.uint64(FILTER_BITS - 1)


def id_filter(ids: DataFrame, column: str):
    """A broadcast Bloom filter of a long column, of fixed size.

    It only spares work: rows that pass are joined exactly afterwards, so a filter that fills
    up on very large data lets more rows through and changes no result. Each task sends its
    set bits as one value of at most ``FILTER_BITS / 8`` bytes, merged pairwise on executors.
    """

    def bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(FILTER_BITS, bool)
        some = False
        for frame in frames:
            values = frame[column].to_numpy()
            some = some or len(values) > 0
            for seed in FILTER_SEEDS:
                seen[_slots(values, seed)] = True
        if some:
            places = np.flatnonzero(seen)
            words_, inverse = np.unique(places >> 6, return_inverse=True)
            merged = np.zeros(len(words_), np.uint64)
            np.bitwise_or.at(merged, inverse, np.uint64(1) << (places & 63).astype(np.uint64))
            yield pd.DataFrame({"place": words_.astype(np.int64), "bits": merged.view(np.int64)})

    context = ids.sparkSession.sparkContext
    parts = (
        ids.select(F.col(column).cast("long")).where(F.col(column).isNotNull())
        .mapInPandas(bits, "place long, bits long")
        .groupBy("place").agg(F.bit_or("bits").alias("bits"))
    )
    full = np.zeros(FILTER_BITS // 64, np.uint64)
    found = parts.toPandas()
    full[found["place"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return context.broadcast(full)


def may_hold(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each id whether the filter may hold it."""
    out = np.ones(len(ids), bool)
    for seed in FILTER_SEEDS:
        at = _slots(ids, seed)
        out &= (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
    return out
