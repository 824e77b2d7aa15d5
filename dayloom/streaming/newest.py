"""Newest row per key as keyed state of a stream, with a bound on lateness."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dayloom.streaming.merge import upsert_stream

_TIME, _ORDER = "_event_time", "_order"


def newest_changes(stream: DataFrame, keys: list[str], order: list[str], event_time: str, lateness: str) -> DataFrame:
    """The rows of a stream that became the newest of their key, at most one per key and batch.

    A key's state in Spark's store is its newest row; the row that is greatest by ``order`` (nulls
    first, equal ones by their whole content, so that reruns agree) wins. A key whose newest row
    stays is not emitted. State is dropped once the watermark, ``lateness`` behind the greatest
    event time seen, has passed the key's newest event time; rows older than the watermark are
    left out, since the state that would judge them may be gone. Rows without an event time are
    judged like others, and a key that has only such rows keeps its state.

    Shuffled once by key. A hot key's rows of one micro-batch pass through one task as a stream of
    Arrow batches of which one row is held; their number is bounded by the source's batch size.
    """
    columns = stream.columns
    time = F.col(event_time).cast("timestamp")
    by = F.struct(*order, *(c for c in columns if c not in order))
    timed = stream.select(*columns, time.alias(_TIME), by.alias(_ORDER)).withWatermark(_TIME, lateness)
    reduced = timed.select(*keys, _TIME, _ORDER)
    # The state holds the row as its ordered struct; positions are looked up by name afterwards.
    names = [f.name for f in reduced.schema[_ORDER].dataType.fields]
    types = {f.name: f.dataType for f in stream.schema.fields}
    n_order, positions = len(order), [names.index(c) for c in columns]
    at_time = names.index(event_time)
    output = T.StructType([T.StructField(c, types[c]) for c in columns])
    state_type = T.StructType([T.StructField(f"c{i}", types[c]) for i, c in enumerate(names)])

    def rank(row: tuple) -> tuple:
        """Nulls before values, the rest of the row as text where its values do not compare."""
        head = tuple((v is not None, v if v is not None else 0) for v in row[:n_order])
        return head, tuple((v is not None, str(v)) for v in row[n_order:])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = tuple(state.get) if state.exists else None
        best, watermark = before, state.getCurrentWatermarkMs()
        for batch in batches:
            for row, moment in zip(batch[_ORDER], batch[_TIME]):
                if not pd.isna(moment) and watermark > 0 and moment.timestamp() * 1000 < watermark:
                    continue
                row = tuple(_plain(row[c]) for c in names)
                if best is None or rank(row) > rank(best):
                    best = row
        if best is None or best == before:
            return
        state.update(best)
        moment = best[at_time]
        if moment is not None:
            millis = int(pd.Timestamp(moment).timestamp() * 1000) + 1
            state.setTimeoutTimestamp(max(millis, watermark + 1))
        yield pd.DataFrame({c: pd.Series([best[p]], dtype=object) for c, p in zip(columns, positions)})

    return reduced.groupBy(*keys).applyInPandasWithState(
        step, output, state_type, "update", GroupStateTimeout.EventTimeTimeout
    )


def _plain(value):
    """A value as Python holds it; every missing value is null, NaN among numbers stays."""
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def upsert_newest(
    stream: DataFrame,
    target: str,
    keys: list[str],
    order: list[str],
    event_time: str,
    lateness: str,
    part: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keeps ``target`` at the newest row per key; only parts with a changed key are rewritten."""
    changed = newest_changes(stream, keys, order, event_time, lateness)
    return upsert_stream(changed, target, keys, order, part, checkpoint, trigger, output_mode="update")
