"""The records of an array inside a JSON document, read in ranges.

A document may be far larger than a task: one file, one array. The text source cuts files into ranges
of bytes and gives each the pieces that begin in it, a piece ending at a closing brace; so a
record without inner objects is one piece. Where a record begins depends on what comes before: whether a
range starts inside a string, how deep it is and inside which array. A first pass tells what each
range does to that state, for both answers to "inside a string?"; one small row for each range, composed
in order, gives every range its own start. A second pass cuts records. A record that crosses
ranges comes in parts, which are put together by key; only those are shuffled.

Ranges are Spark's own (``spark.sql.files.maxPartitionBytes``); a compressed file is one range.
Elements that are not objects are left out. A document that ends too early ends the job.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BRACE = b"}"
_OPENS, _CLOSES = np.zeros(256, np.int8), np.zeros(256, np.int8)
_OPENS[[ord("{"), ord("[")]] = 1
_CLOSES[[ord("}"), ord("]")]] = 1


@dataclass
class _Scan:
    """A stretch of bytes with the depth after each, counted from ``depth`` on."""

    data: np.ndarray
    outside: np.ndarray
    depths: np.ndarray
    in_string: bool

    @classmethod
    def of(cls, text: bytes, in_string: bool, depth: int) -> _Scan:
        data = np.frombuffer(text, np.uint8)
        at = np.arange(len(data))
        # A quote after an odd number of backslashes is part of the string.
        last_other = np.maximum.accumulate(np.where(data != ord("\\"), at, -1))
        before = np.append(-1, last_other[:-1])
        quote = (data == ord('"')) & ((at - 1 - before) % 2 == 0)
        inside = (np.cumsum(quote) + int(in_string)) % 2 == 1
        outside = ~inside
        steps = np.where(outside, _OPENS[data] - _CLOSES[data], 0)
        return cls(data, outside, depth + np.cumsum(steps), bool(inside[-1]) if len(data) else in_string)

    @property
    def depth(self) -> int:
        return int(self.depths[-1])

    def arrays(self, text: bytes, name: str | None) -> np.ndarray:
        """Where the wanted array may open: places of its bracket, outside strings."""
        found = [m.end() - 1 for m in _opening(name).finditer(text)]
        return np.array([p for p in found if self.outside[p]], np.int64)


def _opening(name: str | None) -> re.Pattern:
    return re.compile(rb"\[" if name is None else rb'(?<!\\)"' + re.escape(name.encode()) + rb'"\s*:\s*\[')


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """((file, start of the range), bytes) of neighbouring pieces, each with its closing brace."""
    for frame in frames:
        key = frame["file"].ne(frame["file"].shift()) | frame["start"].ne(frame["start"].shift())
        for _, some in frame.groupby(key.cumsum(), sort=False):
            text = _BRACE.join([*some["value"].map(lambda v: v.encode()), b""])
            yield (some["file"].iloc[0], int(some["start"].iloc[0])), text


_SUMMARY = "file string, start long, in_string boolean, odd boolean, delta long, least long, open array<long>"


def _summaries(name: str | None):
    """What each range does to the state, for both entries: its depth against the entry's, the least, the arrays left open."""

    def tell(key, states) -> pd.DataFrame:
        rows = [(*key, bool(entry), s["in_string"] != bool(entry), s["depth"], s["least"], s["open"]) for entry, s in enumerate(states)]
        return pd.DataFrame(rows, columns=["file", "start", "in_string", "odd", "delta", "least", "open"])

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, states = None, []
        for key, text in _pieces(frames):
            if key != now:
                if now is not None:
                    yield tell(now, states)
                now, states = key, [{"in_string": bool(e), "depth": 0, "least": 0, "open": []} for e in (0, 1)]
            for state in states:
                scan = _Scan.of(text, state["in_string"], state["depth"])
                least = int(scan.depths.min())
                later = np.minimum.accumulate(scan.depths[::-1])[::-1]
                kept = [d for d in state["open"] if d <= least]
                kept += [int(scan.depths[p]) for p in scan.arrays(text, name) if later[p] >= scan.depths[p]]
                state.update(in_string=scan.in_string, depth=scan.depth, least=min(state["least"], least), open=kept)
        if now is not None:
            yield tell(now, states)

    return summarise


def _entries(summaries: list, level: int) -> dict:
    """For each range its state at entry (in string, depth, inside the array) and the key of a record it starts in."""
    ranges: dict[str, dict[int, dict[bool, object]]] = {}
    for row in summaries:
        ranges.setdefault(row["file"], {}).setdefault(row["start"], {})[row["in_string"]] = row
    out = {}
    for file, starts in ranges.items():
        in_string, depth, inside, key = False, 0, False, -1
        for number, start in enumerate(sorted(starts)):
            out[file, start] = (in_string, depth, inside, key, number)
            row = starts[start][in_string]
            opened = [d for d in row["open"] if depth + d == level + 1]
            inside = bool(opened) or inside and depth + row["least"] > level
            # The record that is open at the end began here, unless this range was within it throughout.
            key = number if depth + row["least"] <= level + 1 else key
            in_string, depth = in_string != row["odd"], depth + row["delta"]
        # What follows the last brace of a file is a piece as well, whose brace is not in the file.
        if in_string or depth not in (0, -1):
            raise ValueError(f"document is not complete: {file}")
    return out


_FOUND = "file string, key long, number long, text string"


def _records(name: str | None, level: int, entries: dict):
    """Records of the array: whole ones with a null key, parts with the key of their record."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, rest, state, began, order = None, b"", None, False, 0
        for key, text in _pieces(frames):
            rows: list[tuple] = []
            if key != now:
                if now is not None and rest:
                    rows.append((now[0], entries[now][4], entries[now][4] << 32, rest.decode()))
                now, rest, state = key, b"", entries[key][:3]
                # Whether a record that began in an earlier range is still open.
                began = state[2] and state[1] > level + 1
            in_string, depth, inside = state
            buffer = rest + text
            scan = _Scan.of(buffer, in_string, depth)
            data, outside, after = scan.data, scan.outside, scan.depths
            containers = np.flatnonzero(outside & (_OPENS[data] == 1) & (after == level + 1))
            wanted = np.isin(containers, scan.arrays(buffer, name))

            def within(p: np.ndarray) -> np.ndarray:
                """Whether the container at a place is the array."""
                last = np.searchsorted(containers, p, "right") - 1
                return np.where(last >= 0, wanted[np.maximum(last, 0)] if len(wanted) else False, inside)

            ends = np.flatnonzero(outside & (_CLOSES[data] == 1) & (after == level + 1))
            ends = ends[within(ends)]
            begins = np.flatnonzero(outside & (_OPENS[data] == 1) & (after == level + 2))
            begins = begins[within(begins)]
            if began:
                # Up to its end, or throughout, the text is part of a record of an earlier range.
                to = int(ends[0]) + 1 if len(ends) else len(buffer)
                rows.append((key[0], entries[key][3], (entries[key][4] << 32) + order, buffer[:to].decode()))
                order += 1
                began = not len(ends)
                ends = ends[1:]
            first = np.searchsorted(begins, ends) - 1
            rows += [(key[0], None, None, buffer[begins[i] : e + 1].decode()) for i, e in zip(first, ends)]
            last = int(begins[-1]) if len(begins) else -1
            if last >= 0 and not (len(ends) and ends[-1] > last):
                rest, state = buffer[last:], (False, level + 1, True)
            else:
                rest, state = b"", (scan.in_string, scan.depth, bool(within(np.array([len(buffer)]))[0]) and scan.depth > level)
            if rows:
                yield pd.DataFrame(rows, columns=["file", "key", "number", "text"]).astype({"key": "Int64", "number": "Int64"})
        if now is not None and rest:
            yield pd.DataFrame([(now[0], entries[now][4], entries[now][4] << 32, rest.decode())], columns=["file", "key", "number", "text"])

    return cut


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, name: str | None = None) -> DataFrame:
    """One row for each object of the array ``name`` at the top of each document, or of a document that is an array.

    The columns are those of ``schema`` and ``document``, the file. A record that does not fit the
    schema has nulls, as ``from_json`` gives them.
    """
    level = 0 if name is None else 1
    lines = spark.read.option("lineSep", "}").text(path).select(
        "value", F.input_file_name().alias("file"), F.input_file_block_start().alias("start"))
    # One row for each range and entry: 60 bytes for each range of, say, 128 MB.
    entries = _entries(lines.mapInPandas(_summaries(name), _SUMMARY).collect(), level)
    shared = spark.sparkContext.broadcast(entries)
    cut = lambda frames: _records(name, level, shared.value)(frames)
    found = lines.mapInPandas(cut, _FOUND)
    parts = found.where("key is not null").groupBy("file", "key").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("number", "text"))), lambda p: p["text"]), "").alias("text"))
    whole = found.where("key is null").select("file", "text").unionByName(parts.select("file", "text"))
    # Elements that are arrays were cut like records, as what an element is may be known in another range only.
    objects = whole.where(F.col("text").startswith("{"))
    return objects.select(F.col("file").alias("document"), F.from_json("text", schema).alias("_record")).select("document", "_record.*")
