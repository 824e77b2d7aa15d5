"""Substring dedup by matching statistics against suffix automata of reference shards.

A window is ``WINDOW`` consecutive words. A word goes when a window covers it whose words
also start earlier: in a smaller document, or earlier in the same one.

1. Anchors. The least hash among the short grams of a window is its anchor; equal windows have
   equal anchors at the same place. Neighbouring windows that share an anchor form a run, and
   a run's context is all words of its windows. One row per run leaves the scan: an eighth of
   the words. Runs of equal contexts inside a task meet there, and all but the first are
   decided on the spot, so a passage in a third of all documents sends one row per task.
2. Runs of one anchor meet. Equal contexts are equal in all windows: all but the first go. An
   anchor of one context needs no more. The first run of each further context is checked.
3. Windows of the runs to check are summed by anchor and hash, within tasks before the shuffle:
   the first of each hash that comes again is a reference. Only runs that may hold such a hash go
   on, to shards by anchor; a shard's references are its suffix automaton, and all its runs are
   streamed through it. Where the matching statistic reaches the window's length and the window
   is no reference itself, it starts earlier. The runs of a window that very many documents hold
   are cut into pieces, and its references go to each piece.
4. A document's windows that go are merged to maximal spans and cut out.

Automata go to the runs that hold their anchors, not to every task: the reference is the
corpus itself, grows with it, and has no bound under which it could be broadcast. What is
broadcast is a filter of fixed size over document ids, which spares work and decides nothing.

Defined results: null and empty texts have no words and stay; of rows of equal id those with
equal text are one document and judged alike, those with different texts are ordered by a hash;
a null id comes before all others; texts shorter than a window stay whole; an empty table
gives no rows; named further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.llm.common import gram_hashes, id_filter, lists, may_hold, mix, named, small_batches, words, written

WINDOW, GRAM = 20, 6
#: Runs that a task gathers before it lets the first of each context go on.
GATHER = 250_000
#: Runs of a shard, about: an automaton of at most some 50,000 words.
SHARD_RUNS = 2048
#: Runs that go to Python together.
RUN_BATCH = 5000
NO_ID = -(1 << 63)

#: ``place`` (31 bits), the first window's start (28 bits) and the number of windows less one (4 bits) in one long.
RUNS = "anchor long, ctx long, did long, packed long, goes boolean"


def _pack(place: int, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (np.int64(place) << 32) | (start.astype(np.int64) << 4) | (n - 1).astype(np.int64)


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (packed >> 4) & ((1 << 28) - 1), (packed & 15) + 1


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_POWERS[0]) <= n:
        size = 1 << (n + 1).bit_length()
        with np.errstate(over="ignore"):
            for i, base in enumerate((_BASE, _INVERSE)):
                row = np.full(size, base, np.uint64)
                row[0] = 1
                _POWERS[i] = np.cumprod(row, dtype=np.uint64)
    return _POWERS


def runs_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, context hash, first window and number of windows of each run of a text."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h = h.view(np.uint64)
    grams = gram_hashes(h, GRAM)
    reach = WINDOW - GRAM + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.concatenate((first, [n])))
    powers, inverse = _powers(len(h) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers[: len(h)], dtype=np.uint64)))
        body = (sums[first + count + WINDOW - 1] - sums[first]) * inverse[first]
        shape = ((at[first] - first) * 64 + count).astype(np.uint64)
        ctx = mix(body + mix(shape))
    return grams[at[first]].view(np.int64), ctx.view(np.int64), first, count


def _ids(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("did"),
        F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(1 << 31)).alias("place"),
    ]


def _hashed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(*_ids(docs, doc_id, text), F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("h"))


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All runs of a task; those whose context came before in the task are marked to go.

    These have no more to do with their anchor and get a key of their own, to be spread by.
    """
    parts: list[np.ndarray] = []
    held = 0

    def settled() -> pd.DataFrame:
        rows = np.concatenate(parts, axis=1)
        order = np.lexsort(rows[::-1])
        rows = rows[:, order]
        again = np.concatenate(([False], (rows[0, 1:] == rows[0, :-1]) & (rows[1, 1:] == rows[1, :-1])))
        out = pd.DataFrame({c: v for c, v in zip(("anchor", "ctx", "did", "packed"), rows)})
        # A row like the one before in everything is the same run of a repeated row.
        same = again & np.concatenate(([False], (rows[2:, 1:] == rows[2:, :-1]).all(axis=0)))
        out["goes"] = again
        out.loc[again, "anchor"] = mix((rows[2] ^ mix(rows[3].view(np.uint64)).view(np.int64)).view(np.uint64)).view(np.int64)[again]
        return out[~same]

    for frame in frames:
        for did, place, h in zip(frame["did"].to_numpy(np.int64), frame["place"].to_numpy(np.int64), frame["h"]):
            if len(h) < WINDOW:
                continue
            anchor, ctx, start, n = runs_of(np.ascontiguousarray(h, dtype=np.int64))
            parts.append(np.stack((anchor, ctx, np.full(len(n), did), _pack(place, start, n))))
            held += len(n)
            if held >= GATHER:
                yield settled()
                parts, held = [], 0
    if parts:
        yield settled()


def _judged(runs: DataFrame) -> DataFrame:
    """did, packed, anchor, parts and ``goes``: false for the runs whose windows are to be compared.

    ``parts`` splits an anchor of very many contexts by the hashes of its windows.
    """
    one = Window.partitionBy("goes", "anchor")
    before = one.orderBy("ctx", "did", "packed")
    seen = runs.select(
        "*", F.count("*").over(one).alias("_n"), F.lag("ctx").over(before).alias("_ctx"), F.lag("did").over(before).alias("_did"),
        F.lag("packed").over(before).alias("_packed"), (F.min("ctx").over(one) != F.max("ctx").over(one)).alias("_several"),
    )
    again = F.coalesce(F.col("ctx") == F.col("_ctx"), F.lit(False))
    # A row like the one before in everything is the same run of a repeated row.
    twin = again & (F.col("did") == F.col("_did")) & (F.col("packed") == F.col("_packed"))
    return seen.where(~twin).where(F.col("goes") | again | F.col("_several")).select(
        "did", "packed", "anchor", (F.col("goes") | again).alias("goes"),
        F.ceil(F.col("_n") / SHARD_RUNS).cast("int").alias("parts"),
    )


class SuffixAutomaton:
    """All substrings of a sequence.

    Sequences are added one after the other; a separator that never occurs again keeps matches
    within them.
    """

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]
        self._last = 0

    def add(self, symbol) -> None:
        state = self._new(self.length[self._last] + 1, {})
        at = self._last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            to = self.next[at][symbol]
            if self.length[at] + 1 == self.length[to]:
                self.link[state] = to
            else:
                clone = self._new(self.length[at] + 1, dict(self.next[to]))
                self.link[clone] = self.link[to]
                while at >= 0 and self.next[at].get(symbol) == to:
                    self.next[at][symbol] = clone
                    at = self.link[at]
                self.link[to] = self.link[state] = clone
        self._last = state

    def _new(self, length: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def matches(self, symbols: list, window: int) -> Iterator[int]:
        """Ends of the windows of a stream that the automaton holds.

        The matched length is the matching statistic: the longest part of the reference that
        ends at this position of the stream.
        """
        state = matched = 0
        for end, symbol in enumerate(symbols):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            if matched >= window:
                yield end


def _words_to_check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of each run to check; a row per stretch of windows of one part."""
    for frame in frames:
        anchors, part, dids, packs, texts = [], [], [], [], []
        for did, h, runs in zip(frame["did"], frame["h"], frame["runs"]):
            h = np.ascontiguousarray(h, dtype=np.int64)
            for run in runs:
                packed, parts = int(run["packed"]), int(run["parts"])
                start, n = _start(packed), (packed & 15) + 1
                stretches = [(0, n, 0)]
                if parts > 1:
                    at = gram_hashes(h[start : start + n + WINDOW - 1].view(np.uint64), WINDOW) % np.uint64(parts)
                    cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), n]
                    stretches = [(a, b, int(at[a])) for a, b in zip(cuts, cuts[1:])]
                for a, b, of in stretches:
                    anchors.append(run["anchor"])
                    part.append(of)
                    dids.append(did)
                    packs.append(packed - (packed & (1 << 32) - 1) + ((start + a) << 4) + b - a - 1)
                    texts.append(h[start + a : start + b + WINDOW - 1])
        yield pd.DataFrame({"anchor": np.array(anchors, np.int64), "part": np.array(part, np.int32), "did": np.array(dids, np.int64),
                            "packed": np.array(packs, np.int64), "h": lists(texts)})


def _places(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, offset in it and hash of each window of some runs."""
    n = (rows["packed"].to_numpy(np.int64) & 15) + 1
    words_ = np.concatenate([np.asarray(w, np.int64) for w in rows["h"]])
    begins = np.cumsum(n + WINDOW - 1) - (n + WINDOW - 1)
    row = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, offset, gram_hashes(words_.view(np.uint64), WINDOW)[begins[row] + offset].view(np.int64)


def _windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each window."""
    for frame in frames:
        if len(frame):
            row, offset, hashes = _places(frame)
            yield pd.DataFrame({"anchor": frame["anchor"].to_numpy(np.int64)[row], "wh": hashes, "did": frame["did"].to_numpy(np.int64)[row],
                                "packed": frame["packed"].to_numpy(np.int64)[row], "at": offset})


def _repeats(rows: pd.DataFrame) -> pd.DataFrame:
    """Windows of the shard's own runs that its references hold and that are no references.

    ``firsts`` has the offsets of a run's windows that are references: the first of their hash
    in document order, wherever the others are. Two windows of one run never agree, because
    equal windows hold their anchor at the same place.
    """
    automaton, separators = SuffixAutomaton(), 0
    references = rows[rows["firsts"].notna()].drop_duplicates(["anchor", "did", "packed"])
    for h, firsts in zip(references["h"], references["firsts"]):
        at = np.sort(np.asarray(firsts, np.int64))
        cuts = np.flatnonzero(np.diff(at) != 1) + 1
        for a, b in zip(at[np.concatenate(([0], cuts))].tolist(), at[np.concatenate((cuts - 1, [len(at) - 1]))].tolist()):
            for symbol in h[a : b + WINDOW].tolist():
                automaton.add(symbol)
            separators += 1
            automaton.add((separators,))  # equals no word and no other separator
    dids, packs = [], []
    own = rows[rows["own"]]
    for did, packed, h, firsts in zip(own["did"], own["packed"], own["h"], own["firsts"]):
        mine = () if firsts is None else set(np.asarray(firsts).tolist())
        for end in automaton.matches(h.tolist(), WINDOW):
            at = end - WINDOW + 1
            if at not in mine:
                dids.append(did)
                packs.append(((packed >> 32) << 32) | (_start(packed) + at) << 4)
    return pd.DataFrame({"did": np.array(dids, np.int64), "packed": np.array(packs, np.int64)})


def _start(packed: int) -> int:
    return (packed >> 4) & ((1 << 28) - 1)


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """did and packed of all runs of windows that go."""
    runs = written(_judged(_hashed(docs, doc_id, text).mapInPandas(_scan, RUNS)), "runs")
    check = runs.where("not goes")
    bitmap = id_filter(check, "did")

    def possible(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[may_hold(bitmap.value, frame["did"].to_numpy(np.int64))]

    listed = check.groupBy("did", F.shiftrightunsigned("packed", 32).alias("place")).agg(
        F.collect_list(F.struct("packed", "anchor", "parts")).alias("runs"))
    hashed = _hashed(docs, doc_id, text).mapInPandas(possible, "did long, place long, h array<long>")
    sent = written(hashed.join(listed, ["did", "place"]).mapInPandas(
        _words_to_check, "anchor long, part int, did long, packed long, h array<long>"), "words-to-check")
    with small_batches(docs.sparkSession, RUN_BATCH):
        found = written(_dealt(_marked(sent)).groupBy("shard").applyInPandas(_repeats, "did long, packed long"), "found")
    return written(runs.where("goes").select("did", "packed").unionByName(found), "repeats")


def _marked(sent: DataFrame) -> DataFrame:
    """The runs that may hold a window that comes again, with ``firsts``, the offsets of those that are its first."""
    each = sent.mapInPandas(_windows, "anchor long, wh long, did long, packed long, at int")
    one = F.struct("did", "packed", "at")
    repeated = written(each.groupBy("anchor", "wh").agg(F.min(one).alias("first"), F.max(one).alias("last")).where(
        "first < last").select("wh", "first.*"), "references")
    bitmap = id_filter(repeated, "wh")

    def possible(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                row, _, hashes = _places(frame)
                yield frame.iloc[np.unique(row[may_hold(bitmap.value, hashes)])]

    firsts = repeated.groupBy("did", "packed").agg(F.collect_list("at").alias("firsts"))
    return written(sent.mapInPandas(possible, sent.schema).join(firsts, ["did", "packed"], "left"), "marked")


def _dealt(marked: DataFrame) -> DataFrame:
    """Adds ``shard`` and ``own``, whether the run is streamed there; runs with references go to all pieces of their part."""
    shards = max(1, -(-marked.count() // SHARD_RUNS))
    large = marked.groupBy("anchor", "part").agg(F.ceil(F.count("*") / SHARD_RUNS).cast("int").alias("pieces")).where("pieces > 1")
    sized = marked.join(large, ["anchor", "part"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    sized = sized.withColumn("_own", F.pmod(F.xxhash64("did", "packed"), F.col("pieces")).cast("int"))
    to = F.when(F.col("firsts").isNull(), F.array("_own")).otherwise(F.sequence(F.lit(0), F.col("pieces") - 1))
    return sized.withColumn("piece", F.explode(to)).select(
        "anchor", "did", "packed", "h", "firsts", (F.col("piece") == F.col("_own")).alias("own"),
        F.pmod(F.xxhash64("anchor", "part", "piece"), F.lit(shards)).alias("shard"))


def _spans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Maximal spans of words, first included and last excluded, of each document."""
    for frame in frames:
        starts, ends, removed = [], [], []
        for packed in frame["packed"]:
            first, n = _unpack(np.sort(np.asarray(packed, np.int64)))
            last = np.maximum.accumulate(first + n + WINDOW - 1)
            cut = np.flatnonzero(first[1:] > last[:-1]) + 1
            a, b = first[np.concatenate(([0], cut))], last[np.concatenate((cut - 1, [len(last) - 1]))]
            starts.append(a)
            ends.append(b)
            removed.append(int((b - a).sum()))
        yield pd.DataFrame({"did": frame["did"], "place": frame["place"], "n_removed": removed, "starts": lists(starts), "ends": lists(ends)})


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                   runs: DataFrame | None = None) -> DataFrame:
    """``keep`` and a struct ``dedup``: n_words, n_removed, kept (words left, joined by a space), starts and ends.

    Documents that the filter of touched ids leaves out are finished where they are read;
    only the others meet their spans in a shuffle.
    """
    if runs is None:
        with small_batches(docs.sparkSession):
            runs = repeated_runs(docs, doc_id, text)
    spans = runs.groupBy("did", F.shiftrightunsigned("packed", 32).alias("place")).agg(
        F.collect_list("packed").alias("packed")
    ).mapInPandas(_spans, "did long, place long, n_removed long, starts array<int>, ends array<int>")
    bitmap = id_filter(runs, "did")

    @F.pandas_udf("boolean")
    def touched(ids: pd.Series) -> pd.Series:
        return pd.Series(may_hold(bitmap.value, ids.to_numpy(np.int64)))

    names = [f"_keep_{i}" for i in range(len(keep))]
    rows = docs.select(*(named(c).alias(n) for n, c in zip(names, keep)), *_ids(docs, doc_id, text), F.col(text).alias("_text"))
    rows = rows.withColumn("_touched", touched("did"))
    none = F.array().cast("array<int>")
    whole = rows.where("not _touched").select(
        *names, "_text", F.lit(0).cast("long").alias("n_removed"), none.alias("starts"), none.alias("ends"))
    cut = rows.where("_touched").join(spans, ["did", "place"], "left").select(
        *names, "_text", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"))
    found = whole.unionByName(cut).withColumn("_words", words(F.col("_text")))
    # What stands before the first span, between neighbours, and after the last.
    left = F.flatten(F.transform(F.sequence(F.lit(0), F.size("ends")), lambda i: _between(F.col("_words"), i)))
    kept = F.when(F.size("ends") == 0, F.col("_words")).otherwise(left)
    return found.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), F.struct(
        F.size("_words").cast("long").alias("n_words"), "n_removed", F.array_join(kept, " ").alias("kept"), "starts", "ends",
    ).alias("dedup"))


def _between(found: Column, i: Column) -> Column:
    start = F.coalesce(F.get("ends", i - 1), F.lit(0))
    end = F.coalesce(F.get("starts", i), F.size(found))
    return F.slice(found, start + 1, end - start)
