"""Phrases mined from a corpus by vertical partitioning of its suffixes.

Texts are cut into pieces at punctuation and into words; a suffix is a word and what follows it
within its piece, truncated to ``DEPTH`` words. Suffixes with a common prefix make a subtree, and subtrees
can be built independently. So prefixes are grouped by a memory budget: one pass counts suffixes by the
hash of their first word, a fixed number of counts; small prefixes share a group up to ``BUDGET`` suffixes,
and a prefix above it is made longer by a word, its two-word prefixes dealt over as many groups as it
needs. A second pass sends suffixes to their groups. Equal suffixes are counted within a task first, so a
very frequent phrase is one entry for each task, and entries of a task and group travel as one sorted, compressed
block with a word list of its own.

A group's subtree is the sorted list of its distinct suffixes: nodes are runs with a common
prefix, and a phrase's count is the sum of the leaves below its node. Counts are exact.

Candidates, scores and ranks are then joins and windows over nodes that occur often enough. The
count of a phrase's first words is in its own subtree, that of its other words in another one.

Defined results: null and empty texts have no words; null languages are ``und``, as is a language of that
name; repeated rows count each; a word may be of any length, a suffix holds at most ``DEPTH`` of them;
phrases of equal score and count are ordered bytewise; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.llm.common import LOWER, UPPER, named, small_batches, written

DEPTH = 3
#: Counts of first words, by hash; suffixes of a group; most partitions that groups are dealt to.
BINS, BUDGET, MOST_PARTS = 1 << 13, 1 << 20, 20_000
#: Suffixes and words that a task holds before it sends what it has.
HELD, HELD_WORDS = 1 << 22, (1 << 21) - 1
#: Least count of a phrase, percent of it that a longer one must reach to replace it, phrases of a language.
LEAST, COVERED_PERCENT, TOP = 10, 50, 2000
SCALE = 1_000_000

# A byte that no UTF-8 text holds stands for the end of a piece.
END = b"\xff"
_LETTERS = bytes.maketrans(UPPER.encode() + b".,;:!?\n\x0b\x0c\r\t", LOWER.encode() + END * 10 + b" ")


class Words(dict):
    """Numbers words from 1 on as they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def tokens(texts: list[bytes | None]) -> list[bytes]:
    """Words of all texts, with END after each piece."""
    return END.join([t for t in texts if t]).translate(_LETTERS).replace(END, b" \xff ").split() + [END]


def _place(lang: bytes, word: bytes) -> int:
    return zlib.crc32(word, zlib.crc32(lang + b"\n"))


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[bytes]]]:
    """Texts of each language in a batch of (lang, text), both as bytes."""
    langs = batch.column(0).to_pylist()
    texts = batch.column(1).to_pylist()
    found: dict[bytes, list[bytes]] = {}
    for lang, text in zip(langs, texts):
        found.setdefault(lang, []).append(text)
    yield from found.items()


def _ready(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(named(lang).cast("string"), F.lit("und")).cast("binary").alias("lang"), named(text).cast("binary").alias("text"))


def prefix_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> np.ndarray:
    """How many suffixes start with a word of each hash, over all documents: ``BINS`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BINS, np.int64)
        for batch in batches:
            for name, texts in _by_lang(batch):
                words = Words()
                n = np.bincount(np.fromiter(map(words.__getitem__, tokens(texts)), np.int64), minlength=len(words))
                places = np.fromiter((_place(name, w) for w in words), np.int64, len(words)) & (BINS - 1)
                sums += np.bincount(places[1:], n[1:], BINS).astype(np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())], names=["bin", "n"])

    counted = _ready(docs, lang, text).mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    full = np.zeros(BINS, np.int64)
    full[counted["bin"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    return full


def plan_groups(counts: np.ndarray, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """First group of each bin and over how many groups its two-word prefixes are dealt."""
    parts = np.maximum(1, -(-counts // budget))
    first, at, held = np.zeros(len(counts), np.int64), 0, 0
    for b in np.argsort(counts, kind="stable"):
        n = int(counts[b])
        if parts[b] == 1 and held + n <= budget:
            held += n
        else:
            at, held = at + (held > 0), n
        first[b] = at
        if parts[b] > 1:
            at, held = at + int(parts[b]), 0
    return first, parts


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32, byte planes apart and compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


BLOCK_SCHEMA = "part long, lang binary, n_words long, words_size long, words binary, n long, w1 binary, w2 binary, w3 binary, times binary"


class Suffixes:
    """Counts a task's suffixes of one language."""

    def __init__(self, lang: bytes, first: np.ndarray, parts: np.ndarray):
        self.lang, self.first, self.parts = lang, first, parts
        self._clear()

    def _clear(self) -> None:
        self.words, self.held, self.size = Words(), [], 0

    def add(self, texts: list[bytes]) -> None:
        w = np.fromiter(map(self.words.__getitem__, tokens(texts)), np.int64)
        second, third = np.append(w[1:], 0), np.append(w[2:], (0, 0))[: len(w)]
        third[second == 0] = 0
        key = (w << 42 | second << 21 | third)[w > 0]
        self.held.append(key)
        self.size += len(key)

    @property
    def full(self) -> bool:
        return self.size >= HELD or len(self.words) >= HELD_WORDS // 2

    def blocks(self) -> Iterator[tuple]:
        """One row for each group; nothing is held afterwards."""
        if self.size:
            key, n = np.unique(np.concatenate(self.held), return_counts=True)
            # Words by their rank, so that the words of a group are in order; the end of a piece stays 0.
            spelled = sorted(w for w in self.words if w != END)
            rank = np.zeros(len(self.words), np.int64)
            rank[np.fromiter(map(self.words.__getitem__, spelled), np.int64, len(spelled))] = np.arange(1, len(spelled) + 1)
            names = np.array([END, *spelled], object)
            place = np.fromiter((_place(self.lang, w) for w in names), np.int64, len(names))
            w1, w2, w3 = rank[key >> 42], rank[key >> 21 & HELD_WORDS], rank[key & HELD_WORDS]
            bins = place[w1] & (BINS - 1)
            # A longer prefix goes by its second word; one without is dealt like any other.
            group = self.first[bins] + np.where(self.parts[bins] > 1, (place[w2] >> 13) % self.parts[bins], 0)
            order = np.lexsort((w3, w2, w1, group))
            w1, w2, w3, n, group = (x[order] for x in (w1, w2, w3, n, group))
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(group)]
            for at, to in zip(edges, edges[1:]):
                own = slice(at, to)
                ids = np.unique(np.concatenate((w1[own], w2[own], w3[own], [0])))
                told = b"\n".join(names[ids[1:]])
                x, y, z = (np.searchsorted(ids, w[own]) for w in (w1, w2, w3))
                yield (int(group[at]), self.lang, len(ids) - 1, len(told), pa.compress(told, codec="zstd", asbytes=True), to - at,
                       _pack(np.diff(x, prepend=0)), _pack(y), _pack(z), _pack(n[own]))
        self._clear()


def suffix_blocks(docs: DataFrame, first: np.ndarray, parts: np.ndarray, lang: str = "lang", text: str = "text") -> DataFrame:
    """Distinct suffixes and their counts, one block for each task and group."""
    shared = docs.sparkSession.sparkContext.broadcast((first, parts))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        own: dict[bytes, Suffixes] = {}
        names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
        kinds = pa.schema([(n, pa.int64() if n in ("part", "n_words", "words_size", "n") else pa.binary()) for n in names])

        def told(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            some = list(rows)
            for at in range(0, len(some), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*some[at : at + 1000]), kinds)], schema=kinds)

        for batch in batches:
            for name, texts in _by_lang(batch):
                held = own.setdefault(name, Suffixes(name, *shared.value))
                held.add(texts)
            if sum(s.size for s in own.values()) >= HELD or any(s.full for s in own.values()):
                for held in own.values():
                    yield from told(held.blocks())
                own.clear()
        for held in own.values():
            yield from told(held.blocks())

    return _ready(docs, lang, text).mapInArrow(send, BLOCK_SCHEMA)


NODE_SCHEMA = "lang binary, depth int, w1 binary, w2 binary, w3 binary, f long, f2 long"


def subtree(frame: pd.DataFrame, least: int, split: bool) -> pd.DataFrame:
    """Nodes of a group's subtrees that occur ``least`` times; words of split prefixes are told in parts.

    ``f`` is a node's count and ``f2`` that of its first two words. Depth 0 is the number of suffixes.
    """
    rows = []
    for lang, blocks in frame.groupby("lang", sort=False):
        lists = [pa.decompress(b.words, decompressed_size=b.words_size, codec="zstd", asbytes=True).split(b"\n") if b.n_words else []
                 for b in blocks.itertuples()]
        names = sorted(set().union(*lists))
        number = {w: i for i, w in enumerate(names, 1)}
        keys = []
        for words, b in zip(lists, blocks.itertuples()):
            to = np.array([0, *map(number.__getitem__, words)], np.int64)
            keys.append((to[np.cumsum(_unpack(b.w1, b.n))], to[_unpack(b.w2, b.n)], to[_unpack(b.w3, b.n)], _unpack(b.times, b.n)))
        a, b, c, n = map(np.concatenate, zip(*keys))
        order = np.lexsort((c, b, a))
        a, b, c, n = a[order], b[order], c[order], n[order]
        new1 = np.append(True, a[1:] != a[:-1])
        new2 = new1 | np.append(True, b[1:] != b[:-1])
        new3 = new2 | np.append(True, c[1:] != c[:-1])
        counts = []
        for new in (new1, new2, new3):
            at = np.flatnonzero(new)
            counts.append((at, np.add.reduceat(n, at)))
        spelled = np.array([None, *names], object)
        rows.append(pd.DataFrame({"lang": [lang], "depth": 0, "w1": None, "w2": None, "w3": None, "f": int(n.sum()), "f2": 0}))
        pairs = np.repeat(counts[1][1], np.diff(np.append(counts[1][0], len(n))))
        for depth, (at, f) in enumerate(counts, 1):
            kept = (f >= least) | (split and depth == 1)
            if depth > 1:
                kept &= (b if depth == 2 else c)[at] > 0
            at, f = at[kept], f[kept]
            none = np.full(len(at), None, object)
            rows.append(pd.DataFrame({
                "lang": [lang] * len(at), "depth": depth, "w1": spelled[a[at]], "w2": spelled[b[at]] if depth > 1 else none,
                "w3": spelled[c[at]] if depth > 2 else none, "f": f, "f2": pairs[at]}))
    return pd.concat(rows).astype({"depth": "int32", "f": "int64", "f2": "int64"})


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """lang, depth, w1, w2, w3, f and f2 of all phrases of at most ``DEPTH`` words that occur ``least`` times; depth 0 counts all words."""
    with small_batches(docs.sparkSession):
        first, parts = plan_groups(prefix_counts(docs, lang, text), budget)
        split = np.zeros(int((first + parts).max()), bool)
        for b in np.flatnonzero(parts > 1):
            split[first[b] : first[b] + parts[b]] = True
        shared = docs.sparkSession.sparkContext.broadcast(split)

        def grow(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            return subtree(frame, least, bool(shared.value[key[0]]))

        # A number of its own keeps adaptive execution from joining groups, whose blocks grow when unpacked.
        dealt = suffix_blocks(docs, first, parts, lang, text).repartition(min(len(split), MOST_PARTS), "part")
        nodes = written(dealt.groupBy("part").applyInPandas(grow, NODE_SCHEMA), "phrase-nodes")
    whole = nodes.where("depth > 1")
    # Words of a split prefix, and all languages, are counted in several groups.
    parts_of = nodes.where("depth <= 1").groupBy("lang", "depth", "w1").agg(F.sum("f").alias("f")).where(f"depth = 0 or f >= {least}")
    sums = parts_of.select("lang", "depth", "w1", *(F.lit(None).cast("binary").alias(c) for c in ("w2", "w3")), "f", F.lit(0).cast("long").alias("f2"))
    spelled = lambda c: F.decode(c, "UTF-8").alias(c)
    return whole.unionByName(sums).select(spelled("lang"), "depth", spelled("w1"), spelled("w2"), spelled("w3"), "f", "f2")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a a / (l r)), in whole numbers of 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    scaled = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", scaled, (wide(left) * wide(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, percent: int = COVERED_PERCENT,
                 top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases of two or three words."""
    counts = written(phrase_counts(docs, lang, text, least, budget), "phrase-counts")
    words = counts.where("depth = 1").select("lang", F.col("w1").alias("_w"), F.col("f").alias("_f"))
    head = words.select("lang", F.col("_w").alias("w1"), F.col("_f").alias("f_first"))
    tail = words.select("lang", F.col("_w").alias("_last"), F.col("_f").alias("f_last"))
    pairs = counts.where("depth = 2").select("lang", "w1", "w2", F.col("f").alias("a"))
    triples = counts.where("depth = 3").select("lang", "w1", "w2", "w3", F.col("f").alias("a"), "f2")
    # Longest share that a longer phrase has of a pair: the pair is its start or its end.
    covers = triples.select("lang", "w1", "w2", "a").unionByName(triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    covered = covers.groupBy("lang", "w1", "w2").agg(F.max("a").alias("_most"))
    free = pairs.join(covered, ["lang", "w1", "w2"], "left").where(f"_most is null or 100 * _most < {percent} * a").drop("_most")
    ends = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f_rest"))
    rest = triples.join(ends, ["lang", "w2", "w3"])
    none = F.lit(None).cast("long")
    every = free.select("lang", "w1", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("w2").alias("_last"), "a", none.alias("f2"), none.alias("f_rest")).unionByName(
        rest.select("lang", "w1", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("w3").alias("_last"), "a", "f2", "f_rest"))
    told = every.join(head, ["lang", "w1"]).join(tail, ["lang", "_last"])
    cut = lambda k, left, right: F.struct(_score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
    one = cut(1, F.col("f_first"), F.coalesce("f_rest", "f_last"))
    lowest = F.when(F.col("f_rest").isNull(), one).otherwise(F.least(one, cut(2, F.col("f2"), F.col("f_last"))))
    scored = told.select("lang", "phrase", "a", lowest.alias("_cut")).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    totals = counts.where("depth = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
