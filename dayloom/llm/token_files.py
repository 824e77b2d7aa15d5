"""Token ids in ORC files.

Documents are dealt to ranges of ascending id and sorted, each task encodes its range and
writes one file: run-length encoded integers in stripes, row indexes within them, and a Bloom
filter on the document id. Readers split a file by its stripes, and a look-up of ids skips
files, stripes and row groups by their statistics and filters.

A file's rows know their part and the ids before them in it, so the place of any document in
the whole sequence is a sum over parts, one row for each file.

Defined results: a null text is the empty text, which is only the end id; null document ids
come first; equal ids are ordered by a hash of the text and keep all their rows; an empty
table gives no rows; further columns are ignored. With ``added_tokens`` a text that spells an
added token of the tokenizer holds that token, as the library encodes by default; without, the
characters are text like any other.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "part int, doc_id long, start_in_part long, n_tokens long, ids array<int>"
#: Pieces and words that a worker remembers, each of at most so many characters: some 100 MB.
KNOWN_WORDS, KNOWN_CHARS = 500_000, 40
# Letters and numbers below U+0180, and the tokenizer's pieces of such text.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")
#: Words of such characters are in normal form, and lower-cased character by character they
#: stay among them; U+0130, which does not, is left out.
PLAIN = re.compile("[\x00-\u012f\u0131-\u017f]+")
# The settings of a tokenizer file that the short cut by words and pieces stands for.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Documents encoded together, so that word lists stay small beside long texts.
TOGETHER = 256
#: Plain pieces encoded as one text, with white space between them.
JOINED = 500
#: Control characters that Python's split() takes for white space and the tokenizer does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


class _Words(dict):
    """Numbers keys as they come and lists those that are new."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, word) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    """Encodes texts piece by piece, each new piece once.

    The tokenizer drops white space and none of its pieces crosses it. Texts of plain letters are
    lower-cased and cut into the tokenizer's own pieces; of others, words of plain letters
    are, and any other word is encoded as it is. Pieces are numbered, and a text's ids are gathered by number. What a worker
    remembers is bounded and changes no result. Texts that hold an added token are encoded whole, and so are all
    texts where the file's normalizer or pre-tokenizer is not the one these cuts stand for.
    """

    def __init__(self, file: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(file)
        self._tokenizer.encode_special_tokens = not added_tokens
        added = self._tokenizer.get_added_tokens_decoder().values() if added_tokens else ()
        # What is sought after normalization may be spelled otherwise: then every text is encoded whole.
        self._whole = ("",) if any(a.normalized for a in added) else tuple(a.content for a in added)
        with open(file, encoding="utf-8") as source:
            told = json.load(source)
        if told.get("normalizer") != NORMALIZER or told.get("pre_tokenizer") != PRE_TOKENIZER:
            self._whole = ("",)
        # A text of pieces side by side must hold no added token that its pieces do not hold.
        self._apart = tuple(a.content for a in self._tokenizer.get_added_tokens_decoder().values())
        self._words = _Words()
        self._ends: int | None = None
        # Ids of all numbered words, one after the other, and where each word's begin.
        self._flat, self._starts = np.zeros(0, "<i4"), np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [np.array(e.ids, "<i4").tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """As ``_ids``, for plain pieces: each is one word of their joined text, or all are encoded apart."""
        out = []
        for at in range(0, len(pieces), JOINED):
            some = pieces[at:at + JOINED]
            text = " ".join(some)
            if not any(c in text for c in self._apart):
                told = self._tokenizer.encode(text, add_special_tokens=False)
                words = told.word_ids
                # As many words as pieces, of which each has one at least.
                if words and None not in words and words[-1] == len(some) - 1:
                    ids = np.array(told.ids, "<i4").tobytes()
                    ends = (4 * np.cumsum(np.bincount(words))).tolist()
                    out += [ids[a:b] for a, b in zip([0, *ends], ends)]
                    continue
            out += self._ids(some)
        return out

    def _cut(self, text: str) -> list:
        """Pieces and words of a text in order; a text to encode whole is a tuple."""
        if any(c in text for c in (*NOT_SPACE, *self._whole)):
            return [(text,)]
        if PLAIN.fullmatch(text):
            return PIECE.findall(text.lower())
        out = []
        for word in text.split():
            # A word that is not plain is no piece of a plain one, so both may be keys.
            out += PIECE.findall(word.lower()) if PLAIN.fullmatch(word) else [word]
        return out

    def _number(self, words: list) -> None:
        """Appends the ids of what was numbered last; None is the end of a text."""
        # Only pieces of plain letters may be joined; texts encoded whole and words as they are may not.
        joined = [isinstance(w, str) and PLAIN.fullmatch(w) is not None for w in words]
        pieces = iter(self._piece_ids([w for w, plain in zip(words, joined) if plain]))
        others = iter(self._ids([w if isinstance(w, str) else w[0] for w, plain in zip(words, joined) if not plain and w is not None]))
        last = np.array([self._ends], "<i4").tobytes()
        ids = [next(pieces) if plain else last if w is None else next(others) for w, plain in zip(words, joined)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self._flat = np.concatenate((self._flat, np.frombuffer(b"".join(ids), "<i4")))
        self._starts = np.concatenate((self._starts, self._starts[-1] + np.cumsum(sizes)))

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with its end, and how many each has."""
        if end != self._ends:
            self._words, self._ends, self._flat, self._starts = _Words(), end, self._flat[:0], self._starts[:1]
        every, counts = [], []
        for t in texts:
            before = len(every)
            every += self._cut(t)
            every.append(None)
            counts.append(len(every) - before)
        known = self._words
        had = len(known)
        numbers = np.fromiter(map(known.__getitem__, every), np.int64, len(every))
        self._number(known.new)
        sizes = np.diff(self._starts)[numbers]
        to = np.cumsum(sizes)
        # Each id's place: that of its word's first one, and on from there.
        ids = self._flat[np.repeat(self._starts[numbers] - to + sizes, sizes) + np.arange(to[-1] if len(to) else 0)]
        ends = np.cumsum(counts)
        per_text = np.diff(to[ends - 1], prepend=0) if len(ends) else np.zeros(0, np.int64)
        # New words stay as long as there is room; numbers of the others are given back.
        keep = [w for w in known.new if w is None or isinstance(w, str) and len(w) <= KNOWN_CHARS]
        if had >= KNOWN_WORDS or len(keep) < len(known.new):
            for w in known.new:
                del known[w]
            self._flat, self._starts = self._flat[: self._starts[had]], self._starts[: had + 1]
            known.new.clear()
            if had < KNOWN_WORDS:
                for w in keep:
                    known[w]
                self._number(known.new)
        known.new.clear()
        return ids, per_text


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def _encoder(file: str, added_tokens: bool) -> WordEncoder:
    if (file, added_tokens) not in _ENCODERS:
        _ENCODERS[file, added_tokens] = WordEncoder(file, added_tokens)
    return _ENCODERS[file, added_tokens]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text",
                      added_tokens: bool = False) -> None:
    """Encodes every document and writes the files below ``path``, ascending by id."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text")
    kinds = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()),
                       ("ids", pa.list_(pa.int32()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(tokenizer, added_tokens), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(at, TOGETHER)
                ids, sizes = encoder.encode(some.column(1).to_pylist(), end)
                starts = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                parts = pa.array(np.full(len(sizes), part, np.int32))
                yield pa.RecordBatch.from_arrays([parts, some.column(0), pa.array(starts), pa.array(sizes), lists], schema=kinds)

    ordered.mapInArrow(encode, SCHEMA).write.options(**{
        "compression": "zstd",
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": "0.01",
        "orc.row.index.stride": "1000",
        "orc.stripe.size": str(64 << 20),
    }).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The rows of some documents; stripes and row groups without them are not decoded."""
    return read_token_files(spark, path).where(F.col("doc_id").isin([int(i) for i in ids]))


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files alone."""
    stored = read_token_files(spark, path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file goes through this window.
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    kinds = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()),
                       ("ids_crc32", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy()
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                schema=kinds)

    digests = stored.select("part", "doc_id", "start_in_part", "ids").mapInArrow(
        digest, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")
    return digests.join(parts, "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"
    )
