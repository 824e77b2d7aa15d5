"""Byte-level BPE encoding and decoding with Spark higher-order functions.

A text is cut into words by a pattern. A word's bytes are folded by ranked merges: in each
step the neighbouring pair of lowest rank, the leftmost of equal ones, becomes one piece,
until no pair has a rank. Ranks come from a literal map, hashed into buckets so that a look-up
reads a few entries. Decoding looks up each id's bytes in a literal array and concatenates.

Distinct words are folded once: all documents are counted, the words that occur in the most
documents (``KNOWN_WORDS``, a bound on what every task holds) are folded ahead, and their ids are a
literal map for the second pass. Any other word is folded where it stands, by the same fold, so
the bound never changes a result and no word of the corpus is left out.

Defined results: a null text is encoded as the empty text, which has no ids and decodes to no
bytes; repeated rows are encoded each; an empty table gives no rows; columns to keep are named,
others are ignored. A word longer than its neighbours costs a step per merge.
"""

from __future__ import annotations

import base64
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayloom.llm.common import named, written

#: Pairs are keyed ``left * SIDE + right`` and dealt to a prime number of buckets.
RANK_BUCKETS, SIDE = 131071, 1 << 20
#: Rank of a pair that no token joins, and the bit from which a piece's number holds its rank: ids and
#: ranks have 20 bits, places in a word 23.
NEVER, RANK_AT = SIDE - 1, 43
#: The numbers of bytes and the number of a word's edges.
BYTES = 257
#: Most words whose ids are folded ahead, and the longest of them in bytes: some 120 bytes each.
KNOWN_WORDS, KNOWN_BYTES, WORD_BUCKETS = 1 << 18, 32, 1 << 18

# Unicode white space, and the letters and numbers that the public tokenizer library
# knows (Unicode 16) and Java 17 does not (Unicode 13), as ranges of code points.
SPACE = r"\t\n\x0B\f\r \x85\xA0  -     　"
NEWER_LETTERS = """
870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 1C89-1C8A 2C2F 2C5F 9FFD-9FFF A7C0-A7C1
A7CB-A7CD A7D0-A7D1 A7D3 A7D5-A7DC A7F2-A7F4 10570-1057A 1057C-1058A 1058C-10592 10594-10595
10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 105C0-105F3 10780-10785 10787-107B0 107B2-107BA
10D4A-10D65 10D6F-10D85 10EC2-10EC4 10F70-10F81 11071-11072 11075 1123F-11240 11380-11389 1138B
1138E 11390-113B5 113B7 113D1 113D3 11740-11746 11AB0-11ABF 11BC0-11BE0 11F02 11F04-11F10
11F12-11F33 12F90-12FF0 1342F 13441-13446 13460-143FA 16100-1611D 16A70-16ABE 16D40-16D6C 18CFF
1AFF0-1AFF3 1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D
1E290-1E2AD 1E4D0-1E4EB 1E5D0-1E5ED 1E5F0 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE
2A6DE-2A6DF 2B735-2B739 2EBF0-2EE5D 31350-323AF
"""
NEWER_NUMBERS = """
10D40-10D49 116D0-116E3 11BF0-11BF9 11F50-11F59 16130-16139 16AC0-16AC9 16D70-16D79
1CCF0-1CCF9 1D2C0-1D2D3 1E4F0-1E4F9 1E5F1-1E5FA
"""
#: Texts without a character from here on have none of the newer ones.
NEWER_FROM = 0x870


def _ranges(listed: str) -> str:
    return "".join("-".join(rf"\x{{{end}}}" for end in entry.split("-")) for entry in listed.split())


def java_pattern(pattern: str, newer: bool = True) -> str:
    """The pattern with white space spelled out, and with newer letters and numbers, for Java."""
    more = {r"\p{L}": _ranges(NEWER_LETTERS) if newer else "", r"\p{N}": _ranges(NEWER_NUMBERS) if newer else ""}
    out, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\.|\[|\])", pattern):
        if part in more and more[part]:
            part = part + more[part] if inside else f"[{part}{more[part]}]"
        elif part == r"\s":
            part = SPACE if inside else f"[{SPACE}]"
        elif part == r"\S":
            part = f"[^{SPACE}]"
        inside = part == "[" or inside and part != "]"
        out.append(part)
    return "".join(out)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row: the end of a fold over nothing, which copies no result."""
    return F.aggregate(F.array(), value, lambda same, _: same, body)


def _packed(rows: DataFrame, buckets: int, key: str, value: str) -> DataFrame:
    """One row and column: an array of buckets, each a map from ``key`` to ``value``, or null where there is none.

    ``rows`` has ``bucket``. All of it must fit a task; that is for the caller's bounds. A map is one
    block of memory, read in one or two places by a look-up.
    """
    each = rows.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct(key, value))).alias("_in"))
    every = rows.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(each, "bucket", "left")
    ordered = every.agg(F.sort_array(F.collect_list(F.struct("bucket", "_in"))).alias("_all"))
    return ordered.select(F.transform("_all", lambda b: F.map_from_entries(b["_in"])).alias("t"))


def _word_bucket(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(WORD_BUCKETS))


class Vocabulary:
    """Look-up tables of a rank file's contents, as literals of a few MB.

    A token's rank is its id. The rank map is keyed by pairs of ids: each way to cut a token
    into two tokens is an entry, so that the pair's joined bytes need not be built to be ranked.
    Scalar subqueries make the tables once and tasks get each as one block of bytes; ``t`` below
    holds them by name.
    """

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        pairs = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    key = left * SIDE + right
                    pairs.append((key % RANK_BUCKETS, key, rank))
        singles = [*(ranks[bytes([b])] for b in range(256)), SIDE - 1]
        two = {(token[0], token[1]): rank for token, rank in ranks.items() if len(token) == 2}
        first = [(a * BYTES + b, (two.get((a, b), NEVER) << RANK_AT) + singles[a]) for a in range(BYTES) for b in range(BYTES)]
        pieces = [(rank, token.hex()) for token, rank in ranks.items()]
        self._tables = {
            "rank": _packed(spark.createDataFrame(pairs, "bucket int, key long, id int"), RANK_BUCKETS, "key", "id"),
            # Made by Spark: as a literal of text the table would be copied with every step of the plan.
            "first": spark.createDataFrame(first, "pair int, piece long").agg(
                F.transform(F.sort_array(F.collect_list(F.struct("pair", "piece"))), lambda x: x["piece"])),
            "pieces": spark.range(max(ranks.values()) + 1).select(F.col("id").cast("int").alias("rank")).join(
                spark.createDataFrame(pieces, "rank int, hex string"), "rank", "left"
            ).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "hex"))), lambda x: x["hex"])),
        }

    def know(self, words: DataFrame) -> None:
        """Adds the ids of words folded before: word and ids, a bounded number of rows."""
        self._tables["words"] = _packed(words.withColumn("bucket", _word_bucket(F.col("word"))), WORD_BUCKETS, "word", "ids")

    def applied(self, df: DataFrame, body, *tables: str) -> DataFrame:
        """``df`` with the column ``_told``: what ``body`` makes of the tables."""
        told = F.struct(*(self._tables[t].scalar().alias(t) for t in tables))

        def bound(t, found: dict):
            """``body`` with every table taken out of the struct once for each row."""
            if len(found) == len(tables):
                return body(found)
            table = tables[len(found)]
            return _let(t[table], lambda v: bound(t, {**found, table: v}))

        # Used once, the value goes into the expression and not through a row of its own.
        return df.withColumn("_tables", told).select(
            *map(named, df.columns), _let(F.col("_tables"), lambda t: bound(t, {})).alias("_told"))

    @staticmethod
    def rank(t: dict, left: Column, right: Column) -> Column:
        """The rank of two neighbours joined, or ``NEVER``."""
        key = left * SIDE + right
        return F.coalesce(F.get(t["rank"], F.pmod(key, F.lit(RANK_BUCKETS)).cast("int"))[key], F.lit(NEVER))

    @classmethod
    def fold(cls, t: dict, word: Column) -> Column:
        """Ids of one word given as bytes.

        A piece is one number: its rank with the piece after it, its place, its id. The least number is
        the leftmost pair of least rank. A piece that joins nothing stands before the first, null after the last.
        """
        of = lambda rank, rest: F.shiftleft(rank.cast("long"), RANK_AT) + rest
        token = lambda x: x.bitwiseAND(F.lit(SIDE - 1))
        rest = lambda x: x.bitwiseAND(F.lit((1 << RANK_AT) - 1))
        # Each byte as the character of that number, between two of the number that no byte has.
        edge = F.lit(chr(BYTES - 1))
        letters = F.transform(F.split(F.concat(edge, F.decode(word, "ISO-8859-1"), edge), ""), lambda c: F.ascii(c))
        first = lambda b, i, each: F.get(t["first"], b * BYTES + F.get(each, i + 1)) + i.cast("long") * SIDE
        start = _let(letters, lambda each: F.transform(each, lambda b, i: first(b, i, each)))

        def merge(x, _):
            def joined(least, m):
                """Three pieces out, two in: the numbers differ, and this costs less than slices put together."""
                before, after, new = F.get(x, m - 2), F.get(x, m + 1), F.shiftright(least, RANK_AT)
                left = reduce(F.array_remove, (before, least, F.get(x, m)), x)
                put = F.array_insert(left, m - 1, of(cls.rank(t, new, token(after)), rest(least) - token(least) + new))
                return F.array_insert(put, m - 1, of(cls.rank(t, token(before), new), rest(before)))

            return _let(F.array_min(x), lambda least: F.when(F.shiftright(least, RANK_AT) == NEVER, x).otherwise(
                _let(F.array_position(x, least).cast("int"), lambda m: joined(least, m))))

        told = lambda x: F.transform(F.slice(x, F.lit(2), F.size(x) - 2), lambda v: token(v).cast("int"))
        folded = F.aggregate(F.sequence(F.lit(1), F.octet_length(word)), start, merge, told)
        return F.when(F.octet_length(word) == 0, F.array().cast("array<int>")).otherwise(folded)

    @classmethod
    def look_up(cls, t: dict, word: Column) -> Column:
        """Ids of a word: known ones, or else its fold."""
        return F.coalesce(F.get(t["words"], _word_bucket(word))[word], cls.fold(t, word.cast("binary")))

    @staticmethod
    def decode(t: dict, ids: Column) -> Column:
        """The bytes of ids, each id's piece after the other."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(t["pieces"], i)), ""))


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the bytes that an array of ids stands for; a null array gives null."""
    vocabulary = Vocabulary(df.sparkSession, ranks)
    return vocabulary.applied(df, lambda t: vocabulary.decode(t, named(ids)), "pieces").withColumnRenamed("_told", name)


def text_words(text: Column, pattern: str) -> Column:
    """All matches of the pattern; only texts that may need it pay for the long one."""
    full = F.coalesce(text, F.lit(""))
    found = lambda newer: F.regexp_extract_all(full, F.lit(java_pattern(pattern, newer)), F.lit(0))
    return F.when(full.rlike(rf"[\x{{{NEWER_FROM:X}}}-\x{{10FFFF}}]"), found(True)).otherwise(found(False))


def known_words(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text",
                rows: int = KNOWN_WORDS) -> DataFrame:
    """word and ids of the words that most documents hold, at most ``rows``, folded once each.

    The words are those above a number of documents, which comes from how many words each number has:
    no task ranks them. Words that share the last number are all in or all out.
    """
    found = docs.select(F.explode(F.array_distinct(text_words(named(text), pattern))).alias("word"))
    counts = found.where(F.octet_length("word") <= KNOWN_BYTES).groupBy("word").agg(F.count("*").alias("n"))
    often = written(counts.where("n > 1"), "bpe-counts")
    # One row for each number of documents goes through this window.
    so_far = F.sum("words").over(Window.orderBy(F.desc("n")))
    least = often.groupBy("n").agg(F.count("*").alias("words")).select("n", so_far.alias("words")).where(
        F.col("words") <= rows).agg(F.min("n")).first()[0]
    top = often.where(F.lit(False) if least is None else F.col("n") >= least).select("word")
    # Dealt anew, so that all cores fold.
    folded = vocabulary.applied(
        top.repartition(F.xxhash64("word")), lambda t: vocabulary.fold(t, F.col("word").cast("binary")), "rank", "first")
    return written(folded.select("word", F.col("_told").alias("ids")), "bpe-words")


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           keep: tuple[str, ...] = ("doc_id",), rows: int = KNOWN_WORDS) -> DataFrame:
    """``keep`` and a struct ``bpe`` of ``ids``, the whole text's ids in order, and ``decoded``, their bytes."""
    vocabulary = Vocabulary(docs.sparkSession, ranks)
    vocabulary.know(known_words(docs, vocabulary, pattern, text, rows))
    names = [f"_keep_{i}" for i in range(len(keep))]
    ready = docs.select(*(named(c).alias(n) for n, c in zip(names, keep)), named(text).alias("_text"))

    def told(t):
        ids = F.flatten(F.transform(text_words(F.col("_text"), pattern), lambda w: vocabulary.look_up(t, w)))
        return _let(ids, lambda i: F.struct(i.alias("ids"), vocabulary.decode(t, i).alias("decoded")))

    encoded = vocabulary.applied(ready, told, "rank", "first", "words", "pieces")
    return encoded.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), F.col("_told").alias("bpe"))
