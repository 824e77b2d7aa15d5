"""Byte-level BPE against the public tokenizer library."""

import hashlib
import random

import pytest
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

from dayloom.llm import bpe

RANKS = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def encoded(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["bpe"] for r in bpe.encode(docs, RANKS, P.PATTERN, **more).collect()}


def odd_texts():
    random.seed(5)
    letters = "abcdefghij  \n\t'.,0123é€漢𝄞ßÆ  ́<|endoftext|>"
    texts = ["".join(random.choice(letters) for _ in range(n)) for n in (1, 2, 5, 30, 300, 2000)]
    newer = "".join(map(chr, (0x870, 0x9FFD, 0x10570, 0x31350, 0x10D40, 0x1E5FA, 0x2A6DE)))
    return [None, "", " ", "\n\n  x", "it's we'll I'M 'S", "a" * 3000, "ab" * 700, "x" + newer + "1" + newer,
            "\x1c\x1d\x85a\x0bb", "word " * 4000, "same", "same", *texts]


@pytest.mark.parametrize("rows", [bpe.KNOWN_WORDS, 1])
def test_ids_and_round_trip_as_the_library(spark, rows):
    texts = odd_texts()
    got = encoded(spark, texts, rows=rows)
    for i, text in enumerate(texts):
        assert list(got[i]["ids"]) == LIBRARY.encode_ordinary(text or ""), repr(text)[:60]
        assert bytes(got[i]["decoded"]) == (text or "").encode()


def test_known_words_are_those_above_a_number_of_documents(spark):
    texts = ["a b c d", "a b c d", "a b", "a", "e " + "x" * 40, "x" * 40]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    vocabulary = bpe.Vocabulary(spark, RANKS)
    known = lambda rows: sorted(r["word"] for r in bpe.known_words(docs, vocabulary, P.PATTERN, rows=rows).collect())
    # " c" and " d" share their number; long words and those of one document are never known.
    assert known(4) == [" b", " c", " d", "a"] and known(3) == [" b", "a"] and known(1) == ["a"] and known(0) == []
    texts = [*texts, None, "c a d b"]
    for i, one in encoded(spark, texts, rows=3).items():
        assert list(one["ids"]) == LIBRARY.encode_ordinary(texts[i] or "")


def test_fold_of_single_words_and_its_plan(spark):
    random.seed(11)
    words = ["a", "aa", "aaa", "aaaa", "abababa", "\x00", "\xff", "é", "漢字", "a" * 257, " " * 70]
    words += ["".join(random.choice("aeinrst hé漢") for _ in range(random.randint(1, 40))) for _ in range(400)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    # Nothing but the pieces at the end is sliced, and no value is named by a transform, which would copy it.
    plan = bpe.encode(df, RANKS, P.PATTERN, text="word", keep=("word",))._jdf.queryExecution().analyzed().toString()
    assert plan.count("slice(") == 1 and "transform(array(" not in plan
    vocabulary = bpe.Vocabulary(spark, RANKS)
    folded = vocabulary.applied(df, lambda t: vocabulary.fold(t, F.col("word").cast("binary")), "rank", "first")
    for word, ids in folded.collect():
        assert list(ids) == LIBRARY._encode_single_piece(word), word


def test_newer_letters_and_numbers_are_split_as_the_library_does(spark):
    marks = [chr(c) for c in range(0x80, 0x32400, 7) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{m}b 1{m}2 {m}" for m in marks]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    split = {r["doc_id"]: r["w"] for r in docs.select("doc_id", bpe.text_words(F.col("text"), P.PATTERN).alias("w")).collect()}
    for i, text in enumerate(texts):
        ids = [t for w in split[i] for t in LIBRARY.encode_single_piece(w.encode())] if hasattr(LIBRARY, "encode_single_piece") else \
            [t for w in split[i] for t in LIBRARY._encode_single_piece(w)]
        assert ids == LIBRARY.encode_ordinary(text), text


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, RANKS, P.PATTERN).collect() == []
    odd = spark.createDataFrame([(1, "a b", 7, 8, 9)], "doc_id long, text string, ids int, `_text` int, `a.b` int")
    row = bpe.encode(odd, RANKS, P.PATTERN, keep=tuple(odd.columns)).first()
    assert (row["ids"], row["_text"], row["a.b"]) == (7, 8, 9)
    assert list(row["bpe"]["ids"]) == LIBRARY.encode_ordinary("a b")


def test_decode_of_a_column(spark):
    ids = LIBRARY.encode_ordinary("Größe 12\n")
    df = spark.createDataFrame([(1, ids), (2, []), (3, None)], "k int, ids array<int>")
    got = {r["k"]: r["decoded"] for r in bpe.decode(df, RANKS).collect()}
    assert bytes(got[1]) == "Größe 12\n".encode() and bytes(got[2]) == b"" and got[3] is None


def test_query_equals_the_library(spark, small_folder):
    from dayloom.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small_folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op1_byte_bpe"](spark, small_folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
