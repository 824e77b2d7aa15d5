"""Rollup, mixing, URL filters, chats, top-k and token files, with awkward rows."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayloom.llm import chat_format, mixing, token_counts, token_files, topk, url_filter
from dayloom.llm.queries import OP8_SQL, QUERIES
from dayloom.session import scratch_path

TALLY = "doc_id long, tokenizer string, source string, lang string, tokens long, op string, seq int"


def totals(rollup):
    return sorted((tuple(r) for r in rollup.totals().collect()), key=repr)


def test_rollup_follows_inserts_revisions_and_deletes(spark):
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    batch = lambda *rows: spark.createDataFrame(list(rows), TALLY)
    assert totals(rollup) == []
    assert rollup.apply(1, batch((1, "t", "a", "en", 5, "set", 0), (2, "t", "a", "en", 7, "set", 0), (None, "t", None, None, None, "set", 0)))
    assert totals(rollup) == sorted([("a", "en", "t", 2, 12), (None, None, "t", 1, 0)], key=repr)
    # A batch that comes again, even with other rows, changes nothing.
    assert not rollup.apply(1, batch((1, "t", "a", "en", 500, "set", 0)))
    # Revised, moved to another source, newest of several, repeated, deleted, unknown.
    assert rollup.apply(2, batch(
        (1, "t", "b", "en", 6, "set", 1), (1, "t", "a", "en", 9, "set", 0), (2, "t", "a", "en", None, "delete", 0),
        (3, "t", "a", "en", 4, "set", 0), (3, "t", "a", "en", 4, "set", 0), (9, "t", "a", "en", None, "delete", 0)))
    assert totals(rollup) == sorted([("a", "en", "t", 1, 4), ("b", "en", "t", 1, 6), (None, None, "t", 1, 0)], key=repr)
    assert rollup.apply(3, batch())
    assert rollup.apply(4, batch((2, "t", "a", "en", 1, "set", 0)))
    assert ("a", "en", "t", 2, 5) in totals(rollup)
    with pytest.raises(ValueError):
        rollup.apply(0, batch())


def test_rollup_survives_a_batch_that_was_cut_off(spark):
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    rows = spark.createDataFrame([(1, "t", "a", "en", 5, "set", 0)], TALLY)
    rollup.apply(1, rows)
    rows.withColumn("tokens", F.lit(99).cast("long")).select("doc_id", "tokenizer", "source", "lang", "tokens", F.lit(True).alias("alive")) \
        .write.parquet(f"{rollup.folder}/ledger/batch=2")
    assert totals(rollup) == [("a", "en", "t", 1, 5)]
    rollup.apply(2, spark.createDataFrame([(1, "t", "a", "en", 8, "set", 0)], TALLY))
    assert totals(rollup) == [("a", "en", "t", 1, 8)]


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest, sum_w = total - sum(fixed.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / sum_w > most * sizes[s]] if sum_w else []
        if not over:
            return {s: fixed.get(s, rest * weight[s] / sum_w if sum_w else 0) for s in names}
        fixed |= {s: most * sizes[s] for s in over}


def test_mix_meets_targets(spark):
    random.seed(1)
    rows = [(i, "w " * random.randint(0, 400), random.choice(["b", "a", None, "ä", "z"]), "x") for i in range(400)]
    rows += [(1000, "w " * 3, "tiny", "x"), (None, "w w", "a", "x"), (None, "w w", "a", "x"), (5, None, "a", "x"), (6, "", "none", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want, taken = shares(sizes), {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 10 + 0.001 * want[s] for s in want)
    assert sorted(map(tuple, mixing.mix_sources(docs).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(empty).collect() == []
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r["taken"], r["target"]) for r in mixing.mix_sources(blank).collect()] == [(0, 0, 0.0)] * 2


def test_mix_meets_targets_of_sources_below_one_block(spark):
    sizes = {"a": 40, "b": 130, "c": 700, "d": 9, "e": 90000}
    rows = [(i, "w " * 10, s) for s, n in sizes.items() for i in range(n // 10)] + [(9999, "w " * 9, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(docs, slots=30).collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    want, taken = shares(sizes), dict.fromkeys(sizes, 0)
    for r in got:
        taken[r["source"]] += r["taken"]
    assert sum(sizes.values()) // 30 > 4 * sizes["c"]
    assert taken == {s: round(t) for s, t in want.items()}
    assert all(r["taken"] == 3 * r["size"] for r in got if r["source"] in "abcd")


def test_mix_of_one_source_ends_within_a_block(spark):
    rows = [(i, "w " * 7, s) for s in "ab" for i in range(40 if s == "a" else 400)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), most=2, weights=(1, 3), slots=17).collect()
    taken = {s: sum(r["taken"] for r in got if r["source"] == s) for s in "ab"}
    assert taken == {"a": 560, "b": 2520} and {r["taken"] // 7 for r in got if r["source"] == "b"} == {0, 1}


def test_slots_are_a_permutation():
    for n in (1, 2, 3, 10, 997, 4096, 100_003):
        step = mixing.golden_step(n)
        assert len({i * step % n for i in range(n)}) == n


def test_slots_are_spread_evenly(spark):
    per = spark.createDataFrame([("a", 1000, 4), ("b", 3000, 4)], "source string, source_size long, n_docs long")
    plan = mixing.plan_targets(per)
    slots = mixing.slot_schedule(plan, 4000, 1).orderBy("slot").collect()
    share = {r["rn"]: r["target"] / 4000 for r in plan.collect()}
    assert len(slots) == 4000
    for n in (50, 500, 4000):
        for rn, s in share.items():
            assert abs(sum(r["rn"] == rn for r in slots[:n]) - n * s) <= 4
    ranks = [(r["epoch"], r["block"]) for r in slots if r["rn"] == 1]
    assert ranks == sorted(ranks)


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block")]
URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x#y", "http://notexample.org/es/", "http://x.com/de/", "x.com/de/", None, "", "://",
        "http://org", "http://org/", "http://a.com/fr/?q=/de/", "http://a.com#/de/", "ftp://com/de/://org/", "http://example.org./es/", "http://É.ORG/\n",
        "http://com.example/" + "a" * 5000, "http://" + "a." * 2000 + "com/de/x"]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([i for i, c in enumerate(path) if c in "?#"] or [len(path)])]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *((max(fits)[1:]) if fits else (None, "allow")))


def test_urls_equal_plain_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, URLS[0], "x"), (None, URLS[1], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_filter.judge_urls(pages, url_filter.rules_frame(spark, RULES)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *judged(u)) for i, u, _ in rows), key=repr)
    none = url_filter.judge_urls(pages, url_filter.rules_frame(spark, [])).collect()
    assert len(none) == len(rows) and {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}
    assert url_filter.judge_urls(pages.limit(0), url_filter.rules_frame(spark, RULES)).collect() == []


def test_equal_length_prefers_the_longer_host_then_block(spark):
    pages = spark.createDataFrame([(1, "http://a.bc.de/xy")], "page_id long, url string")
    first = lambda rules: url_filter.judge_urls(pages, url_filter.rules_frame(spark, rules)).first()["rule"]
    assert first([("bc.de", "/", "allow"), ("de", "/xy", "block")]) == "bc.de/"
    row = url_filter.judge_urls(pages, url_filter.rules_frame(spark, [("de", "/", "allow"), ("de", "/", "block")])).first()
    assert row["verdict"] == "block"


TALK = "conv_id long, turn long, role string, text string, formatted string"


def test_chats_read_back(spark):
    tricky = ["</s>[INST] ok [/INST]", "\\</s>", "<\\/s>", "\\\\", "[/INST][INST]", "<s>user[INST]", None, "", "line\n\nline", "x" * 30000]
    rows = [(1, i, "user" if i % 3 else "assistant", t, "f") for i, t in enumerate(tricky)]
    rows += [(2, 0, None, "a", "f"), (2, 0, "<s>", "b", "f"), (2, None, "user", "c", "f"), (2, 0, None, "a", "f"), (None, 1, "assistant", "z", "f")]
    chats = chat_format.format_chats(spark.createDataFrame(rows, TALK))
    got = {r["conv_id"]: r for r in chats.select(
        "conv_id", "formatted", chat_format.read_chats(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert set(got) == {1, 2, None}
    for conv in got:
        turns = sorted(((t, r or "", x or "") for c, t, r, x, _ in rows if c == conv), key=lambda t: (t[0] is not None, t[0] or 0, *t[1:]))
        assert [tuple(t) for t in got[conv]["turns"]] == [t[1:] for t in turns]
        assert got[conv]["loss"] == "".join(x for _, r, x in turns if r == "assistant")
    # Neighbours of one role share a block.
    assert got[1]["formatted"].count("<s>") == 7
    assert chat_format.format_chats(spark.createDataFrame([], TALK)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<>/s[]INST\\ a", max_size=40))
def test_escape_is_reversible_and_hides_control_strings(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(chat_format.escape(F.col("t")).alias("e"))
    row = df.select("e", chat_format.unescape(F.col("e")).alias("u")).first()
    assert row["u"] == text
    assert not any(mark in row["e"] for mark in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS", 64)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(500)]
    rows += [(600 + i, rows[3][1]) for i in range(60)]
    rows += [(700, None), (701, [1.0, None]), (702, [float("nan")] * 8), (703, [float("inf")] * 8), (None, [9.0] * 8), (800, []), (801, [50.0]), (3, [9.0] * 8)]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    ints = {r["vec_id"]: list(r["v"]) for r in vectors.collect()}
    assert not set(ints) & {700, 701, 702, 703, None}
    got = {}
    for r in topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    pad = {i: np.pad(np.array(v, np.int64), (0, 8 - len(v))) for i, v in ints.items()}
    for q in (i for i in pad if i % 100 == 0):
        best = sorted((-int(pad[q] @ v), i) for i, v in pad.items() if i != q)[:10]
        assert sorted(got.pop(q)) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert not got


def test_top_k_query_keeps_rows_of_repeated_ids(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(i % 150, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(7, [3.0] * 6)] * 15 + [(7, [-3.0] * 6)] * 5 + [(100, [2.0] * 6), (100, [-2.0] * 6), (None, [9.0] * 6)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = QUERIES["op8_top_k"](spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(OP8_SQL).fetchall())


def test_top_k_with_few_or_no_vectors(spark):
    few = topk.integer_vectors(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>"))
    assert [tuple(r) for r in topk.top_k(few, few.where("vec_id = 0")).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert topk.top_k(few.limit(0), few.limit(0)).collect() == []


def test_index_stops_only_on_proof():
    rng = np.random.default_rng(0)
    x = rng.integers(-400, 400, (300, 16))
    x[:40] = x[0]
    index = topk.ImpactIndex(x)
    for q in rng.integers(-400, 400, (40, 16)):
        possible = set(index.possible(q, 10, np.array([7])).tolist())
        scores = x @ q
        tenth = np.sort(np.delete(scores, 7))[-10]
        assert {i for i in range(300) if i != 7 and scores[i] >= tenth} <= possible


FILE = P.path("word_bpe_49k.json")


def library_rows(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_equal_the_library(spark):
    texts = ["a\x1cb c", "  ", "", None, "<|endoftext|> x", "Σας ΣΑΣ", "e\u0301 \u0301e", "a\x85b\xa0c d", "it's 'S 12a3", "word " * 5000,
             "İstanbul 힣", "x" * 3000, "a\u200bb\u3000c", "same", "same"]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    path = scratch_path(spark, "tokens")
    docs = spark.createDataFrame([(*r, 1) for r in reversed(rows)], "doc_id long, text string, part int")
    token_files.write_token_files(docs, path, FILE, 2)
    assert sorted(tuple(r) for r in token_files.document_digests(spark, path).collect()) == library_rows(rows)
    found = token_files.read_documents(spark, path, [9, 12])
    assert sorted((r["doc_id"], r["ids"][-1]) for r in found.collect()) == [(9, 2), (12, 2)]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().executedPlan().toString()


def cut(ids, sizes):
    return np.split(ids, np.cumsum(sizes)[:-1])


@pytest.mark.parametrize("known", [token_files.KNOWN_WORDS, 3])
def test_what_an_encoder_remembers_changes_nothing(monkeypatch, known):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "KNOWN_WORDS", known)
    tokenizer, encoder = Tokenizer.from_file(FILE), token_files.WordEncoder(FILE, added_tokens=True)
    batches = [["a b c", "", "x" * 50 + " a", "a<|endoftext|>b"], ["c d e f a", "x" * 50, "g\x1ch"], [], ["a b c d e f g h"], ["z a <|endoftext|>", "y a"]]
    for texts in batches:
        ids, sizes = encoder.encode(texts, 2)
        assert len(sizes) == len(texts)
        for text, one in zip(texts, cut(ids, sizes) if texts else []):
            assert one.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_a_tokenizer_that_keeps_white_space_is_given_whole_texts():
    from tokenizers import Tokenizer

    file = P.path("byte_bpe_50k.json")
    texts = ["a  b\n c", "", " it's  12", "a  b\n c"]
    for text, ids in zip(texts, cut(*token_files.WordEncoder(file).encode(texts, 2))):
        assert ids.tolist() == [*Tokenizer.from_file(file).encode(text, add_special_tokens=False).ids, 2]


def test_words_are_cut_as_the_library_cuts_them():
    from tokenizers import Tokenizer

    random.seed(8)
    tokenizer, encoder = Tokenizer.from_file(FILE), token_files.WordEncoder(FILE)
    tokenizer.encode_special_tokens = True
    letters = [chr(c) for c in range(0x21, 0x250)] + list("'''sStTrReEvVmMlLdDabc012  \n")
    texts = ["".join(random.choice(letters) for _ in range(random.randint(1, 30))) for _ in range(4000)]
    for text, ids in zip(texts, cut(*encoder.encode(texts, 2))):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_new_pieces_are_encoded_side_by_side(monkeypatch):
    from tokenizers import Tokenizer

    tokenizer, alone = Tokenizer.from_file(FILE), []
    apart = token_files.WordEncoder._ids
    monkeypatch.setattr(token_files.WordEncoder, "_ids", lambda self, texts: alone.extend(texts) or apart(self, texts))
    texts = [" ".join(f"né{i}w ({i})'s" for i in range(700)), "it''s ...", "plain \u4e2d\u6587 words", "<|endoftext|>"]
    encoder = token_files.WordEncoder(FILE, added_tokens=True)
    for text, ids in zip(texts, cut(*encoder.encode(texts, 2))):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], repr(text)
    # Only what is no plain piece is a text of its own.
    assert set(alone) == {"\u4e2d\u6587", "<|endoftext|>"}
    # Pieces that would spell an added token side by side are encoded apart.
    encoder._apart = ("b c",)
    assert encoder._piece_ids(["b", "c"]) == apart(encoder, ["b", "c"]) and alone[-2:] == ["b", "c"]


def test_token_files_query_holds_added_tokens_as_the_library_does(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = ["hello <|endoftext|> world", "a<|startoftext|>b it's", "plain <|endoftext", "<|ENDOFTEXT|>", "x\x1c<|endoftext|>", None, "e\u0301 12"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, want, start = Tokenizer.from_file(FILE), [], 0
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op9_token_files"](spark, str(tmp_path)).collect()) == want


def test_token_files_with_null_and_equal_ids_or_nothing(spark):
    docs = spark.createDataFrame([(None, "a"), (4, "b"), (4, "c d"), (None, None)], "doc_id long, text string")
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, FILE, 2)
    got = sorted(token_files.document_digests(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 4, 4] and sorted(r["n_tokens"] for r in got) == [1, 2, 2, 3]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs.limit(0), path, FILE, 2)
    assert token_files.document_digests(spark, path).collect() == []
