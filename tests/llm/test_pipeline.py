"""The pipeline stage by stage against brute force, and the registered queries."""

import sys

import public_tokenizers as P
import pytest
import tiktoken

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import corpus_pipeline  # noqa: E402
import helpers  # noqa: E402
from dayloom.llm import bpe, quality  # noqa: E402
from dayloom.llm.queries import ORACLES, QUERIES  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


def kept_rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages_equal_brute_force(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    labels = [tuple(r) for r in spark.read.parquet(f"{small_folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    rows = kept_rows(docs)

    df = corpus_pipeline.written(STAGES["quality_rules"](spark, docs, small_folder), "stage")
    scores = helpers.quality_scores(rows, labels, quality.BINS)
    rows = [r for r, s in zip(rows, scores) if not helpers.base_figures(r[1])[-1] and s >= quality.THRESHOLD]
    assert df.columns == docs.columns and kept_rows(df) == rows

    df = corpus_pipeline.written(STAGES["near_duplicates"](spark, df, small_folder), "stage")
    rows = [r for r, c in zip(rows, sorted(helpers.components(rows, 5, 80))) if c[0] == c[2]]
    assert df.columns == docs.columns and kept_rows(df) == rows

    before = dict(rows)
    df = corpus_pipeline.written(STAGES["substring_dedup"](spark, df, small_folder), "stage")
    rows = sorted((i, kept if gone else before[i]) for i, n, gone, kept in helpers.cut_repeats(rows) if not n or gone < n)
    assert df.columns == docs.columns and kept_rows(df) == rows
    assert all(r["n_chars"] == len(r["text"]) for r in df.collect() if r["text"] != before[r["doc_id"]])

    df = corpus_pipeline.written(STAGES["mixing"](spark, df, small_folder), "stage")
    mixed = kept_rows(df)
    assert df.columns == docs.columns and set(mixed) <= set(rows) and max(map(mixed.count, mixed)) <= 3
    size = sum(len(helpers.WORD.findall(t)) for _, t in rows)
    assert abs(sum(len(helpers.WORD.findall(t)) for _, t in mixed) - size) < 0.1 * size

    df = STAGES["byte_bpe"](spark, df, small_folder)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    out = df.collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == mixed
    assert all(list(r["ids"]) == library.encode_ordinary(r["text"]) and r["n_tokens"] == len(r["ids"]) for r in out)


def test_stages_with_awkward_rows(spark, small_folder, tmp_path):
    good = " ".join(f"word{i % 37} and{i % 11}" for i in range(60))
    rows = [(1, good, "en", "a", 9, 1, "x"), (None, good + " more of it here", "en", None, None, 2, "y"), (2, None, None, "a", 0, 3, None),
            (3, "", "en", "a", 0, 4, "z"), (4, "tiny", "en", "b", 4, 5, "z"), (1, good, "en", "a", 9, 1, "x"),
            (5, " ".join(f"q{i}" for i in range(7000)), "en", "b", 0, 6, "z")]
    names = "doc_id long, text string, lang string, source string, n_chars long, `_row` int, `quality` string"
    for name, some in (("some", rows), ("none", [])):
        spark.createDataFrame(some, names).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    out = corpus_pipeline.run(spark, f"{tmp_path}/some")
    assert out.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "_row", "quality"]
    # Both near copies are one group, of which the row without an id comes first.
    assert {(r["doc_id"], r["_row"]) for r in out.collect()} <= {(None, 2), (5, 6)}


def test_every_operator_is_registered():
    assert [sum(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op4_mixing", "op6_jaccard_join", "op8_top_k", "op10_substring_dedup"])
def test_queries_agree_when_run_again(spark, small_folder, name):
    once = sorted(map(repr, QUERIES[name](spark, small_folder).collect()))
    assert once == sorted(map(repr, QUERIES[name](spark, small_folder).collect())) and once


@pytest.mark.parametrize("name", ["op2_quality_rules", "op5_url_filter"])
def test_native_plans_have_no_python(spark, small_folder, name):
    text = QUERIES[name](spark, small_folder)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in text for w in ("Python", "Pandas", "ArrowEval", "ExistingRDD", "Cartesian"))
