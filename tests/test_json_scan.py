"""Ranges of a JSON document against Python's own parser."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from dayloom.sources.json_scan import _entries, _records, _summaries, read_json_array

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("inner", T.StringType())])
TEXTS = ['plain', '}', '"}', '\\', '\\"}', '{"observations": [{"id": 9}]}', ']} [{', 'ä漢𝄞', '', '\\\\}', ',\n}', '"observations":[']


@pytest.fixture
def small_ranges(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def records(n, seed, nested=True):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        row = {"id": i, "text": draw.choice(TEXTS) * draw.choice([1, 1, 3])}
        if nested and draw.random() < 0.4:
            row["inner"] = draw.choice([{}, {"observations": [{"id": 7}, {"x": {"y": ["}"]}}]}, {"a": {"b": {"c": "{" * 5}}}])
        if draw.random() < 0.02:
            row["text"] = "long } text { " * 300
        out.append(row)
    return out


def written(path, document, **style):
    path.write_text(json.dumps(document, ensure_ascii=False, **style) + random.choice(["", "\n", " \n\n"]), encoding="utf-8")
    return str(path)


def expected(rows):
    text = lambda v: v if isinstance(v, str) or v is None else json.dumps(v, ensure_ascii=False, separators=(",", ":"))
    return sorted(((r["id"], r["text"], text(r.get("inner"))) for r in rows), key=repr)


def read(spark, path, name="observations"):
    return sorted((tuple(r) for r in read_json_array(spark, path, SCHEMA, name).select("id", "text", "inner").collect()), key=repr)


@pytest.mark.parametrize("indent", [None, 1])
def test_a_document_in_many_ranges(spark, tmp_path, small_ranges, indent):
    rows = records(500, 1)
    document = {"meta": {"observations": {"rows": [{"id": -1}]}, "other": [{"id": -2}]}, "s": 'x "observations": [{"id": 3}] }',
                "observations": rows, "after": [{"id": -3}], "last": {"observations": [{"id": -4}]}}
    path = written(tmp_path / "d.json", document, indent=indent)
    got = read_json_array(spark, path, SCHEMA, "observations")
    lines = spark.read.option("lineSep", "}").text(path)
    assert lines.rdd.getNumPartitions() > 20
    assert sorted((tuple(r)[1:] for r in got.collect()), key=repr) == expected(rows)


def test_a_document_that_is_an_array_and_several_files(spark, tmp_path, small_ranges):
    first, second = records(120, 2), records(80, 3)
    written(tmp_path / "a.json", first)
    written(tmp_path / "b.json", second, indent=2)
    assert read(spark, str(tmp_path), None) == expected(first + second)
    assert read_json_array(spark, str(tmp_path), SCHEMA).select("document").distinct().count() == 2


def test_documents_without_records(spark, tmp_path):
    written(tmp_path / "a.json", {"observations": [], "x": [1, 2, {"id": 1}]})
    written(tmp_path / "b.json", {"other": {"observations": [{"id": 1}]}})
    written(tmp_path / "c.json", {"observations": [1, "a", None, [{"id": 5}], {"id": 2, "text": "t"}]})
    assert read(spark, str(tmp_path)) == [(2, "t", None)]


def test_a_document_that_ends_too_early_fails(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"observations": records(20, 4)})[:-300])
    with pytest.raises(ValueError, match="not complete"):
        read_json_array(spark, str(path), SCHEMA, "observations")


@settings(max_examples=150, deadline=None)
@given(st.recursive(st.one_of(st.integers(0, 9), st.text('{}[]"\\,: ab', max_size=6)), lambda x: st.one_of(
    st.lists(x, max_size=4), st.dictionaries(st.sampled_from(["observations", "a", "}"]), x, max_size=3)), max_leaves=25),
    st.integers(1, 6), st.integers(1, 3))
def test_any_document_cut_anywhere(value, every, rows_at_once):
    """The two passes in plain Python, over ranges of ``every`` pieces."""
    import pandas as pd

    document = {"a": value, "observations": value if isinstance(value, list) else [value, {"id": 1, "x": value}], "z": value}
    text = json.dumps(document)
    pieces = text.split("}")
    pieces = pieces[:-1] if pieces[-1] == "" else pieces
    frame = pd.DataFrame({"value": pieces, "file": "f", "start": [i // every for i in range(len(pieces))]})
    batches = [frame.iloc[i : i + rows_at_once].reset_index(drop=True) for i in range(0, len(frame), rows_at_once)]
    summaries = [r for part in _summaries("observations")(iter(batches)) for r in part.to_dict("records")]
    found = [part for part in _records("observations", 1, _entries(summaries, 1))(iter(batches))]
    rows = [tuple(r) for part in found for r in part.itertuples(index=False)]
    whole = [json.loads(t) for _, k, _, t in rows if pd.isna(k)]
    parts = {}
    for _, k, n, t in sorted((r for r in rows if not pd.isna(r[1])), key=lambda r: (r[1], r[2])):
        parts[k] = parts.get(k, "") + t
    got = whole + [json.loads(t) for t in parts.values()]
    want = [r for r in document["observations"] if isinstance(r, dict)]
    got = [r for r in got if isinstance(r, dict)]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))
