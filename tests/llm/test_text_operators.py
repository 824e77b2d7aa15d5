"""Quality rules, Jaccard join and substring dedup against brute force, with awkward rows."""

import math
import random
import sys
import uuid

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import helpers  # noqa: E402
from dayloom.llm import jaccard_join, quality, substring_dedup  # noqa: E402
from dayloom.llm.components import components  # noqa: E402

SCHEMA = "doc_id long, text string"


def vocabulary(n):
    return [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in range(n)]


def corpus():
    """Copies, near copies, shared passages, repeats within texts, and rows that hold nothing."""
    random.seed(3)
    words = vocabulary(60)
    text = lambda n: [random.choice(words) for _ in range(n)]
    base, passage = text(120), text(30)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " \n".join(base)), (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "ONE"), (9, "two words")]
    for i in range(12):
        near = list(base)
        for at in random.sample(range(len(near)), 1 + i % 4):
            near[at] = random.choice(words)
        rows.append((20 + i, " ".join(near)))
    for i in range(10):
        rows.append((40 + i, " ".join(text(random.randint(0, 50)) + passage + text(random.randint(0, 50)))))
    rows.append((60, " ".join((text(25)) * 4)))
    rows.append((61, "same " * 200))
    rows.append((62, " ".join(text(6000))))
    rows += [(70 + i, " ".join(text(40))) for i in range(10)]
    return rows


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 50)])
def test_components_equal_brute_force(spark, size, percent):
    rows = corpus() + [(None, " ".join(["ka1"] * 4)), (2, corpus()[0][1]), (2, "two words"), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = jaccard_join.near_duplicates(df, size, percent).collect()
    want = helpers.components(rows, size, percent)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want


def test_one_first_row_per_component(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    got = jaccard_join.near_duplicates(df, 3, 90).collect()
    assert {r["doc_id"] for r in got if r["first_row"]} == {r["component_id"] for r in got}


def test_near_duplicates_of_an_empty_table_and_of_one_group(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(i, "a b c d e f g") for i in range(300)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["first_row"] for r in got) == 1


def test_near_copies_below_the_threshold_do_not_meet_row_by_row(spark, monkeypatch):
    random.seed(5)
    pool = vocabulary(60)
    base = [random.choice(pool) for _ in range(300)]
    rows = []
    for i in range(400):
        near = list(base)
        for at in random.sample(range(300), 9):
            near[at] = random.choice(pool)
        rows.append((i, " ".join(near)))
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(20)]
    counted, real = [], jaccard_join._met

    def met(*given):
        found = real(*given)
        counted.append(found.count())
        return found

    monkeypatch.setattr(jaccard_join, "_met", met)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == helpers.components(rows, 3, 90)
    # 420 texts make 88,000 pairs that share many tokens of their prefixes.
    assert counted[0] < 5 * len(rows)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_substrings_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows + [(None, rows[0][1])], SCHEMA)
    got = {r["doc_id"]: r["dedup"] for r in substring_dedup.remove_repeats(df).collect()}
    for doc_id, n, removed, kept in helpers.cut_repeats(rows + [(None, rows[0][1])]):
        d = got[doc_id]
        assert (d["n_words"], d["n_removed"], d["kept"]) == (n, removed, kept), doc_id
        assert sum(b - a for a, b in zip(d["starts"], d["ends"])) == removed


def test_repeated_rows_are_one_document(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text), (1, "other " + text)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), keep=("doc_id", "text")).collect()
    same = [r["dedup"]["n_removed"] for r in got if r["doc_id"] == 1 and r["text"] == text]
    assert same[0] == same[1]
    # Of the two texts of id 1 one comes first; whichever it is, document 2 keeps nothing.
    assert [r["dedup"]["kept"] for r in got if r["doc_id"] == 2] == [""]
    assert sorted(r["dedup"]["n_removed"] > 0 for r in got) == [False, True, True, True] or \
        sorted(r["dedup"]["n_removed"] > 0 for r in got) == [False, False, True, True]


def test_substrings_of_many_contexts_are_split(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_RUNS", 3)
    rows = corpus()
    got = {r["doc_id"]: r["dedup"]["kept"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {d: kept for d, _, _, kept in helpers.cut_repeats(rows)}


def test_runs_of_a_common_window_are_dealt_to_many_shards(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(substring_dedup, "SHARD_RUNS", 64)
    plain, folder = substring_dedup._repeats, str(tmp_path)

    def counted(rows):
        with open(f"{folder}/{uuid.uuid4()}", "w") as out:
            out.write(str(len(rows)))
        return plain(rows)

    monkeypatch.setattr(substring_dedup, "_repeats", counted)
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(30)] + [passage] + [f"b{i}x{j}" for j in range(30)])) for i in range(1500)]
    got = {r["doc_id"]: r["dedup"]["kept"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {d: kept for d, _, _, kept in helpers.cut_repeats(rows)}
    most = max(int(f.read_text()) for f in tmp_path.iterdir())
    assert most < 600, most


def test_substrings_of_an_empty_table(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_suffix_automaton_matches():
    automaton = substring_dedup.SuffixAutomaton()
    for c in [1, 2, 3, 1, 2, (0,), 2, 3, 4]:
        automaton.add(c)
    assert list(automaton.matches([1, 2, 3, 4, 1, 2, 3, 1, 2], 3)) == [2, 3, 6, 7, 8]
    assert list(automaton.matches([1, 2, 2, 3], 3)) == []


def quality_rows():
    random.seed(9)
    words = vocabulary(40)
    clean = lambda n: " ".join(random.choice(words) for _ in range(n))
    rows = [(i, clean(60) + "\n" + clean(20)) for i in range(40)]
    rows += [(100 + i, " ".join(w + "***" for w in clean(60).split())) for i in range(6)]
    rows += [(200, None), (201, ""), (202, "short text"), (203, "again and again " * 30), (204, "line a\nline b\nline a\n \n \n" + clean(30)),
             (205, clean(3000)), (206, clean(25)), (206, clean(25))]
    return rows


def test_quality_equals_brute_force(spark):
    rows, labels = quality_rows(), [(i, 1, 0) for i in range(30)] + [(100, 0, 0), (3, 1, 0), (None, 1, 0), (31, 1, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", quality string")
    got = quality.quality_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), keep=("doc_id", "text"))
    scores = {row: s for row, s in zip(rows, helpers.quality_scores(rows, labels, quality.BINS))}
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        q, score = r["quality"], scores[r["doc_id"], r["text"]]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"], q["base_failed"]) == helpers.base_figures(r["text"])
        assert math.isclose(q["score"], score, rel_tol=1e-9, abs_tol=1e-9)
        assert q["kept"] == (not q["base_failed"] and score >= quality.THRESHOLD)
    assert not any(r["quality"]["kept"] for r in found if 100 <= r["doc_id"] < 204)


def test_quality_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(quality_rows(), SCHEMA)
    assert {r["quality"]["score"] for r in quality.quality_rules(docs, labels).collect()} == {0.0}
    assert quality.quality_rules(docs.limit(0), labels).collect() == []
