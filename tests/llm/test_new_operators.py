"""Toxicity, Merkle manifest and collocations against brute force, with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayloom.llm import collocations, merkle, toxicity
from dayloom.llm.queries import QUERIES
from dayloom.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# Collocations

def phrases(rows, least=10, percent=50, top=2000):
    """Collocations of (text, lang) rows in plain Python."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        longer = Counter()
        for p, a in f.items():
            if len(p) == 3 and a >= least:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least or len(p) == 2 and longer[p] and 100 * longer[p] >= percent * a:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def mined(docs, **more):
    return sorted(tuple(r) for r in collocations.collocations(docs, **more).collect())


@pytest.mark.parametrize("budget", [collocations.BUDGET, 50])
def test_collocations_equal_brute_force(spark, budget):
    random.seed(3)
    vocabulary = ["the", "The", "of", "é", "漢字", "x", "new", "york", "a\x00b", "ﬀ", "𝄞", "Z\x1c"]
    text = lambda n: "".join(random.choice(vocabulary) + random.choice([" ", " ", " ", "\t ", ". ", "\n", "!?", "\x0b"]) for _ in range(n))
    rows = [(text(n), random.choice(["en", "de", None, "und", ""])) for n in (0, 1, 2, 50, 400, 900, 30, 700) for _ in range(4)]
    rows += [(None, "en"), ("", None), ("same words again and again " * 30, "en"), ("ab " * 3000, "fr")] * 2
    docs = spark.createDataFrame([(i, t, lang, 1, 2) for i, (t, lang) in enumerate(rows)], "doc_id int, text string, lang string, w1 int, part int")
    assert mined(docs.repartition(5), budget=budget) == phrases(rows)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.text("ab .\tA", max_size=60), st.sampled_from(["x", None])), max_size=6), st.integers(1, 4), st.integers(1, 30))
def test_collocations_of_any_text(spark, rows, least, budget):
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert mined(docs, least=least, top=5, budget=budget) == phrases(rows, least, top=5)


def test_collocations_of_nothing_and_long_texts(spark):
    assert mined(spark.createDataFrame([], "text string, lang string")) == []
    long = [("one two three " * 300_000 + "w" * 1_000_000, "en")]
    assert mined(spark.createDataFrame(long, "text string, lang string")) == phrases(long)


def test_groups_keep_to_the_budget_and_hold_whole_prefixes():
    counts = np.array([0, 5, 900, 3, 100, 40, 0, 260])
    first, parts = collocations.plan_groups(counts, 100)
    assert list(parts) == [1, 1, 9, 1, 1, 1, 1, 3]
    held = Counter()
    for f, p, n in zip(first, parts, counts):
        for j in range(p):
            held[f + j] += n / p
    assert max(held.values()) <= 100 and len(held) == max(held) + 1


def test_blocks_of_a_task_are_flushed_and_merged(monkeypatch):
    monkeypatch.setattr(collocations, "HELD", 1)
    first, parts = collocations.plan_groups(np.full(collocations.BINS, 3), 10)
    held = collocations.Suffixes(b"en", first, parts)
    rows = []
    for text in (b"a b c. a b", b"a b c", b"c c c"):
        held.add([text])
        rows += held.blocks()
    names = [c.split()[0] for c in collocations.BLOCK_SCHEMA.split(", ")]
    frame = pa.table([pa.array(x) for x in zip(*rows)], names=names).to_pandas()
    nodes = [collocations.subtree(g, 1, False) for _, g in frame.groupby("part")]
    told = {(r.w1, r.w2, r.w3): r.f for n in nodes for r in n.itertuples() if r.depth}
    assert told == {(b"a", None, None): 3, (b"a", b"b", None): 3, (b"a", b"b", b"c"): 2, (b"b", None, None): 3, (b"b", b"c", None): 2,
                    (b"c", None, None): 5, (b"c", b"c", None): 2, (b"c", b"c", b"c"): 1}


def test_collocations_query_equals_brute_force(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    expected = phrases([(r["text"], r["lang"]) for r in docs.collect()])
    assert sorted(tuple(r) for r in QUERIES["op13_collocations"](spark, small_folder).collect()) == expected and expected


# Merkle manifest

def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, low=False):
    doc_id, text, lang, source, n_chars = row
    text = text.translate(LOWER) if low and text is not None else text
    return merkle.digest(*map(told, (doc_id, source, lang, n_chars, text)))


def tree_of(nodes):
    """Root of a list of digests, and for each the siblings (left, right) of every level."""
    proofs, at, now = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(now) > 1:
        for i, place in enumerate(at):
            run = now[place // 8 * 8 : place // 8 * 8 + 8]
            proofs[i].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
        now = [hashlib.sha256("".join(now[i : i + 8]).encode()).hexdigest() for i in range(0, len(now), 8)]
        at = [p // 8 for p in at]
    return now[0], proofs


def manifest_of(rows, tampered=lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 0):
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append(row)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        built[lang] = tree_of([leaf_of(r) for r in trees[lang]])
    root, tops = tree_of([built[x][0] for x in order]) if order else (None, [])
    out = []
    for lang, top in zip(order, tops):
        subroot, proofs = built[lang]
        for row, proof in zip(trees[lang], proofs):
            end = leaf_of(row, tampered(row[0]))
            for left, right in proof + top:
                end = merkle.digest(left, end, right)
            out.append((row[0], leaf_of(row), subroot, root, merkle.digest("".join(a + b for a, b in proof + top)), end, end == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def proved(docs, **more):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return sorted((tuple(r) for r in merkle.manifest(docs, tampered, **more).select(*COLUMNS).collect()), key=repr)


def awkward(n=90):
    random.seed(9)
    rows = [(i, random.choice(["A b", "ä", "", None, "Long " * 50]), random.choice(["en", "en", "en", None, "", "=", "de"]), "s", i) for i in range(n)]
    rows += [(None, "no id", "en", None, None), (None, None, "en", None, None), (5, "again", "en", "s", 1), *[(7, "Copy", "en", "s", 1)] * 11]
    return rows + [((1 << 60) + 1, "Big", "en", "s", 1), (-3, "x" * 3_000_000 + "Y", "lone", None, 1)]


@pytest.mark.parametrize("block_levels", [1, 2, 4])
def test_manifest_equals_brute_force(spark, block_levels):
    rows = awkward()
    docs = spark.createDataFrame(rows, DOCS).withColumn("tree", F.lit("own")).withColumn("leaf", F.lit(1)).withColumn("idx", F.lit(2))
    assert proved(docs.repartition(4), block_levels=block_levels) == manifest_of(rows)


def test_manifest_of_nothing_and_of_one(spark):
    assert proved(spark.createDataFrame([], DOCS)) == []
    one = [(1, "T", None, "s", 1)]
    got = proved(spark.createDataFrame(one, DOCS))
    assert got == manifest_of(one) and got[0][1] == got[0][2] == got[0][3]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 700))
def test_witnesses_grow_with_every_append(n):
    tree, values = merkle.Tree(), [str(i) for i in range(n)]
    nodes = [tree.append(v) for v in values]
    height = merkle.levels(n)
    root = tree.close(height)
    expected, proofs = tree_of(values)
    assert root == expected and [merkle.witness(x, height) for x in nodes] == proofs
    assert all(merkle.folded(v, p) == root for v, p in zip(values, proofs))


def test_partial_witnesses_are_extended_by_later_siblings():
    tree = merkle.Tree()
    a, b = tree.append("a"), tree.append("b")
    assert (a.left, a.right, b.left, b.right) == ("", "b", "a", "")
    tree.append("c")
    assert (a.right, b.right) == ("bc", "c") and a.parent is None
    for x in "defgh":
        tree.append(x)
    assert a.parent is b.parent is not None and a.parent.right == ""
    for x in "ijklmnop":
        tree.append(x)
    assert a.parent.right == tree.open[1][1].digest


def test_manifest_grows_by_batches(spark):
    rows = sorted(awkward(60)[:60], key=lambda r: r[0])
    kept = merkle.Manifest(spark, scratch_path(spark, "manifest"), block_levels=1)
    assert kept.roots().collect() == [] and kept.prove().collect() == []
    for batch, (a, b) in enumerate([(0, 20), (20, 20), (20, 60)]):
        assert kept.append(batch, spark.createDataFrame(rows[a:b], DOCS))
        assert not kept.append(batch, spark.createDataFrame(rows, DOCS))
        expected = manifest_of(rows[:b], lambda i: False)
        assert sorted((tuple(r) for r in kept.prove().select(*COLUMNS).collect()), key=repr) == expected
        assert {(r["subroot"], r["root"]) for r in kept.roots().collect()} == {(x[2], x[3]) for x in expected}
    with pytest.raises(ValueError):
        kept.append(-1, spark.createDataFrame(rows, DOCS))


def test_a_manifest_batch_that_was_cut_off_is_written_anew(spark):
    kept = merkle.Manifest(spark, scratch_path(spark, "manifest"))
    rows = awkward(30)[:30]
    kept.append(1, spark.createDataFrame(rows[:10], DOCS))
    spark.createDataFrame([("=en", 99, "f" * 64, None, 10)], "tree string, doc_id long, leaf string, altered string, idx long").write.parquet(
        f"{kept.folder}/leaves/batch=2")
    assert {r["root"] for r in kept.roots().collect()} == {manifest_of(rows[:10])[0][3]}
    kept.append(2, spark.createDataFrame(rows[10:], DOCS))
    assert sorted(r["leaf"] for r in kept.prove().collect()) == sorted(map(leaf_of, rows))


def test_manifest_query_equals_brute_force(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, small_folder).select(*COLUMNS).collect()), key=repr)
    assert got == manifest_of(rows) and len({r[-1] for r in got}) == 2


# Toxicity

def buckets(text):
    """Subwords of each window, one text at a time, in plain Python."""
    words = re.findall(r"[a-z0-9\u0080-￿]+", text.lower())
    return [[g for w in words[i : i + toxicity.WINDOW] for n in toxicity.SIZES for g in (f"|{w}|"[j : j + n] for j in range(len(w) + 3 - n))]
            for i in range(0, len(words), toxicity.WINDOW)]


def test_subwords_are_the_ngrams_of_each_window():
    texts = ["", None, "a", "Ab-cd  éfg." * 30, "...", "x" * 50, " tail", "one two"]
    bags = toxicity.subwords(texts)
    got = [Counter() for _ in bags.document]
    groups = list(bags.groups())
    for bucket, window in groups:
        for w in window:
            got[w]["n"] += 1
    expected = [(i, w) for i, t in enumerate(texts) for w in buckets(t or "")]
    words = [len(re.findall(r"[a-z0-9\u0080-￿]+", (t or "").lower())) for t in texts]
    assert list(bags.document) == [i for i, _ in expected]
    per_word = sum(words)
    assert sum(c["n"] for c in got) == sum(len(w) for _, w in expected) + per_word
    # Equal words have equal subwords wherever they stand.
    same = toxicity.subwords(["word", "other word", "word"])
    sets = [set() for _ in same.document]
    for bucket, window in same.groups():
        for b, w in zip(bucket, window):
            sets[w].add(int(b))
    assert sets[0] == sets[2] <= sets[1]


def toxic_rows(n=400):
    random.seed(4)
    neutral = ["".join(random.choice("abcdefghilmnorstu") for _ in range(random.randint(2, 8))) for _ in range(800)]
    stems = ["grumblor", "snidewick", "vexatrous"]
    rows = []
    for i in range(n):
        w = [random.choice(neutral) for _ in range(random.choice([30, 100, 700]))]
        if i % 2:
            for _ in range(2):
                w.insert(random.randrange(len(w)), random.choice(stems) + random.choice(["", "s", "ish", "en", "qx"]))
        rows.append((i, " ".join(w), i % 2))
    return rows, neutral


def test_unseen_misspellings_count_and_clean_texts_do_not(spark):
    rows, neutral = toxic_rows()
    model = toxicity.train([t for _, t, _ in rows[:300]], np.array([y for _, _, y in rows[:300]]))
    assert np.mean([(z > 0) == y for z, (_, _, y) in zip(model.logits([t for _, t, _ in rows[300:]]), rows[300:])]) > 0.95
    clean = " ".join(neutral[:300])
    z = model.logits([clean, clean + " grumbblor", clean + " snidewicck vexatrus", None, "", "?!"])
    assert z[0] < 0 < z[1] and z[2] > 0 and all(np.isneginf(z[3:]))


def test_scores_of_awkward_rows(spark):
    rows, _ = toxic_rows(120)
    docs = spark.createDataFrame([(i, t, i, 0.5) for i, t, _ in rows] + [(None, None, 1, 1.0), (999, "", 1, 1.0), (3, rows[3][1], 1, 1.0), (1000, rows[1][1] * 400, 1, 1.0)],
                                 "doc_id long, text string, _text int, toxicity double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (7, None), (12345, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.col("_id") % 5 != 0)
    out = toxicity.score(docs, model, keep=("doc_id", "_text", "toxicity"), label="told").collect()
    assert len(out) == 124 and all(0 <= r["told"] <= 1 for r in out)
    assert [r["told"] for r in out if r["doc_id"] in (None, 999)] == [0.0, 0.0]
    assert len({r["told"] for r in out if r["doc_id"] == 3}) == 1 and [r["told"] > 0.5 for r in out if r["doc_id"] == 1000] == [True]
    again = toxicity.score(docs, toxicity.fit(docs, labels, F.col("_id") % 5 != 0), label="told").collect()
    assert sorted(r["told"] for r in again) == sorted(r["told"] for r in out)
    none = docs.limit(0)
    assert toxicity.score(none, model).collect() == [] and toxicity.fit(none, labels, F.lit(True)) is None
    assert toxicity.fit(docs, labels.where("toxic = 0"), F.lit(True)) is None
    assert {r["toxicity"] for r in toxicity.score(docs, None).collect()} == {0.0}


def test_only_learn_rows_are_used(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    ids = [r["_id"] for r in toxicity.sample_ids(labels, F.col("_id") % 5 != 0, rows=12).collect()]
    assert len(ids) == 24 and all(i % 5 for i in ids)


def test_held_out_accuracy_on_the_test_tables(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op11_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(truth[r["doc_id"]], r["predicted"], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    caught = [p for y, p, _ in held if y == 1]
    left = [p for y, p, _ in held if y == 0]
    assert np.mean(caught) > 0.65 and np.mean(left) < 0.05
    ranked = [y for _, _, y in sorted((s, random.random(), y) for y, _, s in held)]
    places = [i for i, y in enumerate(ranked) if y == 1]
    auc = (sum(places) - len(places) * (len(places) - 1) / 2) / (len(places) * (len(ranked) - len(places)))
    assert auc > 0.9
