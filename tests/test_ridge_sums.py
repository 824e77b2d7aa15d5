"""Sums by batch against fits of all rows."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayloom.operators.ridge import fit_ridge
from dayloom.operators.ridge_sums import RidgeState, model_from_sums, ridge_sums

NUMERIC, TEXT, SCHEMA = ["a", "b"], ["c", "d"], "k string, batch int, a double, b double, y double, c string, d string"


def random_rows(n, seed, shift=0.0):
    draw = random.Random(seed)
    maybe = lambda v: None if draw.random() < 0.15 else v
    return [(draw.choice("pq"), draw.randrange(4), maybe(draw.gauss(shift, 3)), maybe(draw.choice([draw.gauss(5, 1), float("nan"), float("inf")])),
             maybe(draw.gauss(2 * shift, 9)), maybe(draw.choice("uvw")), maybe(draw.choice("xyz"))) for _ in range(n)]


def told(model, by):
    return {tuple(r[k] for k in by): (r["n"], r["intercept"], dict(r["weights"]), dict(r["means"])) for r in model.collect()}


def agree(got, want, rel=1e-9):
    assert set(got) == set(want)
    for key, (n, intercept, weights, means) in want.items():
        assert got[key][0] == n and got[key][1] == pytest.approx(intercept, rel=rel, abs=1e-7)
        assert got[key][2] == pytest.approx(weights, rel=rel, abs=1e-9) and got[key][3] == pytest.approx(means, rel=rel, abs=1e-9)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_sums_by_batch_fit_like_all_rows(spark, by):
    df = spark.createDataFrame(random_rows(400, 1, 1e6) + random_rows(300, 2, -1e6), SCHEMA)
    sums = ridge_sums(df, NUMERIC, "y", TEXT, by, ["batch"])
    agree(told(model_from_sums(sums, NUMERIC, "y", TEXT, 1.0, by), by), told(fit_ridge(df, NUMERIC, "y", TEXT, 1.0, by), by), 1e-7)


def test_deletes_are_rows_of_negative_sign(spark, tmp_path):
    state = RidgeState(spark, str(tmp_path), NUMERIC, "y", TEXT, ["k"])
    parts = [spark.createDataFrame(random_rows(200, s, s), SCHEMA) for s in (1, 2, 3)]
    assert state.batches() == [] and not state.apply(9)
    with pytest.raises(ValueError):
        state.sums()
    assert state.apply(1, parts[0]) and state.apply(2, parts[1]) and not state.apply(2, parts[2])
    only_u = parts[0].filter("c = 'u'")
    assert state.apply(3, parts[2], removed=only_u)
    left = parts[0].filter("c is null or c <> 'u'").unionByName(parts[1]).unionByName(parts[2])
    agree(told(state.model(), ["k"]), told(fit_ridge(left, NUMERIC, "y", TEXT, 1.0, ["k"]), ["k"]))
    state.apply(4, removed=left.filter("k = 'p'"))
    assert set(told(state.model(), ["k"])) == {("q",)}


def test_a_batch_without_its_mark_does_not_count(spark, tmp_path):
    state = RidgeState(spark, str(tmp_path), NUMERIC, "y", TEXT)
    one, two = (spark.createDataFrame(random_rows(60, s), SCHEMA) for s in (4, 5))
    state.apply(1, one)
    ridge_sums(two, NUMERIC, "y", TEXT).write.parquet(f"{tmp_path}/sums/batch=2")
    want = told(fit_ridge(one, NUMERIC, "y", TEXT), [])
    agree(told(state.model(), []), want)
    state.apply(2, one.limit(0))
    agree(told(state.model(), []), want)


@settings(max_examples=4, deadline=None)
@given(st.integers(1, 40), st.integers(0, 99))
def test_any_cut_into_batches(spark, n, seed):
    df = spark.createDataFrame(random_rows(n, seed), SCHEMA).filter(F.col("y").isNotNull())
    got = told(model_from_sums(ridge_sums(df, NUMERIC, "y", TEXT, [], ["batch"]), NUMERIC, "y", TEXT), [])
    agree(got, told(fit_ridge(df, NUMERIC, "y", TEXT), []), 1e-7)
