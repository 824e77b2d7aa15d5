import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from support import plan_of, values
from dayloom.operators.evaluate import (
    backtest, forecast, has_labels, last_days, mape, score_history, split_rows, train_if_labelled,
)
from dayloom.operators.ridge import fit_ridge, predict

DAY0 = dt.date(2024, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def rows(n=300, keys="ab", seed=3):
    rng = random.Random(seed)
    out = []
    for k in keys:
        for i in range(n):
            a, b = rng.gauss(1e6, 3), rng.choice([None, rng.gauss(5, 2)])
            c = rng.choice(["x", "y", "z", None])
            y = None if i >= n - 20 else 2 * a - 3 * (b or 0) + {"x": 4, "y": -1}.get(c, 0) + rng.gauss(0, 1)
            out.append((k, day(i), a, b, c, y))
    return out


SCHEMA = "k string, date date, a double, b double, c string, y double"


def direct(data, l2, categorical):
    """Normal equations with an unpenalised intercept, solved on the whole matrix."""
    data = [r for r in data if r[5] is not None]
    mean_b = np.mean([r[3] for r in data if r[3] is not None])
    levels = sorted({r[4] for r in data if r[4]}) if categorical else []
    x = np.array([[r[2], mean_b if r[3] is None else r[3], *[float(r[4] == v) for v in levels]] for r in data])
    y = np.array([r[5] for r in data])
    mx, my = x.mean(0), y.mean()
    xc = x - mx
    w = np.linalg.solve(xc.T @ xc + l2 * np.eye(x.shape[1]), xc.T @ (y - my))
    return dict(zip(["a", "b", *[f"c={v}" for v in levels]], w)), my - w @ mx


@pytest.mark.parametrize("l2", [1.0, 50.0])
@pytest.mark.parametrize("categorical", [[], ["c"]])
@pytest.mark.parametrize("salts", [None, 4])
def test_ridge_against_direct_solution(spark, l2, categorical, salts):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    model = {r.k: r for r in fit_ridge(df, ["a", "b"], "y", categorical, l2, ["k"], salts).collect()}
    for k in "ab":
        weights, intercept = direct([r for r in data if r[0] == k], l2, categorical)
        assert model[k].n == 280
        assert model[k].weights == pytest.approx(weights, rel=1e-6)
        assert model[k].intercept == pytest.approx(intercept, rel=1e-6)


def test_ridge_without_key_agrees_with_library(spark):
    """The library's penalty is scaled by n and by the label's spread."""
    data = [r for r in rows(keys="a") if r[3] is not None and r[5] is not None]
    df = spark.createDataFrame(data, SCHEMA).withColumn("a", F.col("a") - 1e6)
    ours = fit_ridge(df, ["a", "b"], "y", l2=5.0).first()
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df)
    spread = df.agg(F.stddev_pop("y")).first()[0]
    theirs = LinearRegression(
        featuresCol="f", labelCol="y", solver="normal", standardization=False,
        elasticNetParam=0.0, regParam=5.0 * spread / len(data),
    ).fit(vectors)
    assert [ours.weights["a"], ours.weights["b"]] == pytest.approx(list(theirs.coefficients), rel=1e-6)
    assert ours.intercept == pytest.approx(theirs.intercept, rel=1e-6)


def test_predict_with_gaps_and_unseen_levels(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    model = fit_ridge(df, ["a", "b"], "y", ["c"], by=["k"])
    fresh = spark.createDataFrame([("a", day(0), 1e6, None, "w", None), ("q", day(0), 1.0, 1.0, "x", None)], SCHEMA)
    got = predict(fresh, model, ["a", "b"], "p", ["c"], ["k"])
    weights, intercept = direct([r for r in data if r[0] == "a"], 1.0, ["c"])
    mean_b = np.mean([r[3] for r in data if r[0] == "a" and r[5] is not None and r[3] is not None])
    assert got.columns == [*fresh.columns, "p"]
    assert [r.k for r in got.collect()] == ["a"]
    assert got.first().p == pytest.approx(intercept + weights["a"] * 1e6 + weights["b"] * mean_b, rel=1e-9)


def test_many_levels_of_several_categories(spark):
    """Sums grow with pairs of values, not with combinations of all categories."""
    data = [("k", i % 97, i % 89, i % 83, float(i % 7), float(i % 7 + (i % 97 == 3) * 5)) for i in range(3000)]
    df = spark.createDataFrame([(k, str(a), str(b), str(c), x, y) for k, a, b, c, x, y in data],
                               "k string, a string, b string, c string, x double, y double")
    model = fit_ridge(df, ["x"], "y", ["a", "b", "c"], by=["k"]).first()
    assert len(model.weights) == 1 + 97 + 89 + 83
    columns = np.array([[x, *(a == i for i in range(97)), *(b == i for i in range(89)), *(c == i for i in range(83))]
                        for _, a, b, c, x, _ in data], float)
    y = np.array([r[-1] for r in data])
    centred = columns - columns.mean(axis=0)
    want = np.linalg.solve(centred.T @ centred + np.eye(columns.shape[1]), centred.T @ (y - y.mean()))
    got = [model.weights["x"], *(model.weights[f"a={i}"] for i in range(97)), *(model.weights[f"b={i}"] for i in range(89)),
           *(model.weights[f"c={i}"] for i in range(83))]
    assert np.allclose(got, want, atol=1e-8)


def test_nan_and_infinity_count_as_missing(spark):
    clean = [(float(i), float(2 * i) if i % 5 else None) for i in range(50)]
    odd = [(x, float("nan") if y is None else y) for x, y in clean] + [(1.0, float("inf")), (float("nan"), 4.0)]
    fit = lambda rows: fit_ridge(spark.createDataFrame(rows, "x double, y double"), ["x"], "y").first()
    a, b = fit(clean + [(None, 4.0)]), fit(odd)
    assert (a.n, a.weights) == (b.n, b.weights) and a.intercept == pytest.approx(b.intercept)
    model = fit_ridge(spark.createDataFrame(odd, "x double, y double"), ["x"], "y")
    scored = predict(spark.createDataFrame([(float("nan"),), (None,)], "x double"), model, ["x"], "p").collect()
    assert scored[0].p == scored[1].p and scored[0].p == scored[0].p


def test_ridge_shuffles_once_for_gathered_series(spark):
    df = spark.createDataFrame(rows(60), SCHEMA).repartition(8, "k")
    text = plan_of(fit_ridge(df, ["a", "b"], "y", ["c"], by=["k"]))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_features_of_very_different_size(spark):
    rng = random.Random(5)
    data = []
    for i in range(400):
        big, small, c = rng.gauss(0, 1e12), rng.gauss(0, 1e-3), "rare" if i % 100 == 0 else "x"
        data.append((big, small, c, 1e-12 * big + 500 * small + (3.0 if c == "rare" else 0.0)))
    df = spark.createDataFrame(data, "big double, small double, c string, y double")
    weights = fit_ridge(df, ["big", "small"], "y", ["c"], l2=1e-9).first().weights
    assert weights["big"] == pytest.approx(1e-12, rel=1e-6)
    assert weights["small"] == pytest.approx(500, rel=1e-3)
    assert weights["c=rare"] - weights["c=x"] == pytest.approx(3.0, rel=1e-6)


def test_all_null_feature(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (2.0, None, 4.0), (3.0, None, 6.0)], "a double, b double, y double")
    model = fit_ridge(df, ["a", "b"], "y").first()
    assert model.weights["b"] == 0.0 and model.weights["a"] == pytest.approx(4 / 3)


def history(spark):
    data = [(k, day(i), float(i), float(i + 40) if i < 60 else None) for k in "ab" for i in range(100)]
    return spark.createDataFrame(data, "k string, date date, y double, target_40 double")


@pytest.mark.parametrize("by", [[], ["k"]])
def test_forecast_and_backtest(spark, by):
    df = history(spark) if by else history(spark).filter("k = 'a'").drop("k")
    model = fit_ridge(df, ["y"], "target_40", l2=0.0, by=by)
    ahead = forecast(df, model, ["y"], by=by)
    assert ahead.count() == 40 * max(1, 2 * len(by))
    spans = ahead.agg(F.min("forecast_date"), F.max("forecast_date")).first()
    assert tuple(spans) == (day(100), day(139))
    past = backtest(score_history(df, model, ["y"], by=by), df, by=by, train_until=day(70))
    first = past.orderBy("prediction_date").first()
    assert first.forecast_date == day(40) and first.actual == 40.0
    assert first.yhat_40 == pytest.approx(40.0) and first.in_sample
    assert past.filter("actual is null").count() == 40 * max(1, 2 * len(by))


def test_last_days_uses_dates_not_rows(spark):
    df = spark.createDataFrame([("a", day(0)), ("a", day(9)), ("b", day(5))], "k string, date date")
    assert values(last_days(df, 2, by=["k"])) == [("a", day(9)), ("b", day(5))]
    assert values(last_days(df, 5)) == [("a", day(9)), ("b", day(5))]


def test_mape(spark):
    df = spark.createDataFrame([("a", 10.0, 8.0), ("a", 0.0, 5.0), ("a", None, 1.0), ("b", -4.0, -2.0)],
                               "k string, actual double, p double")
    assert values(mape(df, "actual", "p", ["k"])) == [("a", 20.0), ("b", -50.0)]
    assert mape(df.filter("k = 'a'"), "actual", "p").first().mape == 20.0


def test_guard_and_split(spark):
    df = history(spark)
    assert has_labels(df, "target_40")
    none = df.filter("target_40 is null")
    assert train_if_labelled(none, ["y"], "target_40") is None
    assert train_if_labelled(df, ["y"], "target_40", by=["k"]).count() == 2
    train, held = split_rows(df, 10)
    assert (train.count(), held.count()) == (180, 20)
