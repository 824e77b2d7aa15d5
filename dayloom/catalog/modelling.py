"""Ridge models, forecasts, backtests, error metric and the guard."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom.catalog.registry import query, table
from dayloom.catalog.series import (
    AVERAGED,
    ORDER_FILLED,
    START,
    features_sql,
    money,
    order_measures,
    order_top,
    rounded,
)
from dayloom.operators.evaluate import (
    backtest,
    forecast,
    held_out,
    mape,
    score_history,
)
from dayloom.operators.features import feature_matrix
from dayloom.operators.ridge import fit_ridge, predict
from dayloom.operators.spine import as_of_daily
from dayloom.session import scratch_path

BY = ["series"]
ONE = ["y_lag1"]
TWO = ["y_lag1", "y_lag7"]
ALL = ["y", "y_lag1", "y_lag7", "y_lag28", *AVERAGED]
TEXT = ["dow", "mon"]

FEATURES = f"{ORDER_FILLED}, features AS ({features_sql('filled', 'series')})"
# One feature in closed form: slope = Sxy / (Sxx + 1), missing x counts as its mean.
ONE_MODEL = f"""
    {FEATURES},
    means AS (
      SELECT series, avg(y_lag1) AS mx, avg(target_40) AS my FROM features
      WHERE target_40 IS NOT NULL GROUP BY 1),
    model AS (
      SELECT series, count(*) AS n, any_value(mx) AS mx, any_value(my) AS my,
             sum((coalesce(y_lag1, mx) - mx) * (target_40 - my))
               / (sum((coalesce(y_lag1, mx) - mx) ** 2) + 1.0) AS slope
      FROM features JOIN means USING (series) WHERE target_40 IS NOT NULL GROUP BY 1),
    scored AS (
      SELECT f.series, f.date, f.y, f.target_40,
             my + slope * (coalesce(y_lag1, mx) - mx) AS yhat
      FROM features f JOIN model USING (series))
"""


def features(spark, folder):
    """The features, built once and written: models, scores and outcomes read the same rows."""
    top = order_top(spark, folder).select("hi").scalar()
    dense = as_of_daily(order_measures(spark, folder), "date", BY, START, top)
    built = feature_matrix(dense, "price_a", AVERAGED, by=BY)
    path = scratch_path(spark, "features")
    built.write.parquet(path)
    return spark.read.schema(built.schema).parquet(path)


@query(
    "ridge_fit",
    f"""
    WITH {ONE_MODEL}
    SELECT series, n, round(slope, 6) AS slope, round(my - slope * mx, 3) AS intercept FROM model
    """,
)
def ridge_fit(spark, folder):
    model = fit_ridge(features(spark, folder), ONE, "target_40", by=BY)
    return model.select(
        "series",
        "n",
        F.round(F.element_at("weights", "y_lag1"), 6).alias("slope"),
        F.round("intercept", 3).alias("intercept"),
    )


@query(
    "ridge_predict",
    f"WITH {ONE_MODEL} SELECT series, date, target_40, round(yhat, 3) AS yhat FROM scored",
)
def ridge_predict(spark, folder):
    rows = features(spark, folder)
    scored = predict(rows, fit_ridge(rows, ONE, "target_40", by=BY), ONE, "yhat", by=BY)
    return scored.select("series", "date", "target_40", F.round("yhat", 3).alias("yhat"))


@query(
    "forecast_horizon",
    f"""
    WITH {ONE_MODEL}
    SELECT series, CAST(date + 40 AS DATE) AS forecast_date, round(yhat, 3) AS forecast
    FROM scored
    QUALIFY date >= max(date) OVER (PARTITION BY series) - 39
    """,
)
def forecast_horizon(spark, folder):
    rows = features(spark, folder)
    out = forecast(rows, fit_ridge(rows, ONE, "target_40", by=BY), ONE, by=BY)
    return out.withColumn("forecast", F.round("forecast", 3))


BACKTEST = f"""
    {ONE_MODEL},
    history AS (
      SELECT s.series, s.date AS prediction_date, CAST(s.date + 40 AS DATE) AS forecast_date,
             s.yhat AS yhat_40, f.y AS actual
      FROM scored s LEFT JOIN features f ON f.series = s.series AND f.date = s.date + 40)
"""


def history(spark, folder):
    rows = features(spark, folder)
    scored = score_history(rows, fit_ridge(rows, ONE, "target_40", by=BY), ONE, by=BY)
    return backtest(scored, rows, by=BY)


@query(
    "backtest_join",
    f"""
    WITH {BACKTEST}
    SELECT series, prediction_date, forecast_date, round(yhat_40, 3) AS yhat_40, actual
    FROM history ORDER BY forecast_date, series
    """,
)
def backtest_join(spark, folder):
    out = history(spark, folder).withColumn("yhat_40", F.round("yhat_40", 3))
    return out.orderBy("forecast_date", "series")


@query(
    "mape_metric",
    f"""
    WITH {BACKTEST}
    SELECT series, round(avg(abs(actual - yhat_40) / nullif(actual, 0)) * 100, 5) AS mape_40d
    FROM history WHERE actual IS NOT NULL GROUP BY 1
    """,
)
def mape_metric(spark, folder):
    metric = mape(history(spark, folder), "actual", "yhat_40", BY, "mape_40d")
    return metric.withColumn("mape_40d", F.round("mape_40d", 5))


@query(
    "ridge_by_key",
    f"""
    WITH {FEATURES},
    means AS (
      SELECT series, avg(y_lag1) AS m1, avg(y_lag7) AS m2, avg(target_40) AS my
      FROM features WHERE target_40 IS NOT NULL GROUP BY 1),
    centred AS (
      SELECT series, m1, m2, my, coalesce(y_lag1, m1) - m1 AS a, coalesce(y_lag7, m2) - m2 AS b,
             target_40 - my AS y
      FROM features JOIN means USING (series) WHERE target_40 IS NOT NULL),
    sums AS (
      SELECT series, count(*) AS n, any_value(m1) AS m1, any_value(m2) AS m2, any_value(my) AS my,
             sum(a * a) + 1.0 AS aa, sum(a * b) AS ab, sum(b * b) + 1.0 AS bb,
             sum(a * y) AS ay, sum(b * y) AS byy
      FROM centred GROUP BY 1),
    solved AS (
      SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS w1,
             (byy * aa - ay * ab) / (aa * bb - ab * ab) AS w2
      FROM sums)
    SELECT series, n, round(w1, 6) AS w1, round(w2, 6) AS w2,
           round(my - w1 * m1 - w2 * m2, 3) AS intercept
    FROM solved
    """,
)
def ridge_by_key(spark, folder):
    model = fit_ridge(features(spark, folder), TWO, "target_40", by=BY)
    return model.select(
        "series",
        "n",
        F.round(F.element_at("weights", "y_lag1"), 6).alias("w1"),
        F.round(F.element_at("weights", "y_lag7"), 6).alias("w2"),
        F.round("intercept", 3).alias("intercept"),
    )


# All features: the normal equations in long form, solved by elimination, one column per step.
NUMERIC_LONG = " UNION ALL ".join(
    f"SELECT series, id, '{c}' AS f, {c} AS x FROM train" for c in ALL
)
TEXT_LONG = " UNION ALL ".join(
    f"""
    SELECT t.series, t.id, '{c}=' || l.v AS f, CAST(t.{c} = l.v AS DOUBLE) AS x
    FROM train t JOIN (SELECT DISTINCT series, {c} AS v FROM train) l ON l.series = t.series
    """
    for c in TEXT
)


@query(
    "ridge_full",
    f"""
    WITH RECURSIVE {FEATURES},
    train AS (
      SELECT *, row_number() OVER (ORDER BY series, date) AS id
      FROM features WHERE target_40 IS NOT NULL),
    long AS ({NUMERIC_LONG} UNION ALL {TEXT_LONG}),
    means AS (
      SELECT series, f, avg(x) AS m, row_number() OVER (PARTITION BY series ORDER BY f) AS i
      FROM long GROUP BY series, f),
    label AS (
      SELECT series, id, avg(target_40) OVER (PARTITION BY series) AS my,
             target_40 - avg(target_40) OVER (PARTITION BY series) AS y FROM train),
    centred AS (
      SELECT series, id, i, coalesce(x, m) - m AS x FROM long JOIN means USING (series, f)),
    matrix AS (
      SELECT a.series, a.i, b.i AS j,
             sum(a.x * b.x) + CASE WHEN a.i = b.i THEN 1.0 ELSE 0.0 END AS v
      FROM centred a JOIN centred b ON a.series = b.series AND a.id = b.id
      GROUP BY a.series, a.i, b.i
      UNION ALL
      SELECT series, i, 0 AS j, sum(x * y) AS v FROM centred JOIN label USING (series, id)
      GROUP BY series, i),
    steps AS (
      SELECT CAST(0 AS BIGINT) AS step, series, i, j, v FROM matrix
      UNION ALL
      SELECT a.step + 1, a.series, a.i, a.j,
             CASE WHEN a.i = a.step + 1 THEN a.v / p.v ELSE a.v - f.v * r.v / p.v END
      FROM steps a
      JOIN steps p ON p.series = a.series AND p.i = a.step + 1 AND p.j = a.step + 1
      JOIN steps r ON r.series = a.series AND r.i = a.step + 1 AND r.j = a.j
      JOIN steps f ON f.series = a.series AND f.i = a.i AND f.j = a.step + 1),
    weights AS (
      SELECT s.series, m.f, s.v AS w, m.m
      FROM steps s JOIN means m ON m.series = s.series AND m.i = s.i
      WHERE s.j = 0 AND s.step = (SELECT max(i) FROM means)),
    totals AS (
      SELECT w.series, (SELECT count(*) FROM train t WHERE t.series = w.series) AS n,
             (SELECT any_value(my) FROM label l WHERE l.series = w.series)
               - sum(w.w * w.m) AS intercept
      FROM weights w GROUP BY w.series)
    SELECT series, n, round(intercept, 2) AS intercept, f AS feature, round(w, 4) AS weight
    FROM weights JOIN totals USING (series)
    """,
)
def ridge_full(spark, folder):
    """All features, text columns as categories: one row per weight of every series."""
    model = fit_ridge(rounded(features(spark, folder)), ALL, "target_40", TEXT, by=BY)
    return model.select(
        "series",
        "n",
        F.round("intercept", 2).alias("intercept"),
        F.explode("weights").alias("feature", "weight"),
    ).withColumn("weight", F.round("weight", 4))


@query(
    "holdout_split",
    f"""
    WITH {FEATURES}
    SELECT series, (date - DATE '1970-01-01') % 10 = 0 AS held_out, count(*) AS n,
           count(target_40) AS labelled
    FROM features GROUP BY ALL
    """,
)
def holdout_split(spark, folder):
    rows = features(spark, folder)
    return rows.groupBy("series", held_out("date", 10).alias("held_out")).agg(
        F.count(F.lit(1)).alias("n"), F.count("target_40").alias("labelled")
    )


@query(
    "guarded_train",
    f"""
    WITH {FEATURES},
    event_days AS (
      SELECT event_type AS series, CAST(ts AS DATE) AS date FROM events GROUP BY ALL),
    spans AS (
      SELECT series, CAST(max(date) - min(date) + 1 AS BIGINT) AS n FROM event_days GROUP BY 1)
    SELECT series, count(*) AS rows, count(target_40) AS labelled,
           count(target_40) > 0 AS has_model
    FROM features GROUP BY 1
    UNION ALL
    SELECT series, n, greatest(n - 40, 0), n > 40 FROM spans
    """,
)
def guarded_train(spark, folder):
    """Series that are too short for a target get no model; the others do."""
    daily = (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("date"))
        .agg(money(F.lit(True), "value").alias("price_a"))
    )
    absent = [F.lit(None).cast("double").alias(c) for c in AVERAGED.values()]
    short = as_of_daily([(daily.select("*", *absent), ["price_a", *AVERAGED.values()])], "date", BY)
    rows = features(spark, folder).unionByName(
        feature_matrix(short, "price_a", AVERAGED, by=BY)
    )
    model = fit_ridge(rows, ONE, "target_40", by=BY).select(
        "series", (F.col("n") > 0).alias("fitted")
    )
    counts = rows.groupBy("series").agg(
        F.count(F.lit(1)).alias("rows"), F.count("target_40").alias("labelled")
    )
    return counts.join(model, "series", "left").select(
        "series", "rows", "labelled", F.coalesce("fitted", F.lit(False)).alias("has_model")
    )
