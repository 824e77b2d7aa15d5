"""The daily build from raw arrivals to the error metric."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dayloom.catalog.registry import query, table
from dayloom.catalog.series import features_sql
from dayloom.operators.dedup import any_value_by_key
from dayloom.plans.daily import DailyConfig, FeedInput, run_daily
from dayloom.schemas import FEEDS
from dayloom.session import scratch_path

START = dt.date(1995, 1, 1)
AVERAGED = {"b_ma7": "price_b", "precip_ma7": "precipitation", "soil_ma7": "soil_moisture"}

MERGED = """
    arrivals_a AS (
      SELECT CAST(o_orderdate AS DATE) AS date,
             CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price_a
      FROM orders WHERE o_orderstatus <> 'P'
      QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE)
                                 ORDER BY o_orderkey DESC) = 1),
    curated_a AS (
      SELECT CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS price_a
      FROM lineitem GROUP BY 1),
    price_a AS (
      SELECT coalesce(c.date, a.date) AS date,
             CASE WHEN a.date IS NOT NULL THEN a.price_a ELSE c.price_a END AS price_a
      FROM curated_a c FULL OUTER JOIN arrivals_a a ON c.date = a.date),
    price_b AS (
      SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS price_b
      FROM orders WHERE o_orderstatus = 'P'
      QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE)
                                 ORDER BY o_orderkey DESC) = 1),
    weather AS (
      SELECT CAST(l_shipdate AS DATE) AS date, l_quantity AS precipitation,
             l_discount AS soil_moisture
      FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE)
        ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_discount DESC) = 1),
    spine AS (
      SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', CAST(greatest(
        (SELECT max(date) FROM price_a), (SELECT max(date) FROM price_b),
        (SELECT max(date) FROM weather)) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date)
"""


def daily_config(spark, folder, out: str) -> DailyConfig:
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    status = F.col("o_orderstatus")
    order_day = F.to_date("o_orderdate").alias("date")
    ship_day = F.to_date("l_shipdate").alias("date")
    line_order = ("l_orderkey", "l_linenumber", "precipitation", "soil_moisture")
    feeds = {
        "price_a": FeedInput(
            orders.filter(status != "P").select(
                order_day,
                F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price_a"),
                "o_orderkey",
            ),
            any_value_by_key(
                lines.select(ship_day, F.col("l_extendedprice").alias("price_a")),
                ["date"],
                ["price_a"],
            ),
            ("price_a",),
            ("o_orderkey",),
        ),
        "price_b": FeedInput(
            orders.filter(status == "P").select(
                order_day, F.col("o_totalprice").alias("price_b"), "o_orderkey"
            ),
            spark.createDataFrame([], FEEDS["price_b"].curated_schema),
            ("price_b",),
            ("o_orderkey",),
        ),
        "weather": FeedInput(
            lines.select(
                ship_day,
                F.col("l_quantity").alias("precipitation"),
                F.col("l_discount").alias("soil_moisture"),
                "l_orderkey",
                "l_linenumber",
            ),
            spark.createDataFrame([], FEEDS["weather"].curated_schema),
            ("precipitation", "soil_moisture"),
            line_order,
        ),
    }
    return DailyConfig(feeds, out, "price_a", AVERAGED, start=START, stretch_days=183)


@query(
    "daily_build",
    f"""
    WITH {MERGED}
    SELECT date,
           last_value(price_a IGNORE NULLS) OVER w AS price_a,
           last_value(price_b IGNORE NULLS) OVER w AS price_b,
           last_value(precipitation IGNORE NULLS) OVER w AS precipitation,
           last_value(soil_moisture IGNORE NULLS) OVER w AS soil_moisture,
           TRUE AS scored
    FROM spine LEFT JOIN price_a USING (date) LEFT JOIN price_b USING (date)
         LEFT JOIN weather USING (date)
    WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
)
def daily_build(spark, folder):
    """Runs every step; returns the joined days and whether each day was scored."""
    paths = run_daily(spark, daily_config(spark, folder, scratch_path(spark, "daily")))
    scored = spark.read.parquet(paths["backtest"]).select(
        F.col("prediction_date").alias("date"), F.col("yhat_40").isNotNull().alias("scored")
    )
    return spark.read.parquet(paths["joined"]).join(scored, "date", "left")


NUMBERS, TEXTS = ["y", "y_lag1", "y_lag7", "y_lag28", *AVERAGED], ["dow", "mon"]


def _long(rows: str) -> str:
    """One row per day and feature; a text column is one feature per value of the training days."""
    numbers = [f"SELECT date, '{c}' AS f, {c} AS x FROM {rows}" for c in NUMBERS]
    texts = [
        f"SELECT t.date, '{c}=' || l.v AS f, CAST(t.{c} = l.v AS DOUBLE) AS x"
        f" FROM {rows} t CROSS JOIN (SELECT DISTINCT {c} AS v FROM train) l"
        for c in TEXTS
    ]
    return " UNION ALL ".join(numbers + texts)


@query(
    "daily_build_metric",
    f"""
    WITH RECURSIVE {MERGED},
    joined AS (
      SELECT date,
             last_value(price_a IGNORE NULLS) OVER w AS price_a,
             last_value(price_b IGNORE NULLS) OVER w AS price_b,
             last_value(precipitation IGNORE NULLS) OVER w AS precipitation,
             last_value(soil_moisture IGNORE NULLS) OVER w AS soil_moisture
      FROM spine LEFT JOIN price_a USING (date) LEFT JOIN price_b USING (date)
           LEFT JOIN weather USING (date)
      WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    features AS ({features_sql("joined", None, digits=12)}),
    train AS (SELECT * FROM features WHERE target_40 IS NOT NULL),
    long AS ({_long("train")}),
    means AS (SELECT f, avg(x) AS m, row_number() OVER (ORDER BY f) AS i FROM long GROUP BY f),
    label AS (SELECT avg(target_40) AS my FROM train),
    centred AS (SELECT date, i, coalesce(x, m) - m AS x FROM long JOIN means USING (f)),
    matrix AS (
      SELECT a.i, b.i AS j, sum(a.x * b.x) + CASE WHEN a.i = b.i THEN 1.0 ELSE 0.0 END AS v
      FROM centred a JOIN centred b ON a.date = b.date GROUP BY a.i, b.i
      UNION ALL
      SELECT i, 0 AS j, sum(x * (target_40 - my)) AS v
      FROM centred JOIN train USING (date) CROSS JOIN label GROUP BY i),
    steps AS (
      SELECT CAST(0 AS BIGINT) AS step, i, j, v FROM matrix
      UNION ALL
      SELECT a.step + 1, a.i, a.j,
             CASE WHEN a.i = a.step + 1 THEN a.v / p.v ELSE a.v - f.v * r.v / p.v END
      FROM steps a
      JOIN steps p ON p.i = a.step + 1 AND p.j = a.step + 1
      JOIN steps r ON r.i = a.step + 1 AND r.j = a.j
      JOIN steps f ON f.i = a.i AND f.j = a.step + 1),
    weights AS (
      SELECT m.f, m.m, s.v AS w FROM steps s JOIN means m ON m.i = s.i
      WHERE s.j = 0 AND s.step = (SELECT max(i) FROM means)),
    every AS ({_long("features")}),
    scored AS (
      SELECT date, sum(w * (coalesce(x, m) - m)) + (SELECT my FROM label) AS yhat
      FROM every JOIN weights USING (f) GROUP BY date),
    history AS (
      SELECT s.yhat, j.price_a AS actual FROM scored s JOIN joined j ON j.date = s.date + 40)
    SELECT round(avg(abs(actual - yhat) / nullif(actual, 0)) * 100, 4) AS mape_40d,
           (SELECT count(*) FROM joined) AS days,
           (SELECT count(*) FROM features WHERE date >= (SELECT max(date) FROM features) - 39) AS forecasts
    FROM history
    """,
)
def daily_build_metric(spark, folder):
    """The error metric of the build, next to how many days and forecasts it wrote."""
    paths = run_daily(spark, daily_config(spark, folder, scratch_path(spark, "daily")))
    read = lambda name: spark.read.parquet(paths[name])
    return read("metric").select(
        F.round("mape_40d", 4).alias("mape_40d"),
        read("joined").agg(F.count(F.lit(1))).scalar().alias("days"),
        read("forecast").agg(F.count(F.lit(1))).scalar().alias("forecasts"),
    )
