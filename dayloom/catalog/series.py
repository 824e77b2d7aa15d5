"""Daily series: spine, joins, fill, lags, averages, targets, features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dayloom.catalog.registry import query, table
from dayloom.functions import calendar_parts
from dayloom.operators.features import (
    add_lags,
    add_lead_target,
    add_moving_avg,
    feature_matrix,
)
from dayloom.operators.fill import forward_fill
from dayloom.operators.series import assert_dense
from dayloom.operators.spine import (
    as_of_daily,
    bounds_by_key,
    date_spine,
    join_on_spine,
    series_parts,
    spine_bounds,
)
from dayloom.sources.tables import register_view

START = dt.date(1995, 1, 1)
AVERAGED = {"b_ma7": "price_b", "precip_ma7": "precipitation", "soil_ma7": "soil_moisture"}
VALUES = ["price_a", "price_b", "precipitation", "soil_moisture"]
PRIORITIES = {
    "price_a": ["1-URGENT"],
    "price_b": ["5-LOW", "4-NOT SPECIFIED"],
    "precipitation": ["2-HIGH"],
    "soil_moisture": ["3-MEDIUM"],
}


def money(condition, amount="o_totalprice"):
    """Exact sum, as a double, of the rows that meet a condition; null when there are none.

    Amounts have two decimals. Whole cents add up exactly in any order and need no wide
    decimal buffer; a sum beyond 64 bits fails rather than wrapping round.
    """
    cents = F.round(F.col(amount) * 100).cast("bigint")
    return F.sum(F.when(condition, cents)) / F.lit(100.0)


def order_measures(spark, folder):
    """Daily measures per order status, each with gaps of its own, summed in one pass."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("series"),
        F.to_date("o_orderdate").alias("date"),
        "o_orderpriority",
        "o_totalprice",
    )
    priority = F.col("o_orderpriority")

    daily = orders.groupBy("series", "date").agg(
        *[money(priority.isin(wanted)).alias(c) for c, wanted in PRIORITIES.items()]
    )
    return [(daily, VALUES)]


def order_top(spark, folder):
    """Last day of the calendar, from the raw column alone."""
    return spine_bounds([(table(spark, folder, "orders"), "o_orderdate")], START)


def _sum_sql(condition, amount="o_totalprice"):
    return f"CAST(SUM(CAST({amount} AS DECIMAL(18,2))) FILTER ({condition}) AS DOUBLE)"


def _filled_sql(spine, by):
    window = (
        f"OVER (PARTITION BY {by} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    columns = ", ".join(f"last_value({c} IGNORE NULLS) {window} AS {c}" for c in VALUES)
    return f"SELECT {by}, date, {columns} FROM {spine}"


ORDER_SPINE = f"""
    daily AS (
      SELECT o_orderstatus AS series, CAST(o_orderdate AS DATE) AS date,
             {_sum_sql("o_orderpriority = '1-URGENT'")} AS price_a,
             {_sum_sql("o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')")} AS price_b,
             {_sum_sql("o_orderpriority = '2-HIGH'")} AS precipitation,
             {_sum_sql("o_orderpriority = '3-MEDIUM'")} AS soil_moisture
      FROM orders GROUP BY ALL),
    days AS (
      SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01',
               CAST((SELECT max(date) FROM daily) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date),
    spine AS (
      SELECT k.series, days.date FROM (SELECT DISTINCT series FROM daily) k, days),
    sparse AS (
      SELECT spine.series, spine.date, price_a, price_b, precipitation, soil_moisture
      FROM spine LEFT JOIN daily USING (series, date))
"""
ORDER_FILLED = f"{ORDER_SPINE}, filled AS ({_filled_sql('sparse', 'series')})"


def features_sql(source, by, y="price_a", digits=4):
    part = f"PARTITION BY {by} ORDER BY date" if by else "ORDER BY date"
    seven = f"OVER ({part} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    first = f"{by}, " if by else ""
    return f"""
      SELECT {first}date, {y} AS y,
             lag({y}, 1) OVER ({part}) AS y_lag1, lag({y}, 7) OVER ({part}) AS y_lag7,
             lag({y}, 28) OVER ({part}) AS y_lag28,
             round(avg(price_b) {seven}, {digits}) AS b_ma7,
             round(avg(precipitation) {seven}, {digits}) AS precip_ma7,
             round(avg(soil_moisture) {seven}, {digits}) AS soil_ma7,
             CAST(dayofweek(date) + 1 AS VARCHAR) AS dow, CAST(month(date) AS VARCHAR) AS mon,
             lead({y}, 40) OVER ({part}) AS target_40
      FROM {source}"""


def rounded(df):
    """Averages to four digits: sums of doubles differ in the last one by their order."""
    return df.withColumns({c: F.round(c, 4) for c in AVERAGED})


@query(
    "spine_bounds",
    """
    SELECT DATE '1995-01-01' AS lo, greatest(
      (SELECT max(CAST(o_orderdate AS DATE)) FROM orders),
      (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem),
      (SELECT max(CAST(ts AS DATE)) FROM events)) AS hi
    """,
)
def spine_bounds_query(spark, folder):
    sources = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]
    return spine_bounds([(table(spark, folder, t), c) for t, c in sources], START)


@query(
    "date_spine",
    """
    WITH b AS (
      SELECT l_suppkey, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY 1)
    SELECT l_suppkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b
    """,
)
def date_spine_query(spark, folder):
    lines = table(spark, folder, "lineitem")
    return date_spine(bounds_by_key(lines, ["l_suppkey"], "l_shipdate"), ["l_suppkey"])


@query(
    "spine_left_join",
    f"WITH {ORDER_SPINE} SELECT series, date, {', '.join(VALUES)} FROM sparse",
)
def spine_left_join(spark, folder):
    return _sparse(spark, folder)


def _sparse(spark, folder):
    """Spine of each status from the first calendar day on, with what the sources hold."""
    sources = order_measures(spark, folder)
    top = order_top(spark, folder)
    statuses = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("series"))
    bounds = statuses.distinct().select(
        "series", F.lit(START).alias("lo"), top.select("hi").scalar().alias("hi")
    )
    return join_on_spine(date_spine(bounds, ["series"]), sources, ["series", "date"])


def _as_of(spark, folder):
    sources = order_measures(spark, folder)
    top = order_top(spark, folder)
    return as_of_daily(sources, "date", ["series"], START, top.select("hi").scalar())


@query("daily_as_of", f"WITH {ORDER_FILLED} SELECT * FROM filled")
def daily_as_of(spark, folder):
    return _as_of(spark, folder)


LINE_DAILY = f"""
    daily AS (
      SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date,
             {_sum_sql("l_returnflag = 'A'", "l_extendedprice")} AS price_a,
             {_sum_sql("l_returnflag = 'N'", "l_extendedprice")} AS price_b,
             {_sum_sql("l_returnflag = 'R'", "l_extendedprice")} AS precipitation,
             {_sum_sql("TRUE", "l_quantity")} AS soil_moisture
      FROM lineitem GROUP BY ALL)
"""
LINE_FILLED = f"""
    {LINE_DAILY},
    spine AS (
      SELECT k.l_suppkey, CAST(unnest(generate_series(TIMESTAMP '1995-01-01',
               CAST((SELECT max(date) FROM daily) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT DISTINCT l_suppkey FROM daily) k),
    sparse AS (SELECT * FROM spine LEFT JOIN daily USING (l_suppkey, date)),
    filled AS ({_filled_sql('sparse', 'l_suppkey')})
"""


def line_daily(spark, folder):
    """Four measures per supplier and day; one series per supplier."""
    flag = F.col("l_returnflag")
    price = "l_extendedprice"
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.to_date("l_shipdate").alias("date"))
        .agg(
            money(flag == "A", price).alias("price_a"),
            money(flag == "N", price).alias("price_b"),
            money(flag == "R", price).alias("precipitation"),
            money(F.lit(True), "l_quantity").alias("soil_moisture"),
        )
    )


@query(
    "forward_fill_keyed",
    f"WITH {LINE_DAILY}, filled AS ({_filled_sql('daily', 'l_suppkey')}) SELECT * FROM filled",
)
def forward_fill_keyed(spark, folder):
    return forward_fill(line_daily(spark, folder), VALUES, "date", ["l_suppkey"])


@query(
    "forward_fill_global",
    """
    WITH marked AS (
      SELECT event_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS value FROM events)
    SELECT event_id, ts, last_value(value IGNORE NULLS) OVER (ORDER BY ts
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
    FROM marked
    """,
)
def forward_fill_global(spark, folder):
    """No key at all: every event carries the latest purchase; time is cut by row count."""
    events = table(spark, folder, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"),
    )
    return forward_fill(events, ["value"], "ts")


@query(
    "forward_fill_buckets",
    """
    WITH marked AS (
      SELECT event_id, event_type, ts, CASE WHEN props LIKE '%9%' THEN value END AS value
      FROM events)
    SELECT event_id, event_type, ts,
           last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
    FROM marked
    """,
)
def forward_fill_buckets(spark, folder):
    """Few keys with very many rows each: cut by row count, carried from cut to cut."""
    events = table(spark, folder, "events").select(
        "event_id",
        "event_type",
        "ts",
        F.when(F.col("props").contains("9"), F.col("value")).alias("value"),
    )
    return forward_fill(events, ["value"], "ts", ["event_type"], ranges=True)


@query(
    "lag_features",
    f"""
    WITH {ORDER_FILLED}
    SELECT series, date, lag(price_a, 1) OVER w AS price_a_lag1,
           lag(price_a, 7) OVER w AS price_a_lag7, lag(price_a, 28) OVER w AS price_a_lag28
    FROM filled WINDOW w AS (PARTITION BY series ORDER BY date)
    """,
)
def lag_features(spark, folder):
    lagged = add_lags(_as_of(spark, folder), "price_a", by=["series"])
    return lagged.select("series", "date", "price_a_lag1", "price_a_lag7", "price_a_lag28")


@query(
    "moving_avg7",
    f"""
    WITH {ORDER_SPINE}
    SELECT series, date, round(avg(price_b) OVER w, 4) AS b_ma7,
           round(avg(precipitation) OVER w, 4) AS precip_ma7,
           round(avg(soil_moisture) OVER w, 4) AS soil_ma7
    FROM sparse
    WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    """,
)
def moving_avg7(spark, folder):
    """Averages over the sparse series, so nulls and short frames are in play."""
    wide = add_moving_avg(_sparse(spark, folder), AVERAGED, by=["series"])
    return rounded(wide.select("series", "date", *AVERAGED))


@query(
    "lead_target",
    f"""
    WITH {ORDER_FILLED}
    SELECT series, date, price_a, lead(price_a, 40) OVER (PARTITION BY series ORDER BY date)
             AS target_40
    FROM filled
    """,
)
def lead_target(spark, folder):
    dense = assert_dense(_as_of(spark, folder), "date", ["series"])
    return add_lead_target(dense, "price_a", by=["series"]).select(
        "series", "date", "price_a", "target_40"
    )


@query(
    "calendar_parts",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(dayofweek(l_shipdate) + 1 AS VARCHAR) AS dow,
           CAST(month(l_shipdate) AS VARCHAR) AS mon
    FROM lineitem
    """,
)
def calendar_parts_query(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("date")
    )
    return lines.withColumns(calendar_parts("date")).drop("date")


@query(
    "feature_matrix",
    f"WITH {LINE_FILLED}, features AS ({features_sql('filled', 'l_suppkey')}) SELECT * FROM features",
)
def feature_matrix_query(spark, folder):
    """Flagship: from raw lines to the features of every supplier's series."""
    daily = line_daily(spark, folder)
    # The newest day and about how many series there are come from the raw columns alone.
    top, n_series = table(spark, folder, "lineitem").agg(
        F.max("l_shipdate").cast("date"), F.approx_count_distinct("l_suppkey")
    ).first()
    parts = series_parts(daily, n_series, START, top)
    dense = as_of_daily([(daily, VALUES)], "date", ["l_suppkey"], START, top, parts, unique=True)
    features = rounded(feature_matrix(dense, "price_a", AVERAGED, by=["l_suppkey"]))
    return register_view(features, "series_features")


@query(
    "feature_matrix_unkeyed",
    f"""
    WITH daily AS (
      SELECT CAST(o_orderdate AS DATE) AS date,
             {_sum_sql("o_orderpriority = '1-URGENT'")} AS price_a,
             {_sum_sql("o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')")} AS price_b,
             {_sum_sql("o_orderpriority = '2-HIGH'")} AS precipitation,
             {_sum_sql("o_orderpriority = '3-MEDIUM'")} AS soil_moisture, 1 AS one
      FROM orders GROUP BY ALL),
    spine AS (
      SELECT 1 AS one, CAST(unnest(generate_series(TIMESTAMP '1995-01-01',
               CAST((SELECT max(date) FROM daily) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date),
    sparse AS (SELECT * FROM spine LEFT JOIN daily USING (one, date)),
    filled AS ({_filled_sql('sparse', 'one')}),
    features AS ({features_sql('filled', '')})
    SELECT * FROM features
    """,
)
def feature_matrix_unkeyed(spark, folder):
    """One series without a key, its windows cut into half-year stretches."""
    priority = F.col("o_orderpriority")
    daily = (
        table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(*[money(priority.isin(wanted)).alias(c) for c, wanted in PRIORITIES.items()])
    )
    top = table(spark, folder, "orders").agg(F.max("o_orderdate").cast("date")).scalar()
    dense = as_of_daily([(daily, VALUES)], "date", lo=START, hi=top)
    return rounded(feature_matrix(dense, "price_a", AVERAGED, stretch_days=183))
