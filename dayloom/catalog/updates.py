"""Tables kept up to date: merges by part, the build by batches, sums of a regression, large documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.catalog.build import AVERAGED, START
from dayloom.catalog.modelling import BY, FEATURES, TWO, features
from dayloom.catalog.registry import query, table
from dayloom.operators.dedup import any_value_by_key, latest_per_key
from dayloom.operators.evaluate import held_out
from dayloom.operators.ridge_sums import RidgeState
from dayloom.plans.incremental import IncrementalDaily
from dayloom.functions import number_or_null, within_lookback
from dayloom.session import scratch_path
from dayloom.sources.json_scan import read_json_array
from dayloom.sources.parts import merge_parts, month_of, read_parts
from dayloom.sources.tables import VALID_FLAG, register_view
from dayloom.streaming.staging import Staging

#: Days of late corrections that the updates bring.
LATE = 90
#: Days that count as new in the freshness query.
WEEK = 7

NEWEST = """
    SELECT CAST(o_orderdate AS DATE) AS date, {columns} FROM orders WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1
"""
LATE_SQL = f"CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) - {LATE} FROM orders)"


def _newest(spark, folder, where, *columns):
    rows = table(spark, folder, "orders").filter(where).select(F.to_date("o_orderdate").alias("date"), "o_orderkey", *columns)
    return latest_per_key(rows, ["date"], ["o_orderkey"]).drop("o_orderkey")


def _late(spark, folder):
    top = table(spark, folder, "orders").agg(F.max("o_orderdate").cast("date")).scalar()
    return within_lookback(F.to_date("o_orderdate"), top, LATE)


@query(
    "upsert_parts",
    f"""
    WITH base AS (
      SELECT CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS price, max(l_linestatus) AS status
      FROM lineitem GROUP BY 1),
    late AS ({NEWEST.format(columns="CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price", where=LATE_SQL)})
    SELECT coalesce(b.date, a.date) AS date, CASE WHEN a.date IS NOT NULL THEN a.price ELSE b.price END AS price,
           b.status, strftime(coalesce(b.date, a.date), '%Y-%m') AS month
    FROM base b FULL OUTER JOIN late a ON a.date = b.date
    """,
)
def upsert_parts(spark, folder):
    """A daily table by month; late corrections of a few months rewrite those months."""
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("price", T.DoubleType()),
                           T.StructField("status", T.StringType()), T.StructField("month", T.StringType())])
    path = scratch_path(spark, "upsert-parts")
    daily = table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("price"), F.col("l_linestatus").alias("status"))
    base = any_value_by_key(daily, ["date"], ["price", "status"]).withColumn("month", month_of("date"))
    merge_parts(spark, path, base, ["date"], ["price", "status"], "month", schema)
    late = _newest(spark, folder, _late(spark, folder), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"))
    merge_parts(spark, path, late.withColumn("month", month_of("date")), ["date"], ["price"], "month", schema)
    return read_parts(spark, path, schema, "month")


def _incremental(spark, folder) -> IncrementalDaily:
    """Two batches: everything the tables hold, then late corrections of one price."""
    feeds = {"price_a": ("price_a",), "price_b": ("price_b",), "weather": ("precipitation", "soil_moisture")}
    build = IncrementalDaily(spark, scratch_path(spark, "incremental"), feeds, "price_a", AVERAGED, (), START, order=("stamp",))
    lines = table(spark, folder, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    stamp = F.lit(1).alias("stamp")
    price = any_value_by_key(lines.select("date", F.col("l_extendedprice").alias("price_a")), ["date"], ["price_a"])
    weather = lines.select("date", F.col("l_quantity").alias("precipitation"), F.col("l_discount").alias("soil_moisture"), "l_orderkey", "l_linenumber")
    weather = latest_per_key(weather, ["date"], ["l_orderkey", "l_linenumber", "precipitation", "soil_moisture"])
    price_b = _newest(spark, folder, F.col("o_orderstatus") == "P", F.col("o_totalprice").alias("price_b"))
    build.apply(0, {"price_a": price.select("*", stamp), "price_b": price_b.select("*", stamp),
                    "weather": weather.select("date", "precipitation", "soil_moisture", stamp)})
    late = _newest(spark, folder, _late(spark, folder) & (F.col("o_orderstatus") != "P"),
                   F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price_a"))
    build.apply(1, {"price_a": late.select("*", stamp)})
    return build


@query(
    "daily_incremental",
    f"""
    WITH late AS ({NEWEST.format(columns="CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price_a",
                                 where=LATE_SQL + " AND o_orderstatus <> 'P'")}),
    base AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS price_a FROM lineitem GROUP BY 1),
    price_a AS (
      SELECT coalesce(b.date, a.date) AS date, CASE WHEN a.date IS NOT NULL THEN a.price_a ELSE b.price_a END AS price_a
      FROM base b FULL OUTER JOIN late a ON a.date = b.date),
    price_b AS ({NEWEST.format(columns="o_totalprice AS price_b", where="o_orderstatus = 'P'")}),
    weather AS (
      SELECT CAST(l_shipdate AS DATE) AS date, l_quantity AS precipitation, l_discount AS soil_moisture FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE)
        ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_discount DESC) = 1),
    spine AS (
      SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', CAST(greatest((SELECT max(date) FROM price_a),
        (SELECT max(date) FROM price_b), (SELECT max(date) FROM weather)) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date),
    joined AS (
      SELECT date, last_value(price_a IGNORE NULLS) OVER w AS price_a, last_value(price_b IGNORE NULLS) OVER w AS price_b,
             last_value(precipitation IGNORE NULLS) OVER w AS precipitation, last_value(soil_moisture IGNORE NULLS) OVER w AS soil_moisture
      FROM spine LEFT JOIN price_a USING (date) LEFT JOIN price_b USING (date) LEFT JOIN weather USING (date)
      WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT *, lag(price_a, 28) OVER d AS y_lag28, round(avg(price_b) OVER (d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS b_ma7,
           lead(price_a, 40) OVER d AS target_40, TRUE AS scored
    FROM joined WINDOW d AS (ORDER BY date)
    """,
)
def daily_incremental(spark, folder):
    """Joined days and some features after both batches, and whether each day was scored."""
    build = _incremental(spark, folder)
    wide = build.features().select("date", "y_lag28", F.round("b_ma7", 4).alias("b_ma7"), "target_40")
    scored = build.output("backtest").select(F.col("prediction_date").alias("date"), F.col("yhat_40").isNotNull().alias("scored"))
    return build.joined().drop("month").join(wide, "date", "left").join(scored, "date", "left")


@query(
    "ridge_incremental",
    f"""
    WITH {FEATURES},
    train AS (SELECT * FROM features WHERE target_40 IS NOT NULL AND (date - DATE '1970-01-01') % 10 <> 0),
    means AS (SELECT series, avg(y_lag1) AS m1, avg(y_lag7) AS m2, avg(target_40) AS my FROM train GROUP BY 1),
    centred AS (
      SELECT series, m1, m2, my, coalesce(y_lag1, m1) - m1 AS a, coalesce(y_lag7, m2) - m2 AS b, target_40 - my AS y
      FROM train JOIN means USING (series)),
    sums AS (
      SELECT series, count(*) AS n, any_value(m1) AS m1, any_value(m2) AS m2, any_value(my) AS my,
             sum(a * a) + 1.0 AS aa, sum(a * b) AS ab, sum(b * b) + 1.0 AS bb, sum(a * y) AS ay, sum(b * y) AS byy
      FROM centred GROUP BY 1),
    solved AS (
      SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS w1, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS w2 FROM sums)
    SELECT series, n, round(w1, 6) AS w1, round(w2, 6) AS w2, round(my - w1 * m1 - w2 * m2, 3) AS intercept FROM solved
    """,
)
def ridge_incremental(spark, folder):
    """Batches by half: all days of one half, those of the other, then one day in ten taken out again."""
    rows = features(spark, folder)
    even = F.month("date") % 2 == 0
    state = RidgeState(spark, scratch_path(spark, "ridge-state"), TWO, "target_40", by=BY)
    state.apply(0, rows.filter(even))
    state.apply(1, rows.filter(~even))
    state.apply(2, removed=rows.filter(held_out("date", 10)))
    return state.model().select(
        "series", "n", F.round(F.element_at("weights", "y_lag1"), 6).alias("w1"), F.round(F.element_at("weights", "y_lag7"), 6).alias("w2"),
        F.round("intercept", 3).alias("intercept"))


@query(
    "json_array_scan",
    """
    SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
           event_type || '}"]{\\' AS note FROM events
    """,
)
def json_array_scan(spark, folder):
    """Events of each type written as one document of many lines, and read back in ranges."""
    events = table(spark, folder, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    value = F.when(F.col("event_type") == "error", ".").otherwise(F.col("value").cast("string"))
    note = F.concat("event_type", F.lit('}"]{\\'))
    record = F.to_json(F.struct("event_id", "event_type", day.alias("date"), value.alias("value"), F.struct(note.alias("note")).alias("more")))
    place = F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))
    lines = events.select(F.col("event_type").alias("kind"), place.alias("at"), record.alias("line"))
    lines = lines.select("kind", "at", F.when(F.col("at") > 1, F.concat(F.lit(","), "line")).otherwise(F.col("line")).alias("line"))
    kinds = events.select(F.col("event_type").alias("kind")).distinct()
    ends = [kinds.select("kind", F.lit(at).alias("at"), F.lit(text).alias("line"))
            for at, text in ((0, '{"count": {"rows": [1, 2]},\n "observations": ['), ((1 << 31) - 1, '], "end": []}'))]
    path = scratch_path(spark, "documents")
    whole = lines.unionByName(ends[0]).unionByName(ends[1])
    whole.repartition("kind").sortWithinPartitions("kind", "at").select("line", "kind").write.partitionBy("kind").text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.StringType()),
                           T.StructField("more", T.StructType([T.StructField("note", T.StringType())]))])
    rows = read_json_array(spark, f"{path}/kind=*", schema, "observations")
    return rows.select("event_id", "event_type", number_or_null("value").alias("value"), F.col("more.note").alias("note"))


@query(
    "staging_freshness",
    f"""
    SELECT event_id, ts, (SELECT count(*) FROM events WHERE value >= 10 AND ts > (
             SELECT max(ts) FROM events WHERE value >= 10) - INTERVAL {WEEK} DAY) AS new_rows
    FROM events WHERE value >= 10
    """,
)
def staging_freshness(spark, folder):
    """Batches of three days, compacted on the way; new rows are counted from the batches' figures."""
    events = table(spark, folder, "events").withColumn(VALID_FLAG, F.coalesce(F.col("value") >= 10, F.lit(False)))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType())])
    staging = Staging(spark, scratch_path(spark, "staging"), schema, "ts")
    for number in range(11):
        some = F.floor((F.dayofmonth("ts") - 1) / 3) == number
        staging.write_batch(events.filter(some).select("event_id", "ts", VALID_FLAG), number)
        if number % 4 == 3:
            staging.compact()
    staging.vacuum()
    newest = staging.newest().first()["baseline"]
    counted = staging.new_rows(newest - dt.timedelta(days=WEEK)).first()["new_rows"]
    return staging.read().withColumn("new_rows", F.lit(counted).cast("bigint"))


@query(
    "view_read_back",
    "SELECT o_orderstatus AS status, year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY ALL",
)
def view_read_back(spark, folder):
    """A named view is made and read through SQL."""
    register_view(table(spark, folder, "orders"), "orders_live")
    return spark.sql("SELECT o_orderstatus AS status, year(o_orderdate) AS year, count(*) AS n FROM orders_live GROUP BY 1, 2")
