"""The three batch cleaners end to end: raw text to a curated and a quarantine table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dayloom.catalog.parsing import plain_number
from dayloom.catalog.registry import query, table
from dayloom.plans.cleaners import (
    judge_observations,
    judge_price_lines,
    judge_weather_lines,
    run_cleaner,
)
from dayloom.schemas import OBSERVATION_DOCUMENT
from dayloom.session import scratch_path

LO, HI = dt.date(1996, 1, 1), dt.date(2000, 12, 31)


def _both(spark, curated: str, quarantine: str, values: list[str]):
    """Curated and quarantine rows in one frame, the curated ones without a reason."""
    kept = spark.read.parquet(curated).select(
        F.col("date").cast("string").alias("date"),
        *[F.col(v).cast("decimal(18,2)").cast("string").alias(v) for v in values],
        F.lit(None).cast("string").alias("errors"),
    )
    return kept.unionByName(spark.read.parquet(quarantine))


@query(
    "clean_price_feed",
    """
    WITH raw AS (
      SELECT o_orderkey,
             CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d')
                  ELSE strftime(o_orderdate, '%d/%m/%Y') END AS d,
             CASE WHEN o_orderpriority = '1-URGENT' THEN '-' ELSE '' END
               || format('{:,.2f}', o_totalprice) AS p,
             CAST(o_orderdate AS DATE) AS date, o_totalprice, o_orderpriority, o_orderstatus
      FROM orders),
    judged AS (
      SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'Malformed line' ELSE concat_ws('; ',
                  CASE WHEN o_orderpriority = '5-LOW' THEN 'Invalid date format: ' || d END,
                  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Price must be positive' END)
                END AS errors
      FROM raw),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY date ORDER BY o_orderkey) AS rn
      FROM judged WHERE errors = '')
    SELECT strftime(date, '%Y-%m-%d') AS date,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, NULL AS errors
    FROM ranked WHERE rn = 1
    UNION ALL
    SELECT d, p, 'Duplicate record for date ' || strftime(date, '%Y-%m-%d') FROM ranked WHERE rn > 1
    UNION ALL
    SELECT CASE WHEN o_orderstatus = 'P' THEN '"' || d || '","' || o_orderstatus || '"' ELSE d END,
           CASE WHEN o_orderstatus <> 'P' THEN p END, errors
    FROM judged WHERE errors <> ''
    """,
)
def clean_price_feed(spark, folder):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    day = F.when(priority == "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    sign = F.when(priority == "1-URGENT", F.lit("-")).otherwise(F.lit(""))
    rest = [priority, F.col("o_custkey").cast("string")]
    price = F.concat(sign, F.format_number("o_totalprice", 2))
    # Lines of status P end early.
    cells = F.when(status == "P", F.array(day, status)).otherwise(
        F.array(day, status, *rest, price)
    )
    line = F.concat(F.lit('"'), F.array_join(cells, '","'), F.lit('"'))
    lines = table(spark, folder, "orders").select("o_orderkey", line.alias("line"))
    judged = judge_price_lines(lines, value="price", label="Price", keep=("o_orderkey",))
    curated, quarantine = scratch_path(spark, "curated"), scratch_path(spark, "quarantine")
    run_cleaner(
        spark,
        judged,
        curated,
        quarantine,
        values=("price",),
        policy="keep_first",
        order=["o_orderkey"],
        reason_date="date",
    )
    return _both(spark, curated, quarantine, ["price"])


@query(
    "clean_observation_feed",
    """
    WITH raw AS (
      SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice,
             CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
                  THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) ELSE '.' END AS v
      FROM orders),
    judged AS (
      SELECT *, concat_ws('; ',
               CASE WHEN date NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
                    THEN 'Date out of range' END,
               CASE WHEN v = '.' THEN 'Missing price' END) AS errors
      FROM raw),
    counted AS (SELECT *, count(*) OVER (PARTITION BY date) AS n FROM judged WHERE errors = '')
    SELECT strftime(date, '%Y-%m-%d') AS date, v AS price,
           CASE WHEN n > 1 THEN 'Duplicate record for date ' || strftime(date, '%Y-%m-%d') END
             AS errors
    FROM counted
    UNION ALL
    SELECT strftime(date, '%Y-%m-%d'), v, errors FROM judged WHERE errors <> ''
    """,
)
def clean_observation_feed(spark, folder):
    present = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    observation = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(present, plain_number("o_totalprice")).otherwise(F.lit(".")).alias("value"),
    )
    document = F.to_json(F.struct(F.array(observation).alias("observations")))
    documents = table(spark, folder, "orders").select(
        F.from_json(document, OBSERVATION_DOCUMENT).alias("d")
    ).select("d.observations")
    judged = judge_observations(documents, value="price", label="price", lo=LO, hi=HI)
    curated, quarantine = scratch_path(spark, "curated"), scratch_path(spark, "quarantine")
    run_cleaner(
        spark, judged, curated, quarantine, values=("price",), policy="reject_all",
        reason_date="date",
    )
    return _both(spark, curated, quarantine, ["price"])


@query(
    "clean_weather_feed",
    """
    WITH raw AS (
      SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS DECIMAL(18,2)) AS q,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS p
      FROM lineitem WHERE l_discount = 0.05 AND l_tax = 0.02),
    judged AS (
      SELECT *, CASE WHEN date NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
                     THEN 'Date out of range (1996-01-01 to 2000-12-31)' END AS bad
      FROM raw),
    counted AS (SELECT *, count(*) OVER (PARTITION BY date) AS n FROM judged WHERE bad IS NULL)
    SELECT strftime(date, '%Y-%m-%d') AS date, q AS precipitation, p AS soil_moisture,
           CASE WHEN n > 1 THEN 'Duplicate date' END AS errors
    FROM counted
    UNION ALL
    SELECT strftime(date, '%Y-%m-%d'), q, p, bad FROM judged WHERE bad IS NOT NULL
    """,
)
def clean_weather_feed(spark, folder):
    # Only some readings are complete; the marker stands for the others, in two spellings.
    quantity = F.when(F.col("l_discount") == 0.05, plain_number("l_quantity")).otherwise(
        F.lit("-999")
    )
    price = F.when(F.col("l_tax") == 0.02, plain_number("l_extendedprice")).otherwise(
        F.lit("-999.0")
    )
    line = F.concat_ws(
        ",",
        F.year("l_shipdate").cast("string"),
        F.dayofyear("l_shipdate").cast("string"),
        quantity,
        price,
    )
    lines = table(spark, folder, "lineitem").select(line.alias("line"))
    values = ("precipitation", "soil_moisture")
    judged = judge_weather_lines(lines, values=values, lo=LO, hi=HI)
    curated, quarantine = scratch_path(spark, "curated"), scratch_path(spark, "quarantine")
    run_cleaner(spark, judged, curated, quarantine, values=values, policy="reject_all")
    decimal = [F.col(v).cast("decimal(18,2)").alias(v) for v in values]
    return _both(spark, curated, quarantine, list(values)).select("date", *decimal, "errors")
