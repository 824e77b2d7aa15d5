"""Rules, quarantine, duplicates and merging."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dayloom.catalog.registry import query, table
from dayloom.functions import compute_once, date_from_dmy, safe_double, strip_thousands
from dayloom.operators.dedup import any_value_by_key, dedup, latest_per_key
from dayloom.operators.quality import (
    apply_rules,
    assert_complete,
    joined,
    quarantine_union,
    require_complete,
    require_text,
    rule_date,
    rule_date_range,
    rule_fields,
    rule_numeric,
    rule_positive,
    rule_present,
    split,
    to_quarantine,
)
from dayloom.operators.upsert import upsert
from dayloom.session import scratch_path
from dayloom.sources.tables import read_marked, write_marked

LO, HI = dt.date(1996, 1, 1), dt.date(2000, 12, 31)


def raw_orders(spark, folder):
    """Orders as raw text. Some dates do not exist, some prices are absent, words or negative."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    odd_date = (status == "P") & (priority == "5-LOW")
    raw_date = F.when(odd_date, F.lit("30/02/2023")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    text = F.format_number("o_totalprice", 2)
    raw_price = (
        F.when((priority == "3-MEDIUM") & (status == "O"), F.lit(None))
        .when(priority == "1-URGENT", F.lit("abc"))
        .when(priority == "2-HIGH", F.concat(F.lit("-"), text))
        .otherwise(text)
    )
    raw = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", raw_date.alias("raw_date"), raw_price.alias("raw_price")
    )
    return compute_once(
        raw,
        {
            "date": date_from_dmy("raw_date"),
            "price": safe_double(strip_thousands("raw_price")),
        },
    )


RAW_SQL = """
    raw AS (
      SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '30/02/2023'
                  ELSE strftime(o_orderdate, '%d/%m/%Y') END AS raw_date,
             CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN NULL
                  WHEN o_orderpriority = '1-URGENT' THEN 'abc'
                  WHEN o_orderpriority = '2-HIGH' THEN '-' || format('{:,.2f}', o_totalprice)
                  ELSE format('{:,.2f}', o_totalprice) END AS raw_price
      FROM orders),
    typed AS (
      SELECT *, CAST(try_strptime(raw_date, '%d/%m/%Y') AS DATE) AS date,
             TRY_CAST(replace(raw_price, ',', '') AS DOUBLE) AS price
      FROM raw),
    judged AS (
      SELECT *, concat_ws('; ',
               CASE WHEN raw_price IS NULL THEN 'Missing fields: raw_price' END,
               CASE WHEN date IS NULL THEN 'Invalid date format: ' || raw_date END,
               CASE WHEN date NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
                    THEN 'Date out of range (1996-01-01 to 2000-12-31)' END,
               CASE WHEN raw_price IS NOT NULL AND price IS NULL THEN 'price is not a float' END,
               CASE WHEN price <= 0 THEN 'price must be positive' END,
               CASE WHEN price IS NULL THEN 'Missing price value' END) AS errors
      FROM typed)
"""


def judged_orders(spark, folder):
    rules = [
        rule_fields(["raw_date", "raw_price"]),
        rule_date("raw_date", "date", echo=True),
        rule_date_range("date", LO, HI, echo=True),
        rule_numeric("raw_price", "price", "price"),
        rule_positive("price", "price"),
        rule_present("price", "price value"),
    ]
    return apply_rules(raw_orders(spark, folder), rules)


@query("validate_errors", f"WITH {RAW_SQL} SELECT o_orderkey, errors FROM judged")
def validate_errors(spark, folder):
    return judged_orders(spark, folder).select("o_orderkey", joined().alias("errors"))


@query(
    "validate_split",
    f"""
    WITH {RAW_SQL}
    SELECT errors = '' AS is_valid, count(*) AS n, min(date) AS first_date, max(date) AS last_date,
           CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM judged GROUP BY 1
    """,
)
def validate_split(spark, folder):
    path = scratch_path(spark, "validated")
    write_marked(judged_orders(spark, folder), path)
    sides = [
        read_marked(spark, path, valid).agg(
            F.lit(valid).alias("is_valid"),
            F.count(F.lit(1)).alias("n"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total"),
        )
        for valid in (True, False)
    ]
    return sides[0].unionByName(sides[1]).filter(F.col("n") > 0)


@query(
    "quarantine_union",
    f"""
    WITH {RAW_SQL},
    repeated AS (
      SELECT *, row_number() OVER (PARTITION BY date ORDER BY o_orderkey) AS rn
      FROM judged WHERE errors = '')
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, raw_date, raw_price, errors
    FROM judged WHERE errors <> ''
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), raw_date, raw_price,
           'Duplicate record for date ' || strftime(date, '%Y-%m-%d')
    FROM repeated WHERE rn > 1
    """,
)
def quarantine_union_query(spark, folder):
    valid, invalid = split(judged_orders(spark, folder))
    _, repeated = dedup(valid, ["date"], "keep_first", ["o_orderkey"], reason_date="date")
    columns = ["o_orderkey", "raw_date", "raw_price"]
    return to_quarantine(
        quarantine_union(invalid, repeated).select(*columns, "errors"), columns
    )


@query(
    "complete_rows_only",
    """
    SELECT event_id, event_type, value FROM events
    WHERE event_type NOT IN ('error', 'view') AND value >= 5
    """,
)
def complete_rows_only(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type")).alias(
            "event_type"
        ),
        F.when((F.col("event_type") != "error") & (F.col("value") >= 5), F.col("value")).alias(
            "value"
        ),
    )
    return require_text(require_complete(events, ["value"]), "event_type")


@query(
    "assert_complete",
    "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders",
)
def assert_complete_query(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("date"), "o_totalprice"
    )
    return assert_complete(orders, ["date", "o_totalprice"])


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"""
RANKED_LINES = f"""
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {LINE_COLUMNS}) AS rn,
             count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
      FROM lineitem)
"""


def deduped_lines(spark, folder, policy):
    lines = table(spark, folder, "lineitem")
    order = [c for c in lines.columns if c not in LINE_KEYS]
    return dedup(lines, LINE_KEYS, policy, order, reason_date="l_shipdate")


def with_reason(rejects):
    return rejects.withColumn("errors", F.array_join("errors", "; "))


@query("dedup_keep_first", f"WITH {RANKED_LINES} SELECT {LINE_COLUMNS} FROM ranked WHERE rn = 1")
def dedup_keep_first(spark, folder):
    return deduped_lines(spark, folder, "keep_first")[0]


REASON_SQL = "'Duplicate record for date ' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS errors"


@query(
    "dedup_keep_first_rejects",
    f"WITH {RANKED_LINES} SELECT {LINE_COLUMNS}, {REASON_SQL} FROM ranked WHERE rn > 1",
)
def dedup_keep_first_rejects(spark, folder):
    return with_reason(deduped_lines(spark, folder, "keep_first")[1])


@query("dedup_reject_all", f"WITH {RANKED_LINES} SELECT {LINE_COLUMNS} FROM ranked WHERE n = 1")
def dedup_reject_all(spark, folder):
    return deduped_lines(spark, folder, "reject_all")[0]


@query(
    "dedup_reject_all_rejects",
    f"WITH {RANKED_LINES} SELECT {LINE_COLUMNS}, {REASON_SQL} FROM ranked WHERE n > 1",
)
def dedup_reject_all_rejects(spark, folder):
    return with_reason(deduped_lines(spark, folder, "reject_all")[1])


@query(
    "latest_per_key",
    """
    SELECT user_id, event_type, event_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def latest_per_key_query(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "upsert_merge",
    """
    WITH source AS (
      SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 END AS v
      FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
      UNION ALL
      SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey + 1000000000 END, s_acctbal FROM supplier)
    SELECT CASE WHEN c.c_custkey IS NOT NULL THEN c.c_custkey ELSE s.k END AS c_custkey,
           c.c_name AS c_name,
           CASE WHEN c.c_custkey IS NULL OR s.k IS NOT NULL THEN s.v ELSE c.c_acctbal END AS c_acctbal
    FROM customer c FULL OUTER JOIN source s ON c.c_custkey = s.k
    """,
)
def upsert_merge(spark, folder):
    customers = table(spark, folder, "customer")
    segment = F.col("c_mktsegment")
    changed = customers.filter(segment.isin("BUILDING", "MACHINERY")).select(
        "c_custkey", F.when(segment == "BUILDING", F.col("c_acctbal") + 100).alias("c_acctbal")
    )
    known = F.col("s_acctbal") >= 0
    added = table(spark, folder, "supplier").select(
        F.when(known, F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    target = customers.select("c_custkey", "c_name", "c_acctbal")
    return upsert(target, changed.unionByName(added), ["c_custkey"], ["c_acctbal"])


@query(
    "any_value_by_key",
    """
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS quantity,
           max(l_extendedprice) FILTER (l_returnflag = 'A') AS price
    FROM lineitem GROUP BY ALL
    """,
)
def any_value_by_key_query(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice")).alias("price"),
    )
    return any_value_by_key(lines, ["l_suppkey", "date"], ["quantity", "price"])
