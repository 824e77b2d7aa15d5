"""Freshness of feeds and the gate before a build; every event type is a feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dayloom.catalog.registry import query, table
from dayloom.operators.freshness import (
    capture_baseline_by,
    feed_status,
    feed_summary,
    new_rows_by,
    ready,
)

CUT = dt.datetime(2024, 1, 30, 23)
# The 'error' feed has never been seen before: it has no baseline and all its rows are new.
COUNTS = """
    baselines AS (
      SELECT event_type AS feed,
             CASE WHEN event_type <> 'error'
                  THEN max(ts) FILTER (ts < TIMESTAMP '2024-01-30 23:00:00') END AS baseline
      FROM events GROUP BY 1),
    counts AS (
      SELECT b.feed, b.baseline,
             count(*) FILTER (b.baseline IS NULL OR e.ts > b.baseline) AS new_rows
      FROM baselines b JOIN events e ON e.event_type = b.feed GROUP BY ALL)
"""
MINIMUM = 2


def _counts(spark, folder):
    events = table(spark, folder, "events").select("event_type", "ts")
    earlier = F.when((F.col("ts") < F.lit(CUT)) & (F.col("event_type") != "error"), F.col("ts"))
    baselines = capture_baseline_by(events.withColumn("seen", earlier), "event_type", "seen")
    return new_rows_by(events, "event_type", "ts", baselines)


@query("freshness_baseline", "SELECT event_type AS feed, max(ts) AS baseline FROM events GROUP BY 1")
def freshness_baseline(spark, folder):
    return capture_baseline_by(table(spark, folder, "events"), "event_type", "ts")


@query("freshness_new_rows", f"WITH {COUNTS} SELECT feed, baseline, new_rows FROM counts")
def freshness_new_rows(spark, folder):
    return _counts(spark, folder)


@query(
    "feed_gate",
    f"""
    WITH {COUNTS}
    SELECT 'any' AS rule, bool_or(new_rows >= {MINIMUM}) AS ready FROM counts
    UNION ALL SELECT 'all', bool_and(new_rows >= {MINIMUM}) FROM counts
    """,
)
def feed_gate(spark, folder):
    status = feed_status(_counts(spark, folder), MINIMUM)
    rules = [
        ready(status, require_all).select(F.lit(rule).alias("rule"), "ready")
        for rule, require_all in (("any", False), ("all", True))
    ]
    return rules[0].unionByName(rules[1])


@query(
    "feed_summary",
    f"""
    WITH {COUNTS}
    SELECT feed, new_rows, new_rows >= {MINIMUM} AS passed,
           CASE WHEN new_rows >= {MINIMUM} THEN 'success' ELSE 'skipped' END AS state
    FROM counts
    """,
)
def feed_summary_query(spark, folder):
    summary = feed_summary(feed_status(_counts(spark, folder), MINIMUM))
    return summary.select("feed", "new_rows", "passed", "state")
