"""Parsing of lines, documents, markup, dates and numbers.

The text is made from the tables, with faults set by the rows' own attributes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dayloom.catalog.registry import query, table
from dayloom.functions import (
    compute_once,
    date_from_compact,
    date_from_dmy,
    date_from_wire,
    finite,
    normalise_timestamp,
    null_if_at_or_below,
    null_if_token,
    number_or_null,
    parse_double,
    safe_double,
    scrub_reading,
    strip_thousands,
)
from dayloom.plans.cleaners import to_dated_rows
from dayloom.schemas import OBSERVATION_DOCUMENT, FeedSpec
from dayloom.session import scratch_path
from dayloom.sources.documents import explode_records, latest_observation, unpivot_json_maps
from dayloom.sources.lines import NO_SEPARATOR, parse_csv_line, parse_plain_line, read_lines
from dayloom.sources.markup import dated_prices, extract_markup_rows, markup_latest_row, require_rows
from dayloom.sources.markup_depth import page_rows
from dayloom.sources.messages import build_envelope, decode_payload, encode_messages


def plain_number(c: str):
    """Two decimals, no separators and no exponent."""
    return F.col(c).cast("decimal(18,2)").cast("string")


@query(
    "csv_line_parse",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS date_text,
           CAST(o_orderdate AS DATE) AS date, o_totalprice AS price
    FROM orders
    """,
)
def csv_line_parse(spark, folder):
    """Lines in text files, each file with a header, read back and parsed."""
    fields = [
        F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.col("o_orderkey").cast("string"),
        F.col("o_orderpriority"),
        F.col("o_custkey").cast("string"),
        F.format_number("o_totalprice", 2),
    ]
    line = F.concat(F.lit('"'), F.concat_ws('","', *fields), F.lit('"'))
    path = scratch_path(spark, "lines")
    rendered = table(spark, folder, "orders").select(line.alias("line"))
    rendered.write.options(header=True, quote="", sep=NO_SEPARATOR, escapeQuotes=False).csv(path)
    lines = read_lines(spark, path, skip_header=True)
    record = parse_csv_line("line", {"date": 0, "key": 1, "price": 4})
    return compute_once(lines, {"r": record}).select(
        F.col("r.key").cast("bigint").alias("o_orderkey"),
        F.col("r.date").alias("date_text"),
        date_from_dmy("r.date").alias("date"),
        safe_double(strip_thousands("r.price")).alias("price"),
    )


@query(
    "csv_arity_guard",
    """
    SELECT c_custkey AS cust, c_nationkey AS nation,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, c_acctbal AS checked
    FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
    """,
)
def csv_arity_guard(spark, folder):
    segment = F.col("c_mktsegment")
    cells = [
        F.col("c_custkey").cast("string"),
        F.when(segment == "MACHINERY", F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string")),
        F.when(F.col("c_acctbal") < 0, F.lit("-999")).otherwise(plain_number("c_acctbal")),
        F.when(segment != "BUILDING", plain_number("c_acctbal")),
    ]
    lines = table(spark, folder, "customer").select(F.concat_ws(",", *cells).alias("line"))
    parsed = parse_plain_line(
        lines, integers=("cust", "nation"), numbers=("balance", "checked")
    )
    return parsed.withColumn("cust", F.col("cust").cast("bigint"))


@query(
    "json_document_explode",
    """
    SELECT event_id, CAST(ts AS DATE) AS date, value FROM events WHERE event_type <> 'error'
    UNION ALL
    SELECT event_id, CAST(ts AS DATE) + 1 AS date, NULL AS value
    FROM events WHERE event_type = 'click'
    """,
)
def json_document_explode(spark, folder):
    day = F.to_date("ts")
    seen = F.struct(day.cast("string").alias("date"), plain_number("value").alias("value"))
    missing = F.struct(F.date_add(day, 1).cast("string").alias("date"), F.lit(".").alias("value"))
    clicked = F.col("event_type") == "click"
    listed = F.when(clicked, F.array(seen, missing)).otherwise(F.array(seen))
    document = F.when(F.col("event_type") == "error", F.lit("{}")).otherwise(
        F.to_json(F.struct(listed.alias("observations")))
    )
    documents = table(spark, folder, "events").select(
        "event_id", F.from_json(document, OBSERVATION_DOCUMENT).alias("d")
    )
    rows = explode_records(
        documents.select("event_id", "d.observations"), "observations", ("event_id",)
    )
    return rows.select(
        "event_id",
        date_from_wire("date").alias("date"),
        number_or_null("value").alias("value"),
    )


@query(
    "json_map_pair_join",
    """
    WITH days AS (
      SELECT user_id, CAST(ts AS DATE) AS date,
             CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (event_type IN ('click', 'view')) AS DOUBLE) AS a,
             CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (event_type NOT IN ('click', 'view')) AS DOUBLE) AS b
      FROM events GROUP BY ALL)
    SELECT user_id, date, a, b FROM days WHERE a IS NOT NULL AND b IS NOT NULL
    """,
)
def json_map_pair_join(spark, folder):
    amount = F.col("value").cast("decimal(18,2)")
    of = lambda kind: F.sum(F.when(kind, amount)).cast("double")
    page = F.col("event_type").isin("click", "view")
    days = (
        table(spark, folder, "events")
        .groupBy("user_id", F.date_format("ts", "yyyyMMdd").alias("day"))
        .agg(of(page).alias("a"), of(~page).alias("b"))
    )
    # A map holds one entry per day, so the calendar bounds it.
    entries = lambda c: F.map_from_entries(
        F.collect_list(F.when(F.col(c).isNotNull(), F.struct("day", c)))
    )
    documents = days.groupBy("user_id").agg(entries("a").alias("a"), entries("b").alias("b")).select(
        "user_id",
        F.to_json(
            F.struct(F.struct(F.struct("a", "b").alias("parameter")).alias("properties"))
        ).alias("document"),
    )
    paths = {"a": "$.properties.parameter.a", "b": "$.properties.parameter.b"}
    return unpivot_json_maps(documents, "document", paths, ("user_id",)).select(
        "user_id",
        date_from_compact("day").alias("date"),
        null_if_at_or_below("a").alias("a"),
        null_if_at_or_below("b").alias("b"),
    )


@query(
    "markup_row_extract",
    r"""
    WITH found AS (
      SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS items FROM pages),
    listed AS (SELECT page_id, unnest(range(len(items))) AS i, items FROM found),
    cells AS (
      SELECT page_id, i, regexp_extract_all(items[i + 1], '(?s)<a[^>]*>(.*?)</a>', 1) AS c
      FROM listed)
    SELECT page_id, CAST(i AS INTEGER) AS row_no,
           trim(replace(replace(replace(replace(replace(replace(
             regexp_replace(c[1], '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
             '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&')) AS first_cell
    FROM cells WHERE len(c) >= 1
    """,
)
def markup_row_extract(spark, folder):
    rows = extract_markup_rows(
        table(spark, folder, "pages"),
        "html",
        r"(?s)<li>(.*?)</li>",
        r"(?s)<a[^>]*>(.*?)</a>",
        1,
        ("page_id",),
    )
    return rows.select("page_id", "row_no", F.get("cells", F.lit(0)).alias("first_cell"))


@query(
    "markup_nested_rows",
    """
    WITH lines AS (
      SELECT l_orderkey, string_agg(l_linestatus || CAST(l_linenumber AS VARCHAR), '' ORDER BY l_linenumber, l_linestatus) AS inner_text,
             count(*) AS n_lines
      FROM lineitem GROUP BY 1)
    SELECT o_orderkey, CAST(0 AS INTEGER) AS row_no, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price,
           coalesce(inner_text, '') AS inner_text, coalesce(n_lines, 0) AS n_inner, CAST(2 AS BIGINT) AS found
    FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
    """,
)
def markup_nested_rows(spark, folder):
    """Orders as pages: a cell holds a table of the lines, end tags are partly left out, a second row is short."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("l_linenumber", "l_linestatus"))),
                lambda r: F.concat(F.lit("<tr><td>"), r["l_linestatus"], r["l_linenumber"].cast("string"), F.lit("</td></tr>")),
            ),
            "",
        ).alias("inner")
    )
    orders = table(spark, folder, "orders")
    # Rows of status P leave out the end tags of cells, those of status F that of the row.
    end = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.lit("</td>"))
    cell = lambda c: F.concat(F.lit("<td>"), c, end)
    page = F.concat(
        F.lit('<!-- <tr id="table_0"> --><table id="table_1"><tbody><tr id="table_1_row_0">'),
        cell(F.col("o_orderkey").cast("string")),
        cell(F.date_format("o_orderdate", "dd/MM/yyyy")),
        cell(F.concat(F.lit("<table><tbody>"), F.coalesce("inner", F.lit("")), F.lit("</tbody></table>"))),
        cell(F.lit(" ")),
        cell(F.lit(" ")),
        cell(F.concat(F.lit("<b>"), F.format_number("o_totalprice", 2), F.lit("</b>"))),
        F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.lit("</tr>")),
        F.lit("<tr id='table_1_row_1'><td>short</td></tr></tbody></table>"),
    )
    pages = orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", page.alias("html"))
    scanned = require_rows(page_rows(pages, "html", nested_cells=True, keep=("o_orderkey",)), "found")
    # Pages without rows stay until they are checked.
    rows = scanned.select("o_orderkey", "found", F.explode_outer("rows").alias("row"))
    own = rows.select(
        "o_orderkey",
        "found",
        "row.row_no",
        F.transform(F.filter("row.cells", lambda c: c["own"]), lambda c: c["text"]).alias("cells"),
        (F.size("row.cells") - 6).cast("long").alias("n_inner"),
    ).where(F.size("cells") >= 6)
    kept = own.withColumn("inner_text", F.element_at("cells", 3))
    return dated_prices(kept, ("o_orderkey", "inner_text", "n_inner", "found"))


@query(
    "markup_latest_row",
    """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price
    FROM orders WHERE o_orderstatus <> 'P'
    QUALIFY row_number() OVER (PARTITION BY o_custkey
                               ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) = 1
    """,
)
def markup_latest_row_query(spark, folder):
    # Rows of status P lack a cell and are skipped like any short row.
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    page = F.concat(
        F.lit('<table id="table_1"><tbody><tr id="table_1_row_0">'),
        cell(F.col("o_orderkey").cast("string")),
        cell(F.date_format("o_orderdate", "dd/MM/yyyy")),
        cell(F.col("o_orderstatus")),
        cell(F.lit(" ")),
        F.when(F.col("o_orderstatus") != "P", cell(F.lit(" "))).otherwise(F.lit("")),
        cell(F.concat(F.lit(" <b>"), F.format_number("o_totalprice", 2), F.lit("</b> "))),
        F.lit("</tr></tbody></table>"),
    )
    pages = table(spark, folder, "orders").select("o_custkey", "o_orderkey", page.alias("html"))
    keep = ("o_custkey", "o_orderkey")
    prices = dated_prices(extract_markup_rows(pages, "html", keep=keep), keep)
    newest = markup_latest_row(prices, ["o_custkey"], ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "date", "price")


@query(
    "recent_latest_observation",
    """
    SELECT event_type, event_id, CAST(ts AS DATE) AS date, value
    FROM events
    WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 14 FROM events)
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def recent_latest_observation(spark, folder):
    events = table(spark, folder, "events").withColumn("date", F.to_date("ts"))
    as_of = events.agg(F.max("date")).scalar()
    newest = latest_observation(events, ["event_type"], ["ts", "event_id"], "date", 14, as_of)
    return newest.select("event_type", "event_id", "date", "value")


@query(
    "envelope_build",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, value,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingestion_time,
           strftime(ts, '%Y-%m-%d') AS payload_date, value AS payload_value
    FROM events
    """,
)
def envelope_build(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "ts", F.to_date("ts").alias("date"), "value"
    )
    messages = encode_messages(
        build_envelope(events, "date", ["value"], F.col("ts"), ("event_id",)), ("event_id",)
    )
    decoded = decode_payload(messages, "value", FeedSpec("events", ("value",)).wire_schema)
    return decoded.select(
        "event_id",
        "record.date",
        "record.value",
        "record.ingestion_time",
        F.get_json_object("record.raw_payload", "$.date").alias("payload_date"),
        safe_double(F.get_json_object("record.raw_payload", "$.value")).alias("payload_value"),
    )


@query(
    "date_parse_dmy",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS date
    FROM orders
    """,
)
def date_parse_dmy(spark, folder):
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd"))
    text = text.otherwise(F.date_format("o_orderdate", "d/M/yyyy"))
    return table(spark, folder, "orders").select("o_orderkey", date_from_dmy(text).alias("date"))


@query(
    "date_from_year_doy",
    """
    SELECT o_orderkey, CAST(make_date(CAST(year(o_orderdate) AS BIGINT), 1, 1)
             + CAST(dayofyear(o_orderdate) - 1
                    + CASE WHEN o_orderstatus = 'P' THEN 366 ELSE 0 END AS INTEGER) AS DATE) AS date
    FROM orders WHERE o_orderpriority <> '5-LOW'
    """,
)
def date_from_year_doy_query(spark, folder):
    # Status P overshoots the year and rolls over; a year of 0 has no date.
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(0))
        .otherwise(F.year("o_orderdate"))
        .alias("year"),
        (
            F.dayofyear("o_orderdate") + F.when(F.col("o_orderstatus") == "P", 366).otherwise(0)
        ).alias("doy"),
    )
    return to_dated_rows(rows, values=("o_orderkey",))


@query(
    "epoch_day_to_date",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS date
    FROM orders
    """,
)
def epoch_day_to_date(spark, folder):
    day = F.to_date("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.unix_date(day).cast("string"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.lit("not a date"))
    )
    return table(spark, folder, "orders").select("o_orderkey", date_from_wire(text).alias("date"))


@query("normalise_ts", "SELECT event_id, ts FROM events")
def normalise_ts(spark, folder):
    kind = F.col("event_type")
    instant = F.col("ts").cast("timestamp")
    wall = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    later = F.date_format(instant + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)"))
    text = (
        F.when(kind == "click", seconds.cast("decimal(20,6)").cast("string"))
        .when(kind == "view", F.concat(iso, F.lit("Z")))
        .when(kind == "error", F.concat(wall, F.lit(" UTC")))
        .when(kind == "purchase", F.concat(later, F.lit("+02:00")))
        .otherwise(iso)
    )
    return table(spark, folder, "events").select(
        "event_id", normalise_timestamp(text).cast("timestamp_ntz").alias("ts")
    )


def _price_text():
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", F.lit("nan"))
        .when(priority == "2-HIGH", F.lit("-inf"))
        .when(priority == "3-MEDIUM", F.format_number("o_totalprice", 2))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("  "), plain_number("o_totalprice")))
        .otherwise(F.concat(plain_number("o_totalprice"), F.lit("d")))
    )


@query(
    "safe_number",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN o_totalprice END AS price
    FROM orders
    """,
)
def safe_number(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", safe_double(strip_thousands(_price_text())).alias("price")
    )


@query(
    "token_null_number",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED'
                THEN o_totalprice END AS price,
           o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS not_a_number,
           o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AS below_all
    FROM orders
    """,
)
def token_null_number(spark, folder):
    status = F.col("o_orderstatus")
    text = F.when(status == "O", F.lit("")).when(status == "P", F.lit(".")).otherwise(_price_text())
    value = number_or_null(text)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        finite(value).alias("price"),
        F.coalesce(F.isnan(value), F.lit(False)).alias("not_a_number"),
        F.coalesce(value == F.lit(float("-inf")), F.lit(False)).alias("below_all"),
    )


def _balance_text():
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "BUILDING", F.lit("-999"))
        .when(segment == "MACHINERY", F.lit("-999.0"))
        .when(segment == "FURNITURE", F.lit("-9999"))
        .otherwise(plain_number("c_acctbal"))
    )


@query(
    "sentinel_exact",
    """
    SELECT c_custkey,
           CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN -999.0
                WHEN 'FURNITURE' THEN -9999.0 ELSE c_acctbal END AS balance
    FROM customer
    """,
)
def sentinel_exact(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", parse_double(null_if_token(_balance_text())).alias("balance")
    )


@query(
    "sentinel_threshold",
    """
    SELECT c_custkey,
           CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')
                 AND c_acctbal > -999 THEN c_acctbal END AS balance
    FROM customer
    """,
)
def sentinel_threshold(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", scrub_reading(_balance_text()).alias("balance")
    )
