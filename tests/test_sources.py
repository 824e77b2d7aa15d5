import datetime as dt
import json

import pytest

from support import plan_of, values
from pyspark.sql import functions as F
from dayloom.plans.cleaners import clean_observations, clean_price_lines, clean_weather_lines
from dayloom.schemas import FEED_SCHEMAS, FEEDS, OBSERVATION_DOCUMENT
from dayloom.sources.documents import explode_records, latest_observation, read_json_document, unpivot_json_maps
from dayloom.sources.lines import parse_plain_line, read_lines
from dayloom.sources.markup import dated_prices, extract_markup_rows, markup_latest_row, require_rows
from dayloom.sources.messages import build_envelope, decode_payload, encode_messages, publish, to_staging_row
from dayloom.sources.tables import read_marked, write_curated, write_marked, write_quarantine
from dayloom.operators.quality import Rule, apply_rules

DAY = dt.date


def lines(spark, items):
    return spark.createDataFrame([(i, t) for i, t in enumerate(items)], "i int, line string")


def test_read_lines_drops_one_header_per_file(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f'"head, {name}",x\n"{name}1",2\n{name}2,"3,4"\n')
    got = values(read_lines(spark, str(tmp_path), skip_header=True))
    assert got == sorted([('"a1",2',), ('a2,"3,4"',), ('"b1",2',), ('b2,"3,4"',)], key=repr)
    assert read_lines(spark, str(tmp_path)).count() == 6


PRICES = [
    '"31/12/2023","1","2","3","1,234.56"', '"1/2/2023",1,2,3,10', '"30/02/2023",1,2,3,10',
    '"2023-12-31",1,2,3,abc', '"31/12/2023",1,2,3,0', '"31/12/2023",1,2,3,-5',
    '"31/12/2023",1,2,3,nan', '"31/12/2023",1,2', "", '"31/12/2023",1,2,3,7,8',
    '"31/12/2023",1,2,3,', '"unclosed,1,2,3,4',
]


def test_price_lines(spark):
    kept, rejected = clean_price_lines(lines(spark, PRICES), order=["i"])
    assert values(kept) == [(DAY(2023, 12, 31), 1234.56), (DAY(2023, 2, 1), 10.0)]
    assert values(rejected) == sorted([
        ("30/02/2023", "10", "Invalid date format: 30/02/2023"),
        ("2023-12-31", "abc", "Invalid date format: 2023-12-31; Invalid Euro_Price"),
        ("31/12/2023", "0", "Euro_Price must be positive"),
        ("31/12/2023", "-5", "Euro_Price must be positive"),
        ("31/12/2023", "nan", "Invalid Euro_Price"),
        ('"31/12/2023",1,2', None, "Malformed line"),
        ("", None, "Malformed line"),
        ('"unclosed,1,2,3,4', None, "Malformed line"),
        ("31/12/2023", "", "Invalid Euro_Price"),
        ("31/12/2023", "7", "Duplicate record for date 2023-12-31"),
    ], key=repr)


def test_price_lines_can_keep_non_finite(spark):
    kept, _ = clean_price_lines(lines(spark, ['"1/1/2024",1,2,3,inf']), allow_non_finite=True)
    assert values(kept) == [(DAY(2024, 1, 1), float("inf"))]


def test_parser_runs_once_per_row(spark):
    kept, _ = clean_price_lines(lines(spark, PRICES), order=["i"])
    assert plan_of(kept).count("Generate inline") == 3
    assert "Filter" not in plan_of(kept).split("from_csv")[-1].split("Scan")[0]


def test_observations(spark, tmp_path):
    rows = [("2024-01-02", "77.1"), ("2024-01-03", "."), ("2024-01-04", None), ("2013-12-31", "5"),
            ("x", "abc"), (None, "1"), ("2024-01-05", "1"), ("2024-01-05", "2"),
            ("2014-01-01", "1"), ("2025-12-31", "1"), ("2026-01-01", "1")]
    document = {"observations": [{"date": d, "value": v} for d, v in rows]}
    (tmp_path / "a.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"other": 1}, indent=2))
    kept, rejected = clean_observations(read_json_document(spark, str(tmp_path), OBSERVATION_DOCUMENT))
    assert values(kept) == sorted([
        (DAY(2024, 1, 2), 77.1), (DAY(2014, 1, 1), 1.0), (DAY(2025, 12, 31), 1.0)], key=repr)
    assert values(rejected) == sorted([
        ("2024-01-03", ".", "Missing Brent_Price"), ("2024-01-04", None, "Missing Brent_Price"),
        ("2013-12-31", "5", "Date out of range"), ("2026-01-01", "1", "Date out of range"),
        ("x", "abc", "Invalid date format; Missing Brent_Price"), (None, "1", "Invalid date format"),
        ("2024-01-05", "1", "Duplicate record for date 2024-01-05"),
        ("2024-01-05", "2", "Duplicate record for date 2024-01-05")], key=repr)


WEATHER = ["2024,60,1.5,0.7", "2024,61,-999,0.7", "2024,62,-999.0,0.7", "2023,366,1,1", "2023,0,1,1",
           "YEAR,DOY,A,B", "2024,60,1", "2026,1,1,1", "2024,63,1,1", "2024,63,2,1", "preamble"]


def test_weather_lines(spark):
    kept, rejected = clean_weather_lines(lines(spark, WEATHER))
    assert values(kept) == sorted([
        (DAY(2024, 2, 29), 1.5, 0.7), (DAY(2024, 1, 1), 1.0, 1.0), (DAY(2022, 12, 31), 1.0, 1.0)], key=repr)
    assert values(rejected) == sorted([
        ("2026-01-01", "1.0", "1.0", "Date out of range (2014-01-01 to 2025-12-31)"),
        ("2024-03-03", "1.0", "1.0", "Duplicate date"), ("2024-03-03", "2.0", "1.0", "Duplicate date")], key=repr)


def test_weather_options(spark):
    _, rejected = clean_weather_lines(lines(spark, WEATHER[:3]), quarantine_incomplete=True)
    assert values(rejected, "date", "errors") == [
        ("2024-03-01", "Missing precipitation value"), ("2024-03-02", "Missing precipitation value")]
    kept, _ = clean_weather_lines(lines(spark, WEATHER[:3]), threshold=False)
    assert (DAY(2024, 3, 2), -999.0, 0.7) in values(kept)
    kept, _ = clean_weather_lines(lines(spark, WEATHER[3:5]), strict_doy=True)
    assert values(kept) == []


def test_plain_line_keeps_other_columns(spark):
    assert values(parse_plain_line(lines(spark, ["2024,1,2,3,4"]))) == [(0, 2024, 1, 2.0, 3.0)]


PAGE = """<table id="table_1"><tbody>
<tr id="table_1_row_0"><td>1</td><td> 02/01/2024 </td><td></td><td></td><td></td><td><b>3,000.5</b></td></tr>
<tr id="table_1_row_1"><td>1</td><td>03/01/2024</td><td>short</td></tr>
<tr id="table_1_row_2"><td>1</td><td>late</td><td></td><td></td><td></td><td>9</td></tr>
<tr id='table_1_row_3'><td>1</td><td>04/01/2024</td><td></td><td></td><td></td><td>10</td></tr>
<tr id='table_1_row_4'><td>1</td><td>04/01/2024</td><td></td><td></td><td></td><td>11</td></tr>
<tr><td>1</td><td>05/01/2024</td><td></td><td></td><td></td><td>12</td></tr>
</tbody></table>"""


def test_markup(spark):
    page = spark.createDataFrame([(1, PAGE)], "page int, html string")
    prices = dated_prices(extract_markup_rows(page, "html", keep=("page",)), ("page",))
    assert values(prices, "date", "price") == [
        (DAY(2024, 1, 2), 3000.5), (DAY(2024, 1, 4), 10.0), (DAY(2024, 1, 4), 11.0)]
    newest = markup_latest_row(prices, ["page"], ["row_no"])
    assert values(newest, "date", "price") == [(DAY(2024, 1, 4), 10.0)]


def test_cell_text_resolves_entities(spark):
    html = '<tr id="table_1"><td>a &amp;lt; <b>b</b>&nbsp;</td><td>&#39;1&#39; &lt;</td></tr>'
    page = spark.createDataFrame([(html,)], "html string")
    assert extract_markup_rows(page, "html", min_cells=2).first().cells == ["a &lt; b", "'1' <"]


def test_page_without_rows_fails(spark):
    none = spark.createDataFrame([(0,)], "found long")
    with pytest.raises(Exception, match="price rows not found"):
        require_rows(none, "found").collect()


def test_json_maps_meet_on_common_days(spark):
    text = json.dumps({"properties": {"parameter": {
        "p": {"20240101": 1.0, "20240102": -999.0, "20240104": 4.0},
        "s": {"20240102": 0.2, "20240101": 0.1, "20240103": 0.3}}}})
    df = spark.createDataFrame([(1, text), (2, "{}")], "i int, doc string")
    paths = {"p": "$.properties.parameter.p", "s": "$.properties.parameter.s"}
    got = unpivot_json_maps(df, "doc", paths, ("i",))
    assert values(got) == [(1, "20240101", 1.0, 0.1), (1, "20240102", -999.0, 0.2)]


def test_explode_records_without_list(spark):
    df = spark.createDataFrame([(None,)], OBSERVATION_DOCUMENT)
    assert explode_records(df, "observations").count() == 0


def test_latest_observation_looks_back(spark):
    df = spark.createDataFrame(
        [("a", DAY(2024, 1, 1), 1), ("a", DAY(2024, 1, 20), 2), ("b", DAY(2024, 1, 1), 3)],
        "k string, d date, v int")
    got = latest_observation(df, ["k"], ["d"], "d", 14, F.lit(DAY(2024, 1, 20)))
    assert values(got) == [("a", DAY(2024, 1, 20), 2)]


def test_envelope_and_decode(spark):
    feed = FEEDS["weather"]
    rows = spark.createDataFrame([(DAY(2024, 1, 1), 1.5, None)],
                                 "date date, precipitation double, soil_moisture double")
    sent = encode_messages(build_envelope(rows, "date", list(feed.values)))
    bad = spark.createDataFrame([("{oops",), (None,), ('{"date": 19723, "raw_payload": ""}',)], "value string")
    decoded = decode_payload(sent.unionByName(bad), "value", feed.wire_schema)
    assert decoded.filter("decode_error is not null").count() == 2
    staged = to_staging_row(decoded.filter("decode_error is null"), feed)
    got = {r.date: r for r in staged.collect()}
    assert set(got) == {DAY(2024, 1, 1)}
    payloads = sorted(json.loads(r.raw_payload)["date"] for r in staged.collect())
    assert payloads == ["19723", "2024-01-01"]
    assert json.loads(staged.filter("precipitation = 1.5").first().raw_payload)["soil_moisture"] is None
    assert staged.schema["ingestion_time"].dataType == feed.staging_schema["ingestion_time"].dataType


def test_publish_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([(DAY(2024, 1, 1), 1.5)], "date date, price_a double")
    publish(encode_messages(build_envelope(rows, "date", ["price_a"])), "text", path=str(tmp_path / "out"))
    decoded = decode_payload(spark.read.text(str(tmp_path / "out")), "value", FEEDS["price_a"].wire_schema)
    assert values(decoded, "record.date", "record.price_a") == [("2024-01-01", 1.5)]


def test_avro_schema_is_nullable():
    fields = json.loads(FEEDS["weather"].avro_schema)["fields"]
    assert [f["name"] for f in fields] == FEEDS["weather"].wire_schema.fieldNames()
    assert all(f["type"][0] == "null" and f["default"] is None for f in fields)


def test_schemas_are_nullable():
    assert all(f.nullable for schema in FEED_SCHEMAS.values() for f in schema.fields)
    assert FEEDS["weather"].quarantine_schema.fieldNames() == [
        "date", "precipitation", "soil_moisture", "errors"]
    assert [f.dataType.simpleString() for f in FEEDS["price_a"].curated_schema] == ["date", "double"]


def test_table_writes(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "n")
    judged = apply_rules(df, [Rule(F.col("n") > 6, "too big"), Rule(F.col("n") > 8, "far too big")])
    write_marked(judged, str(tmp_path / "m"))
    assert read_marked(spark, str(tmp_path / "m"), True).count() == 7
    write_quarantine(judged.filter("n > 6"), str(tmp_path / "q"))
    got = values(spark.read.parquet(str(tmp_path / "q")))
    assert got == [("7", "too big"), ("8", "too big"), ("9", "too big; far too big")]
    write_curated(df.limit(1), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1
    assert "PartitionFilters: [isnotnull(is_valid" in plan_of(read_marked(spark, str(tmp_path / "m"), True))
