import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import values
from dayloom.functions import (
    calendar_parts,
    date_from_compact,
    date_from_dmy,
    date_from_iso,
    date_from_wire,
    date_from_year_doy,
    normalise_timestamp,
    null_if_at_or_below,
    null_if_token,
    number_or_null,
    parse_double,
    safe_double,
    scrub_reading,
    strip_quotes,
    strip_thousands,
    within_lookback,
)

SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def texts(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "i int, s string")


def apply(spark, items, column):
    rows = texts(spark, items).select("i", column.alias("v")).orderBy("i").collect()
    return [r.v for r in rows]


def test_safe_double(spark):
    items = ["1.5", " 2 ", "1e3", ".5", "5.", "+3", "-999", "nan", "inf", "1_000", "1.5d", "2f"]
    items += ["0x1p3", "", ".", None, "1e999", "1,5", "--1"]
    want = [1.5, 2.0, 1000.0, 0.5, 5.0, 3.0, -999.0] + [None] * 12
    assert apply(spark, items, safe_double("s")) == want


def test_parse_double_keeps_special_values(spark):
    got = apply(spark, ["nan", "-NaN", "inf", "-Infinity", "1e999", "x"], parse_double("s"))
    assert math.isnan(got[0]) and math.isnan(got[1])
    assert got[2:] == [math.inf, -math.inf, math.inf, None]


def test_number_or_null_tokens(spark):
    assert apply(spark, ["", ".", None, "7", "inf"], number_or_null("s")) == [
        None, None, None, 7.0, math.inf,
    ]


@SLOW
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=30))
def test_safe_double_agrees_with_float(spark, numbers):
    assert apply(spark, [repr(n) for n in numbers], safe_double("s")) == numbers


@SLOW
@given(st.lists(st.text("0123456789.eE+-_ dfxn", max_size=8), min_size=1, max_size=40))
def test_safe_double_accepts_only_what_float_accepts(spark, items):
    def plain(text):
        try:
            value = float(text)
        except ValueError:
            return None
        return value if math.isfinite(value) and "_" not in text else None

    assert apply(spark, items, safe_double("s")) == [plain(t) for t in items]


def test_sentinels(spark):
    items = ["-999", "-999.0", "-998.9", "-1e4", "3"]
    assert apply(spark, items, parse_double(null_if_token("s"))) == [
        None, -999.0, -998.9, -10000.0, 3.0,
    ]
    assert apply(spark, items, scrub_reading("s")) == [None, None, -998.9, None, 3.0]
    assert apply(spark, items, null_if_at_or_below(parse_double("s"), 0.0))[-1] == 3.0


def test_strip(spark):
    assert apply(spark, ["1,234,567.8"], strip_thousands("s")) == ["1234567.8"]
    assert apply(spark, ['"a"', '""b'], strip_quotes("s")) == ["a", "b"]


def test_dates(spark):
    items = ["1/2/2023", "31/12/2023", "031/1/2023", "30/02/2023", "1/2/23", "2023-1-5", None]
    day = dt.date
    assert apply(spark, items, date_from_dmy("s")) == [
        day(2023, 2, 1), day(2023, 12, 31), None, None, None, None, None,
    ]
    assert apply(spark, ["2023-1-5", "2023-02-30", "20230105"], date_from_iso("s")) == [
        day(2023, 1, 5), None, None,
    ]
    assert apply(spark, ["20240229", "20230229", "2024229"], date_from_compact("s")) == [
        day(2024, 2, 29), None, None,
    ]
    wire = ["19723", "2024-01-01T10:00:00Z", "soon", "-1", "99999999999", None]
    assert apply(spark, wire, date_from_wire("s")) == [
        day(2024, 1, 1), day(2024, 1, 1), None, day(1969, 12, 31), None, None,
    ]


@SLOW
@given(st.lists(st.tuples(st.integers(1, 9998), st.integers(-400, 800)), min_size=1, max_size=20))
def test_year_doy_agrees_with_calendar(spark, pairs):
    df = spark.createDataFrame([(i, y, d) for i, (y, d) in enumerate(pairs)], "i int, y int, d int")
    got = [r.v for r in df.select("i", date_from_year_doy("y", "d").alias("v")).orderBy("i").collect()]

    def plain(y, d):
        try:
            return dt.date(y, 1, 1) + dt.timedelta(days=d - 1)
        except OverflowError:
            return None

    assert got == [plain(y, d) for y, d in pairs]


def test_year_doy_edges(spark):
    df = spark.createDataFrame([(2023, 366), (2023, 0), (2024, 60), (0, 1), (9999, 366), (2023, None)],
                               "y int, d int")
    got = [tuple(r) for r in df.select(date_from_year_doy("y", "d"), date_from_year_doy("y", "d", True)).collect()]
    assert got == [
        (dt.date(2024, 1, 1), None), (dt.date(2022, 12, 31), None),
        (dt.date(2024, 2, 29), dt.date(2024, 2, 29)), (None, None), (None, None), (None, None),
    ]


def test_normalise_timestamp(spark):
    items = [
        "2024-01-01T00:00:00Z", "2024-01-01 00:00:00 UTC", "2024-01-01T02:00:00+02:00",
        "2024-01-01T00:00:00", "1704067200", "1704067200.0", "2024-01-01", "x", None,
    ]
    got = apply(spark, items, normalise_timestamp("s").cast("timestamp_ntz"))
    assert got == [dt.datetime(2024, 1, 1)] * 7 + [None, None]


def test_lookback_and_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 15, 16)], "d date")
    kept = df.filter(within_lookback("d", F.lit(dt.date(2024, 1, 15)), 13))
    assert values(kept) == [(dt.date(2024, 1, 15),), (dt.date(2024, 1, 2),)]
    sunday = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    assert values(sunday.withColumns(calendar_parts("d")), "dow", "mon") == [("1", "1")]
