"""The build kept up to date by batches equals the whole build, and touches what it has to."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.operators import dirty
from dayloom.plans.daily import DailyConfig, FeedInput, run_daily
from dayloom.plans.incremental import IncrementalDaily
from dayloom.schemas import FEEDS

START = dt.date(2020, 1, 1)
COLUMNS = {"price_a": ("price_a",), "price_b": ("price_b",), "weather": ("precipitation", "soil_moisture")}
AVERAGED = {"b_ma7": "price_b", "precip_ma7": "precipitation", "soil_ma7": "soil_moisture"}
KEY = T.StructField("k", T.StringType())


def day(n):
    return START + dt.timedelta(days=n)


def schema_of(feed, keyed):
    fields = [f for f in FEEDS[feed].staging_schema if f.name != "raw_payload"]
    return T.StructType([*([KEY] if keyed else []), *fields])


def arrivals(days, seed, keys=("one", "two"), keyed=False, stamp=1, share=0.4):
    """Each feed's rows (key, date, values, ingestion_time) on a share of the days, some values missing."""
    draw = random.Random(seed)
    out = {}
    for feed, columns in COLUMNS.items():
        out[feed] = [((k,) if keyed else ()) + (day(n), *[draw.choice([None, round(draw.random() * 50, 2)]) if draw.random() < 0.2 else
                      round(draw.random() * 50, 2) for _ in columns], dt.datetime(2024, 1, 1, 0, 0, stamp))
                     for n in days for k in (keys if keyed else (None,)) if draw.random() < share]
    return out


def frames(spark, batch, keyed=False):
    return {feed: spark.createDataFrame(rows, schema_of(feed, keyed)) for feed, rows in batch.items()}


def whole(spark, folder, batches, keyed=False):
    """The full build over all batches."""
    rows = {feed: [r for b in batches for r in b.get(feed, [])] for feed in COLUMNS}
    curated = lambda feed: T.StructType([*([KEY] if keyed else []), *FEEDS[feed].curated_schema])
    feeds = {f: FeedInput(spark.createDataFrame(rows[f], schema_of(f, keyed)), spark.createDataFrame([], curated(f)), COLUMNS[f]) for f in COLUMNS}
    return run_daily(spark, DailyConfig(feeds, folder, "price_a", AVERAGED, ("k",) if keyed else (), start=START))


def rounded(df):
    """Rows in order, without the part; numbers to eight digits."""
    columns = sorted(c for c in df.columns if c != "month")
    cut = lambda v: float(f"{v:.8g}") if isinstance(v, float) else v
    return sorted((tuple(cut(v) for v in r) for r in df.select(columns).collect()), key=repr)


def same_as_whole(spark, build, folder, batches, keyed=False):
    paths = whole(spark, folder, batches, keyed)
    for feed in COLUMNS:
        assert rounded(build.curated(feed)) == rounded(spark.read.parquet(paths[feed]))
    assert rounded(build.joined()) == rounded(spark.read.parquet(paths["joined"]))
    if "model" not in paths:
        return
    for name in ("forecast", "backtest"):
        got, want = rounded(build.output(name)), rounded(spark.read.parquet(paths[name]))
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert [x for x in a if not isinstance(x, float)] == [x for x in b if not isinstance(x, float)]
            assert [x for x in a if isinstance(x, float)] == pytest.approx([x for x in b if isinstance(x, float)], rel=1e-5, abs=1e-5)
    got = [r[-1] for r in rounded(build.output("metric"))]
    assert got == pytest.approx([r[-1] for r in rounded(spark.read.parquet(paths["metric"]))], rel=1e-5)


def stamps(path):
    return {d: max(os.stat(os.path.join(path, d, f)).st_mtime_ns for f in os.listdir(os.path.join(path, d)))
            for d in os.listdir(path) if d.startswith("month=")}


def test_batches_give_the_whole_build(spark, tmp_path):
    """Late days, a longer calendar and a new key, each applied to what is there."""
    build = IncrementalDaily(spark, str(tmp_path / "b"), COLUMNS, "price_a", AVERAGED, (KEY,), START)
    first = arrivals(range(400), 1, keyed=True)
    late = arrivals([130, 131], 2, keyed=True, stamp=2, share=0.9)
    grown = arrivals(range(398, 440), 3, ("one", "two", "three"), True, 3)
    batches = []
    for number, batch in enumerate([first, late, grown]):
        before = {t: stamps(tmp_path / "b" / t) for t in ("joined", "features")} if number else {}
        assert build.apply(number, frames(spark, batch, True))
        batches.append(batch)
        for name, known in before.items():
            now = stamps(tmp_path / "b" / name)
            assert {m[6:] for m in now if known.get(m) != now[m]} == set(build.report[name])
        if number == 1:
            # Two changed days of fourteen months.
            assert 1 <= len(build.report["joined"]) <= 3 and len(build.report["features"]) <= 6
            same_as_whole(spark, build, str(tmp_path / "w1"), batches, True)
    assert not build.apply(2, frames(spark, late, True))
    same_as_whole(spark, build, str(tmp_path / "w2"), batches, True)


def test_curated_months_out_of_reach_are_not_read(spark, tmp_path):
    build = IncrementalDaily(spark, str(tmp_path), COLUMNS, "price_a", AVERAGED, (), START)
    build.apply(0, frames(spark, arrivals(range(480), 1, share=0.7)))
    expected = {r["date"]: r["price_a"] for r in build.joined().collect()}
    for feed in COLUMNS:
        for name in os.listdir(tmp_path / "curated" / feed):
            if name.startswith("month=") and name not in ("month=2020-06", "month=2020-07"):
                for f in os.listdir(tmp_path / "curated" / feed / name):
                    open(tmp_path / "curated" / feed / name / f, "w").close()
    build.apply(1, frames(spark, {"price_a": [(dt.date(2020, 6, 5), 99.0, dt.datetime(2025, 1, 1))]}))
    now = {r["date"]: r["price_a"] for r in build.joined().collect()}
    assert now[dt.date(2020, 6, 5)] == 99.0 and sum(now[d] != expected[d] for d in now) <= 8


def test_a_batch_that_was_cut_off_is_applied_again(spark, tmp_path, monkeypatch):
    build = IncrementalDaily(spark, str(tmp_path / "b"), COLUMNS, "price_a", AVERAGED, (), START)
    batches = [arrivals(range(150), 1), arrivals([40, 149, 160], 2, stamp=2, share=1.0)]
    build.apply(0, frames(spark, batches[0]))
    real = IncrementalDaily._build_features
    monkeypatch.setattr(IncrementalDaily, "_build_features", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        build.apply(1, frames(spark, batches[1]))
    monkeypatch.setattr(IncrementalDaily, "_build_features", real)
    with pytest.raises(ValueError, match="applied again"):
        build.apply(2, frames(spark, batches[1]))
    assert build.apply(1, frames(spark, batches[1]))
    same_as_whole(spark, build, str(tmp_path / "w"), batches)


def test_without_labels_the_outputs_before_stay(spark, tmp_path):
    build = IncrementalDaily(spark, str(tmp_path), COLUMNS, "price_a", AVERAGED, (), START)
    assert build.apply(0, {}) and build.output("metric") is None
    build.apply(1, frames(spark, arrivals(range(30), 1)))
    assert build.output("metric") is None and build.joined().count() == 30
    build.apply(2, frames(spark, arrivals(range(30, 120), 2)))
    metric = rounded(build.output("metric"))
    assert len(metric) == 1 and build.output("forecast").count() == 40
    # Every label goes: what the batch before has written is still there under the same name.
    build.apply(3, frames(spark, {"price_a": [(day(n), None, dt.datetime(2025, 1, 1)) for n in range(120)]}))
    assert build.joined().filter("price_a is not null").isEmpty() and rounded(build.output("metric")) == metric


def test_fill_reach_and_runs(spark):
    changes = spark.createDataFrame([("x", "a", day(3)), ("x", "b", day(3)), ("y", "a", day(5))], "k string, column string, date date")
    points = spark.createDataFrame([("x", "a", day(3)), ("x", "a", day(9)), ("x", "a", day(7)), ("y", "a", day(2))], "k string, column string, date date")
    got = sorted(tuple(r) for r in dirty.fill_reach(changes, points, ["k"], "date", day(20)).collect())
    assert got == [("x", day(3), day(6)), ("x", day(3), day(20)), ("y", day(5), day(20))]
    assert dirty.runs(["2020-12", "2021-01", "2021-03", "2020-12"]) == [["2020-12", "2021-01"], ["2021-03"]]
    assert dirty.months_between(dt.date(2020, 12, 31), dt.date(2021, 2, 1)) == ["2020-12", "2021-01", "2021-02"]
    intervals = spark.createDataFrame([(day(0), day(0))], "lo date, hi date")
    assert dirty.months_of(dirty.widened(intervals, 31, 5), day(0), day(400)) == ["2020-01", "2020-02"]
