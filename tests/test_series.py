import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import plan_of, values
from dayloom.catalog import QUERIES
from dayloom.operators import spine
from dayloom.operators.features import add_lags, add_lead_target, add_moving_avg, feature_matrix
from dayloom.operators.fill import forward_fill
from dayloom.operators.series import assert_dense, over_series
from dayloom.operators.spine import as_of_daily, bounds_by_key, date_spine, join_on_spine, spine_bounds

DAY0 = dt.date(2024, 1, 1)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SPARSE = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 60), st.one_of(st.none(), st.integers(0, 9))),
    max_size=30, unique_by=lambda r: r[:2],
)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def frame(spark, rows, column="v"):
    data = [(k, day(n), None if v is None else float(v)) for k, n, v in rows]
    return spark.createDataFrame(data, f"k string, date date, {column} double")


def test_bounds_skip_empty_sources(spark):
    a, none = frame(spark, [("a", 3, 1)]), frame(spark, [])
    assert values(spine_bounds([(a, "date"), (none, "date")], DAY0)) == [(DAY0, day(3))]
    empty = spine_bounds([(none, "date")], DAY0, F.lit(day(5)))
    assert values(empty) == [(DAY0, day(5))]


def test_spine_with_ends_the_wrong_way_round(spark):
    bounds = spark.createDataFrame([("a", day(2), day(1)), ("b", day(1), day(1))], "k string, lo date, hi date")
    assert values(date_spine(bounds, ["k"])) == [("b", day(1))]


def reference_as_of(rows_v, rows_w, lo, hi):
    out = []
    for k in {r[0] for r in rows_v + rows_w}:
        known = {"v": None, "w": None}
        for n in range(lo, hi + 1):
            for name, rows in (("v", rows_v), ("w", rows_w)):
                for kk, m, value in rows:
                    if kk == k and m == n and value is not None:
                        known[name] = float(value)
            out.append((k, day(n), known["v"], known["w"]))
    return sorted(out, key=repr)


@SLOW
@given(SPARSE, SPARSE)
def test_as_of_daily_against_brute_force(spark, rows_v, rows_w):
    sources = [(frame(spark, rows_v, "v"), ["v"]), (frame(spark, rows_w, "w"), ["w"])]
    got = values(as_of_daily(sources, "date", ["k"], day(0), day(60)))
    assert got == reference_as_of(rows_v, rows_w, 0, 60)


@SLOW
@given(SPARSE)
def test_as_of_daily_equals_spine_join_and_fill(spark, rows):
    df = frame(spark, [("a", *r[1:]) for r in {r[1]: r for r in rows}.values()])
    spine = date_spine(spark.createDataFrame([(DAY0, day(60))], "lo date, hi date"))
    long = forward_fill(join_on_spine(spine, [(df, ["v"])], ["date"]), ["v"], "date", whole=True)
    got = as_of_daily([(df.drop("k"), ["v"])], "date", lo=DAY0, hi=day(60))
    assert values(got, "date", "v") == values(long, "date", "v")


def test_as_of_daily_options(spark):
    df = frame(spark, [("a", 2, 1), ("a", 4, 2), ("b", 1, None)])
    own = values(as_of_daily([(df, ["v"])], "date", ["k"]))
    assert own == [("a", day(2), 1.0), ("a", day(3), 1.0), ("a", day(4), 2.0), ("b", day(1), None)]
    # Days before the calendar are not carried into it, and an empty one still has its days.
    assert values(as_of_daily([(df.filter("k = 'a'"), ["v"])], "date", ["k"], day(3), day(4))) == [
        ("a", day(3), None), ("a", day(4), 2.0)]
    empty = as_of_daily([(df.limit(0).drop("k"), ["v"])], "date", lo=DAY0, hi=day(1))
    assert values(empty) == [(day(0), None), (day(1), None)]


def test_as_of_daily_takes_no_join(spark):
    sources = [(frame(spark, [("a", 1, 1)], c), [c]) for c in ("v", "w")]
    text = plan_of(as_of_daily(sources, "date", ["k"], DAY0, day(9)))
    assert "Join" not in text and "SinglePartition" not in text
    assert text.count("Exchange hashpartitioning") == 2


@SLOW
@given(SPARSE)
def test_as_of_daily_in_parts_equals_plain(spark, rows):
    df = frame(spark, rows)
    plain = values(as_of_daily([(df, ["v"])], "date", ["k"], day(0), day(60)))
    cut = as_of_daily([(df, ["v"])], "date", ["k"], day(0), day(60), parts=5, unique=True)
    assert values(cut) == plain and (not rows or cut.rdd.getNumPartitions() == 5)


def test_feature_matrix_bounds_the_days_of_a_task(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    whole = QUERIES["feature_matrix"](spark, folder)
    expected, days = values(whole), whole.count()
    monkeypatch.setattr(spine, "DAYS_PER_TASK", days // 50)
    cut = QUERIES["feature_matrix"](spark, folder)
    assert 45 <= cut.rdd.getNumPartitions() <= 55
    assert values(cut) == expected
    # Summed once and gathered by series once: days are not grouped again in between.
    assert plan_of(cut).split("== Initial Plan ==")[-1].count("HashAggregate(keys=[l_suppkey") == 2


@SLOW
@given(SPARSE, st.integers(1, 20))
def test_bucketed_fill_equals_plain(spark, rows, width):
    df = frame(spark, rows)
    bucket = F.floor(F.datediff(F.col("date"), F.lit(DAY0)) / width)
    plain = values(forward_fill(df, ["v"], "date", ["k"]))
    cut = forward_fill(df, ["v"], "date", ["k"], bucket=bucket)
    assert values(cut) == plain and "Join" not in plan_of(cut)


def test_fill_without_key_by_ranges(spark):
    random.seed(1)
    rows = [("a", n, random.choice([None, None, None, n])) for n in range(400)]
    df = frame(spark, rows).drop("k").repartition(7)
    plain = values(forward_fill(df, ["v"], "date", whole=True))
    for got in (forward_fill(df, ["v"], "date", ranges=6), forward_fill(df, ["v"], "date")):
        assert values(got) == plain and got.columns == df.columns


def test_keyed_fill_by_ranges(spark):
    random.seed(4)
    rows = [(k, n, random.choice([None, None, n])) for n in range(150) for k in ("a", "b", None)]
    df = frame(spark, rows).repartition(5)
    assert values(forward_fill(df, ["v"], "date", ["k"], ranges=9)) == values(
        forward_fill(df, ["v"], "date", ["k"]))


def dense(spark, keys="ab", days=200):
    random.seed(2)
    rows = [(k, n, None if random.random() < 0.1 else random.randint(0, 99)) for k in keys for n in range(days)]
    return frame(spark, rows)


@pytest.mark.parametrize("stretch", [40, 41, 97, 500])
def test_stretches_equal_plain_windows(spark, stretch):
    df = dense(spark)
    plain = feature_matrix(df, "v", {"ma": "v"}, by=["k"])
    cut = feature_matrix(df, "v", {"ma": "v"}, by=["k"], stretch_days=stretch)
    assert values(cut) == values(plain)
    single = dense(spark, "a").drop("k")
    assert values(feature_matrix(single, "v", {"ma": "v"}, stretch_days=stretch)) == values(
        feature_matrix(single, "v", {"ma": "v"}))


def test_single_features_with_stretches(spark):
    df = dense(spark)
    for add in (
        lambda s: add_lags(df, "v", (1, 3), by=["k"], stretch_days=s),
        lambda s: add_moving_avg(df, {"m": "v"}, by=["k"], stretch_days=s),
        lambda s: add_lead_target(df, "v", 10, by=["k"], stretch_days=s),
    ):
        assert values(add(30)) == values(add(None))


def test_stretch_must_cover_reach(spark):
    with pytest.raises(ValueError, match="stretch"):
        over_series(dense(spark), lambda w: {}, "date", ["k"], back=5, stretch_days=4)


def test_feature_values(spark):
    df = frame(spark, [("a", n, n) for n in range(50)])
    rows = {r.date: r for r in feature_matrix(df, "v", {"ma": "v"}, by=["k"]).collect()}
    first, last, tenth = rows[day(0)], rows[day(49)], rows[day(9)]
    assert (first.y_lag1, first.ma, first.target_40) == (None, 0.0, 40.0)
    assert (last.y_lag1, last.y_lag7, last.y_lag28, last.target_40) == (48.0, 42.0, 21.0, None)
    assert tenth.target_40 == 49.0 and rows[day(10)].target_40 is None
    assert tenth.ma == 6.0 and rows[day(2)].ma == 1.0
    assert (tenth.dow, tenth.mon) == ("4", "1")


def test_features_are_one_window(spark):
    text = plan_of(feature_matrix(dense(spark), "v", {"ma": "v"}, by=["k"]))
    assert text.count("Window [") == 1 and text.count("Exchange hashpartitioning") == 1
    cut = plan_of(feature_matrix(dense(spark, "a").drop("k"), "v", {"ma": "v"}, stretch_days=60))
    assert "SinglePartition" not in cut and cut.count("Exchange hashpartitioning") == 1


def test_assert_dense(spark):
    assert assert_dense(dense(spark), "date", ["k"]).count() == 400
    with pytest.raises(Exception, match="not one row per day"):
        assert_dense(frame(spark, [("a", 0, 1), ("a", 2, 1)]), "date", ["k"]).collect()


def test_bounds_by_key(spark):
    df = frame(spark, [("a", 1, 1), ("a", 5, 1), ("b", 2, 1)])
    assert values(bounds_by_key(df, ["k"], "date")) == [("a", day(1), day(5)), ("b", day(2), day(2))]
