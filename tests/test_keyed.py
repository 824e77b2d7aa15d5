import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import plan_of, values
from dayloom.operators.dedup import any_value_by_key, dedup, latest_per_key
from dayloom.operators.quality import (
    apply_rules, assert_complete, joined, require_complete, rule_fields, rule_numeric, split,
)
from dayloom.operators.upsert import upsert

SLOW = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.integers(0, 2)), max_size=60
)


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "k int, o int, v int").repartition(parts)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@SLOW
@given(ROWS, st.sampled_from([1, 3, 64]))
def test_keep_first_against_brute_force(spark, rows, salts):
    kept, rejected = dedup(frame(spark, rows), ["k"], "keep_first", ["o", "v"], salts=salts)
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    want = Counter(min(g, key=lambda r: r[1:]) for g in groups.values())
    assert bag(kept) == want
    assert bag(rejected.drop("errors")) == Counter(rows) - want


@SLOW
@given(ROWS, st.sampled_from([1, 3, 64]))
def test_reject_all_against_brute_force(spark, rows, salts):
    kept, rejected = dedup(frame(spark, rows), ["k"], "reject_all", salts=salts)
    count = Counter(r[0] for r in rows)
    assert bag(kept) == Counter(r for r in rows if count[r[0]] == 1)
    assert bag(rejected.drop("errors")) == Counter(r for r in rows if count[r[0]] > 1)


@pytest.mark.parametrize("policy", ["keep_first", "reject_all"])
def test_rejects_are_ranked_among_repeated_keys_only(spark, policy):
    rows = [(k % 9 if k < 20 else k, k, 0) for k in range(60)] + [(None, n, 1) for n in range(9)]
    rows += [(k, 99, 1) for k in (0, 1) for _ in range(6)]
    rejected = dedup(frame(spark, rows), ["k"], policy, ["o"])[1]
    count = Counter(r[0] for r in rows)
    per_key = Counter(r[0] for r in bag(rejected.drop("errors")).elements())
    assert per_key == Counter({k: n - (policy == "keep_first") for k, n in count.items() if n > 1})
    assert "LeftSemi" in plan_of(rejected)


def test_hot_key_and_copies_are_spread(spark):
    """A third of the rows are copies of one row; no task may see a large share of them."""
    hot = spark.range(0, 30_000, 1, 12).select(F.lit(7).alias("k"), F.lit(1).alias("v"))
    cold = spark.range(0, 60_000, 1, 12).select(
        (F.col("id") + 100).cast("int").alias("k"), F.col("id").cast("int").alias("v"))
    from dayloom.operators.dedup import mark_duplicates

    df = hot.unionByName(cold)
    marked = mark_duplicates(df, ["k"], ["v"])
    text = plan_of(marked)
    assert text.count("Exchange hashpartitioning(k") == 2 and "_salt" in text and "_meet" in text
    kept, rejected = dedup(df, ["k"], "keep_first", ["v"])
    assert kept.count() == 60_001 and rejected.count() == 29_999
    kept, rejected = dedup(df, ["k"], "reject_all")
    assert kept.count() == 60_000 and rejected.count() == 30_000


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="unknown policy"):
        dedup(frame(spark, [(1, 1, 1)]), ["k"], "keep_last")


def test_kept_side_is_cut_before_the_shuffle(spark):
    for df in (
        latest_per_key(frame(spark, [(1, 1, 1)]), ["k"], ["o"]),
        dedup(frame(spark, [(1, 1, 1)]), ["k"], "keep_first", ["o"])[0],
        dedup(frame(spark, [(1, 1, 1)]), ["k"], "reject_all")[0],
    ):
        text = plan_of(df)
        assert "Partial" in text and "WindowGroupLimit" in text
        assert text.count("Exchange hashpartitioning(k") == 1


def test_latest_per_key(spark):
    df = frame(spark, [(1, 1, 5), (1, 2, 6), (1, 2, 7), (2, 1, 8), (None, 1, 9), (None, 2, 10)])
    got = latest_per_key(df, ["k"], ["o", "v"])
    assert values(got) == sorted([(1, 2, 7), (2, 1, 8), (None, 2, 10)], key=repr)


def test_any_value_per_column(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, 1.0, None), (2, None, None)], "k int, a double, b double")
    assert values(any_value_by_key(df, ["k"], ["a", "b"])) == [(1, 1.0, 2.0), (2, None, None)]


TARGET = [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (None, "n", 0.0)]
SOURCE = [(2, 20.0), (3, None), (4, 40.0), (None, 9.0)]


@pytest.mark.parametrize("how", [{}, {"target_salts": 3}])
def test_upsert(spark, how):
    target = spark.createDataFrame(TARGET, "k int, name string, v double")
    source = spark.createDataFrame(SOURCE, "k int, v double")
    run = lambda **o: values(upsert(target, source, ["k"], ["v"], **how, **o))
    assert run() == sorted([(1, "a", 1.0), (2, "b", 20.0), (3, "c", None), (4, None, 40.0),
                            (None, "n", 0.0), (None, None, 9.0)], key=repr)
    assert (3, "c", 3.0) in run(keep_existing_on_null=True)
    assert (None, None, 9.0) not in run(drop_null_keys=True)


KEYED = st.dictionaries(st.integers(0, 9), st.one_of(st.none(), st.integers(0, 5)), max_size=8)


@SLOW
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 3)), max_size=20),
    KEYED, st.integers(0, 2), st.booleans(), st.sampled_from([{}, {"target_salts": 4}]),
)
def test_upsert_against_brute_force(spark, old, new, nulls, keep, how):
    target = spark.createDataFrame(old, "k int, v int").repartition(3)
    arrivals = [*new.items(), *[(None, 7)] * nulls]
    source = spark.createDataFrame(arrivals, "k int, v int").repartition(2)

    def merged(k, v):
        if k not in new:
            return k, v
        return k, v if keep and new[k] is None else new[k]

    known = {k for k, _ in old if k is not None}
    want = Counter(merged(k, v) for k, v in old) + Counter((k, v) for k, v in arrivals if k not in known)
    assert bag(upsert(target, source, ["k"], ["v"], keep_existing_on_null=keep, **how)) == want


def test_a_key_that_the_source_holds_twice_ends_the_job(spark):
    target = spark.createDataFrame([(1, 1.0)], "k int, v double")
    twice = spark.createDataFrame([(2, 1.0), (2, 1.0), (None, 1.0), (None, 1.0)], "k int, v double")
    with pytest.raises(Exception, match="occurs twice"):
        upsert(target, twice, ["k"], ["v"]).count()
    assert upsert(target, twice.where("k is null"), ["k"], ["v"]).count() == 3


def test_a_finite_value_goes_before_the_others(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, nan), (1, 5.0), (1, inf), (2, nan), (3, None)], "k int, a double")
    got = {r.k: r.a for r in any_value_by_key(df, ["k"], ["a"]).collect()}
    assert got[1] == 5.0 and got[2] != got[2] and got[3] is None


def test_upsert_with_hot_target_key(spark):
    target = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    source = spark.createDataFrame([(1, -1.0), (2, 5.0)], "k int, v double")
    got = bag(upsert(target, source, ["k"], ["v"], target_salts=16))
    assert got == Counter({(1, -1.0): 1000, (2, 5.0): 1})


def test_rules(spark):
    df = spark.createDataFrame([(None, "x"), ("1", "2"), (None, None)], "a string, b string")
    rules = [rule_fields(["a", "b"]), rule_numeric("b", "n", "b")]
    judged = apply_rules(df.withColumn("n", F.col("b").try_cast("int")), rules)
    assert values(judged.select(joined())) == sorted([
        ("Missing fields: a; b is not a float",), ("",), ("Missing fields: a, b",)], key=repr)
    valid, invalid = split(judged)
    assert valid.columns == ["a", "b", "n"] and valid.count() == 1 and invalid.count() == 2


def test_assert_complete(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (None, None)], "a int, d date")
    assert assert_complete(require_complete(df, ["a"]), ["a", "d"]).count() == 1
    with pytest.raises(Exception, match="Invalid record: a is null"):
        assert_complete(df, ["a"]).collect()
    with pytest.raises(Exception, match="Invalid record: a is null"):
        assert_complete(df, ["a"]).count()
