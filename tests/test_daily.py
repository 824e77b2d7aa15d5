import datetime as dt

import pytest
from pyspark.sql import functions as F

from support import values
from dayloom.plans.cleaners import judge_price_lines, run_cleaner
from dayloom.plans.daily import DailyConfig, FeedInput, run_daily
from dayloom.schemas import FEEDS

DAY0 = dt.date(2024, 1, 1)
NAMES = {"price_a": ("price_a",), "price_b": ("price_b",), "weather": ("precipitation", "soil_moisture")}
AVERAGED = {"b_ma7": "price_b", "precip_ma7": "precipitation", "soil_ma7": "soil_moisture"}


def feeds(spark, days):
    """Each feed has every third day curated and every day staged twice, newest last."""
    out = {}
    for i, (key, columns) in enumerate(NAMES.items()):
        base = spark.range(days).withColumn("date", F.date_add(F.lit(DAY0), F.col("id").cast("int")))
        price = lambda plus: [(F.col("id") * (i + 2) % 17 + plus).cast("double").alias(c) for c in columns]  # noqa: E731,B023
        staged = [
            base.select("date", *price(plus), F.to_timestamp(F.lit(stamp)).alias("ingestion_time"))
            for plus, stamp in ((1, "2024-06-01"), (2, "2024-06-02"))
        ]
        curated = base.filter("id % 3 = 0").select("date", *price(0))
        out[key] = FeedInput(staged[0].unionByName(staged[1]), curated, columns)
    return out


def run(spark, out, days, **options):
    cfg = DailyConfig(feeds(spark, days), str(out), "price_a", AVERAGED, start=DAY0, **options)
    return run_daily(spark, cfg)


@pytest.mark.parametrize("stretch", [None, 60])
def test_whole_build(spark, tmp_path, stretch):
    paths = run(spark, tmp_path, 150, stretch_days=stretch, views={"features": "f_live", "metric": "m_live"})
    read = lambda name: spark.read.parquet(paths[name])
    assert read("price_a").count() == 150 and read("joined").count() == 150
    assert read("joined").filter(F.col("price_a") != (F.datediff("date", F.lit(DAY0)) * 2 % 17 + 2)).count() == 0
    assert spark.table("f_live").filter("target_40 is not null").count() == 110
    assert read("model").first().n == 110
    forecast = read("forecast")
    assert forecast.count() == 40
    assert forecast.agg(F.max("forecast_date")).first()[0] == DAY0 + dt.timedelta(days=189)
    assert read("backtest").filter("actual is null").count() == 40
    assert spark.table("m_live").first().mape_40d > 0


def test_keyed_build_equals_single_builds(spark, tmp_path):
    """Two series built together give what each gives alone."""
    keyed, alone = {}, feeds(spark, 120)
    for name, feed in alone.items():
        def both(df):
            other = df.select(*[(F.col(c) * 2 + 1).alias(c) if c in feed.columns else F.col(c) for c in df.columns])  # noqa: B023
            return df.withColumn("k", F.lit("one")).unionByName(other.withColumn("k", F.lit("two")))
        keyed[name] = FeedInput(both(feed.staging), both(feed.curated), feed.columns)
    cfg = DailyConfig(keyed, str(tmp_path / "k"), "price_a", AVERAGED, by=("k",), start=DAY0)
    together = run_daily(spark, cfg)
    single = run_daily(spark, DailyConfig(alone, str(tmp_path / "s"), "price_a", AVERAGED, start=DAY0))
    for name in ("joined", "forecast", "metric"):
        one = spark.read.parquet(together[name]).filter("k = 'one'").drop("k")
        want = spark.read.parquet(single[name])
        got = sorted(tuple(r) for r in one.select(want.columns).collect())
        assert [pytest.approx(r, rel=1e-6) if name == "metric" else r[0] for r in got] == [
            tuple(r) if name == "metric" else r[0] for r in sorted(tuple(r) for r in want.collect())]
    assert spark.read.parquet(together["joined"]).count() == 240
    assert spark.read.parquet(together["model"]).count() == 2


def test_training_cut_off(spark, tmp_path):
    cut = DAY0 + dt.timedelta(days=99)
    paths = run(spark, tmp_path, 150, train_until=cut)
    assert spark.read.parquet(paths["model"]).first().n == 60
    history = spark.read.parquet(paths["backtest"])
    assert history.filter("in_sample").count() == 60 and history.count() == 150
    paths = run(spark, tmp_path / "held", 150, hold_out=11)
    assert spark.read.parquet(paths["model"]).first().n == 100


def test_without_labels_nothing_is_modelled(spark, tmp_path):
    paths = run(spark, tmp_path, 30)
    assert set(paths) == {"price_a", "price_b", "weather", "joined"}


def test_empty_feeds_give_a_calendar_to_today(spark, tmp_path):
    today = dt.date(2024, 1, 5)
    empty = {
        k: FeedInput(
            spark.createDataFrame([], FEEDS[k].staging_schema),
            spark.createDataFrame([], FEEDS[k].curated_schema),
            FEEDS[k].values,
        )
        for k in NAMES
    }
    cfg = DailyConfig(empty, str(tmp_path), "price_a", AVERAGED, start=DAY0, as_of=F.lit(today))
    joined = spark.read.parquet(run_daily(spark, cfg)["joined"])
    assert joined.count() == 5 and joined.filter("price_a is not null").count() == 0


def test_cleaner_writes_both_tables(spark, tmp_path):
    lines = spark.createDataFrame([('"1/1/2024",1,2,3,5',), ('"1/1/2024",1,2,3,6',), ("x",)], "line string")
    curated, quarantine = str(tmp_path / "c"), str(tmp_path / "q")
    run_cleaner(spark, judge_price_lines(lines), curated, quarantine, values=("price_a",),
                policy="keep_first", order=["price_a"], reason_date="date")
    assert values(spark.read.parquet(curated)) == [(DAY0, 5.0)]
    assert values(spark.read.parquet(quarantine), "date", "errors") == [
        ("1/1/2024", "Duplicate record for date 2024-01-01"), ("x", "Malformed line")]
