"""The daily build: merge the feeds, densify, build features, fit, forecast, evaluate."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.operators.dedup import latest_per_key
from dayloom.operators.evaluate import (
    backtest,
    forecast,
    has_labels,
    mape,
    score_history,
    split_rows,
)
from dayloom.operators.features import HORIZON, feature_matrix
from dayloom.operators.ridge import DEFAULT_L2, fit_ridge
from dayloom.operators.spine import as_of_daily, spine_bounds
from dayloom.operators.upsert import upsert
from dayloom.schemas import CALENDAR_START
from dayloom.sources.tables import register_view, write_curated


@dataclass(frozen=True)
class FeedInput:
    """Arrivals of a feed and the curated rows they are merged into."""

    staging: DataFrame
    curated: DataFrame
    columns: tuple[str, ...]
    order: tuple[str, ...] = ("ingestion_time",)
    keep_existing_on_null: bool = False


@dataclass(frozen=True)
class DailyConfig:
    """``out`` is a new folder for each run: no table is replaced while it is read.

    With ``train_until`` the model sees only days whose outcome was known by then, and the
    backtest tells the two kinds of days apart; with ``hold_out`` one day in that many is
    left out of training. By default the model is fitted on all days.
    """

    feeds: dict[str, FeedInput]
    out: str
    target: str
    averaged: dict[str, str]
    by: tuple[str, ...] = ()
    start: dt.date = CALENDAR_START
    as_of: Column | None = None
    horizon: int = HORIZON
    l2: float = DEFAULT_L2
    stretch_days: int | None = None
    categorical: tuple[str, ...] = ("dow", "mon")
    train_until: dt.date | None = None
    hold_out: int | None = None
    views: dict[str, str] = field(default_factory=dict)


def merge_feed(feed: FeedInput, by: tuple[str, ...]) -> DataFrame:
    keys = [*by, "date"]
    newest = latest_per_key(feed.staging, keys, list(feed.order)).select(*keys, *feed.columns)
    return upsert(feed.curated, newest, keys, list(feed.columns), feed.keep_existing_on_null)


def build_joined(
    curated: dict[str, tuple[DataFrame, list[str]]],
    by: tuple[str, ...],
    start: dt.date,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per (key and) day from ``start`` to the newest day of any feed."""
    bounds = spine_bounds([(df, "date") for df, _ in curated.values()], start, as_of)
    return as_of_daily(
        list(curated.values()), "date", list(by), start, bounds.select("hi").scalar()
    )


def run_daily(spark: SparkSession, cfg: DailyConfig) -> dict[str, str]:
    """Runs the build and returns where each table was written.

    Tables are written and read back by the next step, which keeps a lost executor from
    redoing the whole build. The features are a view over the joined table; they are kept
    while the model is fitted and applied, gathered by key, so that neither step moves them
    again. Without any labelled row the model tables are not written, so those of the run
    before stay in use.
    """
    paths, curated = {}, {}
    for key, feed in cfg.feeds.items():
        paths[key] = f"{cfg.out}/curated/{key}"
        write_curated(merge_feed(feed, cfg.by), paths[key])
        curated[key] = (spark.read.parquet(paths[key]), list(feed.columns))

    paths["joined"] = f"{cfg.out}/joined"
    write_curated(build_joined(curated, cfg.by, cfg.start, cfg.as_of), paths["joined"])
    joined = spark.read.parquet(paths["joined"])

    by = list(cfg.by)
    features = feature_matrix(
        joined, cfg.target, cfg.averaged, by=by, horizon=cfg.horizon, stretch_days=cfg.stretch_days
    )
    if "features" in cfg.views:
        register_view(features, cfg.views["features"])
    kept = features.persist()
    try:
        paths |= _model_tables(spark, cfg, joined, kept)
    finally:
        kept.unpersist()
    return paths


def _model_tables(
    spark: SparkSession, cfg: DailyConfig, joined: DataFrame, features: DataFrame
) -> dict[str, str]:
    paths, by = {}, list(cfg.by)
    label = f"target_{cfg.horizon}"
    training = features
    if cfg.train_until is not None:
        training = features.filter(F.date_add("date", cfg.horizon) <= F.lit(cfg.train_until))
    if cfg.hold_out:
        training, _ = split_rows(training, cfg.hold_out)
    if not has_labels(training, label):
        return paths
    categorical = list(cfg.categorical)
    numeric = [c for c in features.columns if c not in (*by, "date", label, *categorical)]
    paths["model"] = f"{cfg.out}/model"
    write_curated(fit_ridge(training, numeric, label, categorical, cfg.l2, by), paths["model"])
    model = spark.read.parquet(paths["model"])

    paths["forecast"] = f"{cfg.out}/forecast"
    write_curated(
        forecast(features, model, numeric, categorical, cfg.horizon, by=by), paths["forecast"]
    )
    paths["backtest"] = f"{cfg.out}/backtest"
    scored = score_history(features, model, numeric, categorical, cfg.horizon, by=by)
    truth = joined.withColumnRenamed(cfg.target, "y")
    write_curated(
        backtest(scored, truth, by=by, train_until=cfg.train_until), paths["backtest"]
    )
    history = spark.read.parquet(paths["backtest"])
    paths["metric"] = f"{cfg.out}/metric"
    write_curated(
        mape(history, "actual", f"yhat_{cfg.horizon}", by, f"mape_{cfg.horizon}d"), paths["metric"]
    )
    if "metric" in cfg.views:
        register_view(spark.read.parquet(paths["metric"]), cfg.views["metric"])
    return paths
