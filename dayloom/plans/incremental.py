"""The daily build kept up to date: arrivals rewrite only the months they reach.

Curated, joined and feature tables are cut into months. A batch of arrivals changes values of some
days; each is carried forward to the day before its next observation, and seen by windows 28 days on
and 40 days back. Months touched by these intervals are computed again, from their own rows
and from the joined values of the day before each stretch; all others stay as they are. The regression keeps
sums by month, so that a refit reads sums. Forecast, backtest and metric depend on the weights,
hence on everything, and are written anew into a folder of their own; one small pointer names the last complete set.

A batch first writes down what it is about to change. One that was cut off is applied again, and
ends in the same tables; another batch has to wait for it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.operators.dedup import any_value_by_key, latest_per_key
from dayloom.operators.dirty import (
    changed_values,
    fill_reach,
    month_span,
    months_between,
    months_of,
    observed_points,
    runs,
    widened,
)
from dayloom.operators.evaluate import backtest, forecast, mape, score_history
from dayloom.operators.features import AVERAGE_ROWS, HORIZON, LAGS, feature_matrix
from dayloom.operators.ridge import DEFAULT_L2
from dayloom.operators.ridge_sums import model_from_sums, ridge_sums
from dayloom.operators.spine import repeat_until_next
from dayloom.schemas import CALENDAR_START
from dayloom.session import scratch_path
from dayloom.sources.parts import current, merge_parts, month_of, part_values, read_parts, replace_parts, set_current
from dayloom.sources.tables import table_exists, write_curated

MONTH, RUN = "month", "_run"
OUTPUTS = ("model", "forecast", "backtest", "metric")


@dataclass
class IncrementalDaily:
    """``feeds`` names each feed's value columns, all of them numbers."""

    spark: SparkSession
    folder: str
    feeds: dict[str, tuple[str, ...]]
    target: str
    averaged: dict[str, str]
    by: tuple[T.StructField, ...] = ()
    start: dt.date = CALENDAR_START
    horizon: int = HORIZON
    l2: float = DEFAULT_L2
    categorical: tuple[str, ...] = ("dow", "mon")
    order: tuple[str, ...] = ("ingestion_time",)
    keep_existing_on_null: bool = False
    report: dict = field(default_factory=dict)

    def __post_init__(self):
        self.keys = [k.name for k in self.by]
        self.names = [c for columns in self.feeds.values() for c in columns]
        self.label = f"target_{self.horizon}"

    # Tables

    def _schema(self, columns: list[str], kind=T.DoubleType()) -> T.StructType:
        day = T.StructField("date", T.DateType())
        return T.StructType([*self.by, day, *[T.StructField(c, kind) for c in columns], T.StructField(MONTH, T.StringType())])

    def _observed_schema(self) -> T.StructType:
        return T.StructType([*self.by, T.StructField("column", T.StringType()), T.StructField("date", T.DateType()),
                             T.StructField(MONTH, T.StringType())])

    def curated(self, feed: str, months: list[str] | None = None) -> DataFrame:
        return read_parts(self.spark, f"{self.folder}/curated/{feed}", self._schema(list(self.feeds[feed])), MONTH, months)

    def joined(self, months: list[str] | None = None) -> DataFrame:
        return read_parts(self.spark, f"{self.folder}/joined", self._schema(self.names), MONTH, months)

    def features(self, months: list[str] | None = None) -> DataFrame:
        return read_parts(self.spark, f"{self.folder}/features", self._feature_schema(), MONTH, months)

    def _feature_schema(self) -> T.StructType:
        if not hasattr(self, "_features"):
            wide = self._windows(self.spark.createDataFrame([], self._schema(self.names)).withColumn(RUN, F.lit(0)))
            self._features = wide.drop(RUN).withColumn(MONTH, F.lit("")).schema
        return T.StructType([T.StructField(f.name, f.dataType) for f in self._features])

    def output(self, name: str) -> DataFrame | None:
        """A model table of the last batch that could be fitted; None before the first."""
        at = current(self.spark, f"{self.folder}/outputs")
        return None if at is None else self.spark.read.parquet(f"{at}/{name}")

    def _marks(self) -> dict[int, dt.date]:
        path = f"{self.folder}/marks"
        if not table_exists(self.spark, path):
            return {}
        marks = self.spark.read.schema("batch long, hi date").option("recursiveFileLookup", True).parquet(path)
        return {r["batch"]: r["hi"] for r in marks.collect()}

    # One batch

    def apply(self, batch: int, arrivals: dict[str, DataFrame]) -> bool:
        """Merges arrivals (keys, date, columns, order) of some feeds; False if the batch is in already.

        ``report`` then tells the months of each table that were written.
        """
        done = self._marks()
        if batch in done:
            return False
        pending = current(self.spark, f"{self.folder}/pending")
        if pending is not None and pending != f"batch={batch}" and int(pending.split("=")[1]) not in done:
            raise ValueError(f"{pending} was cut off and has to be applied again first")
        set_current(self.spark, f"{self.folder}/pending", f"batch={batch}")
        self.report = {"curated": {}}
        before = max((d for d in done.values() if d is not None), default=None)
        changes = self._merge(batch, arrivals)
        newest = changes.agg(F.max("date")).first()[0]
        hi = max((d for d in (before, newest) if d is not None), default=None)
        if hi is not None and hi >= self.start:
            intervals = self._reach(changes, before, hi)
            self._join_days(intervals, hi)
            months = self._build_features(intervals, hi)
            self._fit(batch, months)
        write_curated(self.spark.createDataFrame([(batch, hi)], "batch long, hi date"), f"{self.folder}/marks/batch={batch}")
        return True

    def _merge(self, batch: int, arrivals: dict[str, DataFrame]) -> DataFrame:
        """Merges each feed and returns what changed: (keys, column, date)."""
        schema = T.StructType(self._observed_schema()[:-1])
        found = self.spark.createDataFrame([], schema)
        for feed, columns in self.feeds.items():
            if feed not in arrivals:
                continue
            keys = [*self.keys, "date"]
            path, noted = f"{self.folder}/curated/{feed}", f"{self.folder}/changes/batch={batch}/{feed}"
            newest = latest_per_key(arrivals[feed], keys, list(self.order)).select(*keys, *columns)
            kept = scratch_path(self.spark, f"newest-{feed}")
            write_curated(newest.filter(F.col("date").isNotNull()).withColumn(MONTH, month_of("date")), kept)
            newest = self.spark.read.parquet(kept)
            months = part_values(newest, MONTH)
            # What changes is written down before anything does, and not again when the batch is repeated.
            if not table_exists(self.spark, f"{noted}/_SUCCESS"):
                old = self.curated(feed, months)
                write_curated(changed_values(old, newest, keys, "date", list(columns), self.keep_existing_on_null), noted)
            noted_rows = self.spark.read.schema(schema).parquet(noted)
            merge_parts(self.spark, path, newest, keys, list(columns), MONTH, self._schema(list(columns)),
                        keep_existing_on_null=self.keep_existing_on_null)
            if months:
                points = observed_points(self.curated(feed, months), self.keys, "date", list(columns), [MONTH])
                first = points.groupBy(*self.keys, "column", MONTH).agg(F.min("date").alias("date"))
                replace_parts(first.select(self._observed_schema().fieldNames()), f"{self.folder}/observed/{feed}", MONTH, months)
            self.report["curated"][feed] = sorted(months)
            found = found.unionByName(noted_rows)
        return found.filter(F.col("date") >= F.lit(self.start))

    def _reach(self, changes: DataFrame, before: dt.date | None, hi: dt.date) -> DataFrame:
        """Intervals of joined days that change. The next observation after a change is in its own month or the first of a later one."""
        points = self.spark.createDataFrame([], T.StructType(self._observed_schema()[:-1]))
        months = part_values(changes.withColumn(MONTH, month_of("date")), MONTH)
        for feed, columns in self.feeds.items():
            inside = observed_points(self.curated(feed, months), self.keys, "date", list(columns))
            firsts = read_parts(self.spark, f"{self.folder}/observed/{feed}", self._observed_schema(), MONTH)
            points = points.unionByName(inside.select(points.columns)).unionByName(firsts.select(points.columns))
        intervals = fill_reach(changes, points.filter(F.col("date") >= F.lit(self.start)), self.keys, "date", hi).select("lo", "hi")
        whole = self.spark.createDataFrame([(self.start, hi)], "lo date, hi date")
        if before is None or before < self.start:
            return whole
        if self.keys:
            # A key that is new has every day from the first one on.
            known = self.joined([before.strftime("%Y-%m")]).filter(F.col("date") == F.lit(before)).select(*self.keys)
            if not changes.select(*self.keys).distinct().exceptAll(known).isEmpty():
                return whole
        if before < hi:
            grown = self.spark.createDataFrame([(before + dt.timedelta(days=1), hi)], "lo date, hi date")
            intervals = intervals.unionByName(grown)
        return intervals

    def _runs(self, stretches: list[list[str]], hi: dt.date) -> DataFrame:
        """One row for each month of each stretch: its number and its first and last day."""
        rows = [(n, month, max(self.start, month_span(some[0])[0]), min(hi, month_span(some[-1])[1]))
                for n, some in enumerate(stretches) for month in some]
        return self.spark.createDataFrame(rows, f"{RUN} int, {MONTH} string, _lo date, _hi date")

    def _join_days(self, intervals: DataFrame, hi: dt.date) -> None:
        months = months_of(intervals, self.start, hi)
        self.report["joined"] = months
        if not months:
            return
        stretches = runs(months)
        calendar = self._runs(stretches, hi)
        stacked = None
        for feed, columns in self.feeds.items():
            part = self.curated(feed, months).filter(F.col("date").between(F.lit(self.start), F.lit(hi)))
            # The calendar has a row for each month: a proven bound for the broadcast.
            part = part.join(F.broadcast(calendar.select(RUN, MONTH)), MONTH).select(*self.keys, RUN, "date", *columns)
            stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
        opens = {month_span(some[0])[0] - dt.timedelta(days=1): n for n, some in enumerate(stretches)}
        eves = [d for d in opens if d >= self.start]
        if eves:
            carried = self.joined([d.strftime("%Y-%m") for d in eves]).filter(F.col("date").isin(eves))
            number = F.create_map(*[F.lit(x) for d in eves for x in (d, opens[d])])
            stacked = stacked.unionByName(carried.select(*self.keys, number[F.col("date")].alias(RUN), "date", *self.names))
        if not self.keys and self.start.strftime("%Y-%m") == months[0]:
            # A calendar without a key has its days also before the first observation.
            none = [F.lit(None).cast("double").alias(c) for c in self.names]
            stacked = stacked.unionByName(self.spark.range(1).select(F.lit(0).alias(RUN), F.lit(self.start).alias("date"), *none))
        observed = any_value_by_key(stacked, [*self.keys, RUN, "date"], self.names)
        spans = F.broadcast(calendar.select(RUN, "_lo", "_hi").distinct())
        dense = repeat_until_next(observed.join(spans, RUN), "date", self.names, [*self.keys, RUN], F.col("_lo"), F.col("_hi"))
        rows = dense.withColumn(MONTH, month_of("date")).filter(F.col(MONTH).isin(months))
        replace_parts(rows.select(self._schema(self.names).fieldNames()), f"{self.folder}/joined", MONTH, months)

    def _windows(self, rows: DataFrame) -> DataFrame:
        return feature_matrix(rows, self.target, self.averaged, by=[*self.keys, RUN], horizon=self.horizon)

    def _build_features(self, intervals: DataFrame, hi: dt.date) -> list[str]:
        back, ahead = max(*LAGS, AVERAGE_ROWS - 1), self.horizon
        months = months_of(widened(intervals, back, ahead), self.start, hi)
        self.report["features"] = months
        if not months:
            return months
        around: list[str] = []
        for some in runs(months):
            lo, last = month_span(some[0])[0] - dt.timedelta(days=back), month_span(some[-1])[1] + dt.timedelta(days=ahead)
            around += months_between(max(lo, self.start), min(last, hi))
        stretches = runs(around)
        rows = self.joined(sorted(set(around))).join(F.broadcast(self._runs(stretches, hi).select(RUN, MONTH)), MONTH)
        wide = self._windows(rows).withColumn(MONTH, month_of("date")).filter(F.col(MONTH).isin(months))
        replace_parts(wide.select(self._feature_schema().fieldNames()), f"{self.folder}/features", MONTH, months)
        return months

    def _numeric(self) -> list[str]:
        fixed = {*self.keys, "date", MONTH, self.label, *self.categorical}
        return [c for c in self._feature_schema().fieldNames() if c not in fixed]

    def _fit(self, batch: int, months: list[str]) -> None:
        numeric, categorical, by = self._numeric(), list(self.categorical), self.keys
        own = ridge_sums(self.features(months), numeric, self.label, categorical, by, [MONTH])
        schema = T.StructType([*[f for f in own.schema if f.name != MONTH], T.StructField(MONTH, T.StringType())])
        if months:
            replace_parts(own.select(schema.fieldNames()), f"{self.folder}/sums", MONTH, months)
        sums = read_parts(self.spark, f"{self.folder}/sums", schema, MONTH)
        if sums.isEmpty():
            # No label yet: what an earlier batch has written stays in use.
            return
        at = f"{self.folder}/outputs/batch={batch}"
        write_curated(model_from_sums(sums, numeric, self.label, categorical, self.l2, by), f"{at}/model")
        model, features = self.spark.read.parquet(f"{at}/model"), self.features()
        write_curated(forecast(features, model, numeric, categorical, self.horizon, by=by), f"{at}/forecast")
        scored = score_history(features, model, numeric, categorical, self.horizon, by=by)
        truth = self.joined().withColumnRenamed(self.target, "y")
        write_curated(backtest(scored, truth, by=by), f"{at}/backtest")
        history = self.spark.read.parquet(f"{at}/backtest")
        write_curated(mape(history, "actual", f"yhat_{self.horizon}", by, f"mape_{self.horizon}d"), f"{at}/metric")
        set_current(self.spark, f"{self.folder}/outputs", at)
