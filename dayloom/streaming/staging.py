"""A staging table of micro-batch folders that stays listable, and what each batch brought.

Each batch has a folder of its own, complete once Spark's mark is in it, and a row of figures: how many
rows were accepted, the least and the greatest stamp. Compaction writes the rows of complete batches, all but the newest, into one folder
and then replaces the list that readers follow, in one step; the running query only ever adds folders with
greater numbers. Folders that are no longer listed stay until ``vacuum``, for readers that began before.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.sources.parts import Files
from dayloom.sources.tables import VALID_FLAG

_LIST, _FIGURES, _MERGED = "_compacted.json", "_figures", "_merged"
FIGURES = "batch_id long, rows long, least timestamp, newest timestamp"


@dataclass
class Staging:
    """``schema`` holds the columns of both sides: rows that were accepted and messages that were not."""

    spark: SparkSession
    path: str
    schema: T.StructType
    stamp: str = "ingestion_time"

    def __post_init__(self):
        self.path = self.path.rstrip("/")
        self._files = Files(self.spark, self.path)

    # Writing

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Writes a batch, split by the flag; one that is run again replaces its folder and its figures."""
        if batch_id <= self._upto():
            # It was complete, or it would not have been compacted.
            return
        folder = f"{self.path}/batch_id={batch_id}"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(VALID_FLAG).parquet(folder)
        self._note(self._folders([batch_id]).filter(VALID_FLAG), batch_id)

    def _note(self, accepted: DataFrame, batch_id: int, name: str | None = None) -> None:
        figures = accepted.agg(F.count(F.lit(1)).alias("rows"), F.min(self.stamp).alias("least"), F.max(self.stamp).alias("newest"))
        rows = figures.select(F.lit(batch_id).cast("long").alias("batch_id"), "rows", "least", "newest")
        rows.write.mode("overwrite").parquet(f"{self.path}/{_FIGURES}/{name or f'to={batch_id}'}")

    # Reading

    def batches(self) -> list[int]:
        """Complete batches that have a folder."""
        numbers = [int(n.split("=")[1]) for n in self._files.names() if n.startswith("batch_id=")]
        return sorted(n for n in numbers if self._files.exists(f"batch_id={n}/_SUCCESS"))

    def _merged(self) -> list[dict]:
        """Compacted ranges in order: from, to, folder."""
        return json.loads(self._files.read(_LIST)) if self._files.exists(_LIST) else []

    def _upto(self) -> int:
        return max((m["to"] for m in self._merged()), default=-1)

    def _all_fields(self) -> T.StructType:
        return T.StructType([*self.schema, T.StructField("batch_id", T.LongType()), T.StructField(VALID_FLAG, T.BooleanType())])

    def _folders(self, batches: list[int]) -> DataFrame:
        rows = self.spark.read.schema(self._all_fields()).option("basePath", self.path)
        return rows.parquet(*(f"{self.path}/batch_id={b}" for b in batches)) if batches else self.spark.createDataFrame([], self._all_fields())

    def read(self, valid: bool = True, batches: list[int] | None = None) -> DataFrame:
        """Rows of one side, from merged folders and from those of later batches."""
        merged = self._merged()
        upto = max((m["to"] for m in merged), default=-1)
        out = self._folders([b for b in self.batches() if b > upto and (batches is None or b in batches)])
        names = self._all_fields().fieldNames()
        for m in merged:
            if batches is None or any(m["from"] <= b <= m["to"] for b in batches):
                rows = self.spark.read.schema(self._all_fields()).parquet(f"{self.path}/{m['folder']}")
                out = out.select(names).unionByName(rows.select(names))
        if batches is not None:
            out = out.filter(F.col("batch_id").isin(batches))
        return out.filter(F.col(VALID_FLAG) == F.lit(valid)).select(self.schema.fieldNames())

    # Compaction

    def compact(self, least: int = 2) -> int:
        """Merges complete batches but the newest; returns how many, none if there are fewer than ``least``."""
        merged = self._merged()
        upto = max((m["to"] for m in merged), default=-1)
        ready = [b for b in self.batches() if b > upto][:-1]
        if len(ready) < least:
            return 0
        folder = f"{_MERGED}/{ready[0]}-{ready[-1]}-{uuid.uuid4().hex[:8]}"
        self._folders(ready).hint("rebalance", VALID_FLAG).write.partitionBy(VALID_FLAG).parquet(f"{self.path}/{folder}")
        merged_rows = self.spark.read.schema(self._all_fields()).parquet(f"{self.path}/{folder}")
        self._note(merged_rows.filter(VALID_FLAG), ready[-1], f"range={ready[0]}-{ready[-1]}")
        self._files.write(_LIST, json.dumps([*merged, {"from": ready[0], "to": ready[-1], "folder": folder}]))
        return len(ready)

    def vacuum(self) -> int:
        """Removes folders and figures of merged batches; readers that began before the compaction must be done."""
        merged = self._merged()
        listed, upto = {m["folder"] for m in merged}, max((m["to"] for m in merged), default=-1)
        gone = [n for n in self._files.names() if n.startswith("batch_id=") and int(n.split("=")[1]) <= upto]
        gone += [f"{_MERGED}/{n}" for n in self._files.names(_MERGED) if f"{_MERGED}/{n}" not in listed]
        gone += [f"{_FIGURES}/{n}" for n in self._files.names(_FIGURES) if n.startswith("to=") and int(n.split("=")[1]) <= upto]
        for name in gone:
            self._files.remove(name)
        return len(gone)

    # Freshness

    def figures(self) -> DataFrame:
        """One row for each merged range and each later batch: batch_id (the last one), rows, least, newest."""
        merged = self._merged()
        upto = max((m["to"] for m in merged), default=-1)
        have = self._files.names(_FIGURES)
        wanted = [f"range={m['from']}-{m['to']}" for m in merged] + [f"to={b}" for b in self.batches() if b > upto]
        paths = [f"{self.path}/{_FIGURES}/{n}" for n in wanted if n in have]
        return self.spark.read.schema(FIGURES).parquet(*paths) if paths else self.spark.createDataFrame([], FIGURES)

    def _without_figures(self) -> list[int]:
        have = {r["batch_id"] for r in self.figures().select("batch_id").collect()}
        upto = self._upto()
        return [b for b in self.batches() if b > upto and b not in have]

    def newest(self) -> DataFrame:
        """One row, ``baseline``: the newest stamp that was accepted. Only batches without figures are read."""
        tops = self.figures().select("newest")
        missing = self._without_figures()
        if missing:
            tops = tops.unionByName(self.read(True, missing).select(F.col(self.stamp).alias("newest")))
        return tops.agg(F.max("newest").alias("baseline"))

    def new_rows(self, baseline) -> DataFrame:
        """One row, ``new_rows``: accepted rows strictly newer than ``baseline``; all of them where it is null.

        Figures answer for batches on one side of the baseline. Batches that lie across it, and
        those without figures, are read; a batch's rows usually carry stamps of one short time.
        """
        figures = self.figures()
        bound = F.lit(baseline).cast("timestamp")
        after = F.lit(baseline is None) | F.coalesce(F.col("least") > bound, F.lit(False))
        across = ~after & F.coalesce(F.col("newest") > bound, F.lit(False))
        counted = figures.agg(F.coalesce(F.sum(F.when(after, F.col("rows"))), F.lit(0)).alias("new_rows"))
        straddling = [r["batch_id"] for r in figures.filter(across).select("batch_id").collect()]
        ranges = {m["to"]: range(m["from"], m["to"] + 1) for m in self._merged()}
        scanned = [b for last in straddling for b in ranges.get(last, [last])] + self._without_figures()
        if not scanned:
            return counted
        newer: Column = F.lit(True) if baseline is None else F.col(self.stamp) > bound
        rows = self.read(True, scanned).filter(newer).agg(F.count(F.lit(1)).alias("new_rows"))
        return counted.unionByName(rows).agg(F.sum("new_rows").alias("new_rows"))
