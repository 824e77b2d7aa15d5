"""Replacement of whole tables."""

import os

import pytest
from pyspark.sql import functions as F

from dayloom.sources.tables import write_curated
from support import values


def left_in(folder):
    return sorted(n for n in os.listdir(folder) if not n.endswith(".crc"))


def test_replaces_and_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_curated(spark.range(5), path)
    write_curated(spark.read.parquet(path).where("id > 2"), path)
    assert values(spark.read.parquet(path)) == [(3,), (4,)] and left_in(tmp_path) == ["t"]
    write_curated(spark.range(4).withColumn("p", F.col("id") % 2), path, ["p"])
    assert values(spark.read.parquet(path), "id", "p") == [(0, 0), (1, 1), (2, 0), (3, 1)]
    write_curated(spark.range(0), path)
    assert spark.read.schema("id long").parquet(path).count() == 0


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_curated(spark.range(3), path)
    broken = spark.range(3).select(F.when(F.col("id") == 1, F.raise_error(F.lit("stop"))).otherwise("x").alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_curated(broken, path)
    assert values(spark.read.parquet(path)) == [(0,), (1,), (2,)] and left_in(tmp_path) == ["t"]


def test_cut_off_replacement_is_put_back(spark, tmp_path):
    path = str(tmp_path / "t")
    write_curated(spark.range(3), path)
    os.rename(path, tmp_path / "_t.old-1")
    broken = spark.range(1).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_curated(broken, path)
    assert spark.read.parquet(path).count() == 3 and left_in(tmp_path) == ["t"]
