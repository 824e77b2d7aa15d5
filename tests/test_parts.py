"""Part tables: merges by part, swaps that fail in the middle, pointers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import values
from dayloom.operators.upsert import upsert
from dayloom.sources import parts

SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("v", T.DoubleType()), T.StructField("other", T.StringType()),
                       T.StructField("month", T.StringType())])
FIRST = dt.date(2010, 1, 1)


def rows(spark, days, value, step=1):
    base = spark.range(0, days, step).select(F.date_add(F.lit(FIRST), F.col("id").cast("int")).alias("date"))
    return base.select("date", F.lit(value).cast("double").alias("v"), F.lit("x").alias("other")).withColumn("month", parts.month_of("date"))


def table(spark, path, days=3653):
    df = rows(spark, days, 1.0).select(SCHEMA.fieldNames())
    parts.replace_parts(df, path, "month", parts.part_values(df, "month"))
    return path


def stamps(path):
    return {f"{d}/{f}": os.stat(os.path.join(path, d, f)).st_mtime_ns
            for d in os.listdir(path) if d.startswith("month=") for f in os.listdir(os.path.join(path, d))}


def test_a_merge_rewrites_the_parts_it_touches(spark, tmp_path):
    path = table(spark, str(tmp_path / "t"))
    before = stamps(path)
    source = rows(spark, 3653, 7.0, step=10).filter("month like '2014-%'").unionByName(
        spark.createDataFrame([(dt.date(2031, 5, 1), None, "y", "2031-05")], SCHEMA))
    source = source.persist()
    expected = values(upsert(parts.read_parts(spark, path, SCHEMA, "month"), source, ["date"], ["v", "month"]))
    touched = parts.merge_parts(spark, path, source, ["date"], ["v"], "month", SCHEMA)
    after = stamps(path)
    assert len(touched) == 13 and {k.split("/")[0][6:] for k in set(before) ^ set(after)} == set(touched)
    assert all(after[k] == before[k] for k in set(before) & set(after))
    assert values(parts.read_parts(spark, path, SCHEMA, "month")) == expected
    assert os.listdir(path).count("_swap") == 0 and parts.clear_leftovers(spark, path) == []


def test_parts_that_are_not_touched_are_not_read(spark, tmp_path):
    path = table(spark, str(tmp_path / "t"), 400)
    for name in os.listdir(path):
        if name.startswith("month=") and name != "month=2010-03":
            for f in os.listdir(os.path.join(path, name)):
                open(os.path.join(path, name, f), "w").close()
    parts.merge_parts(spark, path, rows(spark, 80, 5.0).filter("month = '2010-03'"), ["date"], ["v"], "month", SCHEMA)
    got = parts.read_parts(spark, path, SCHEMA, "month", ["2010-03"])
    assert got.count() == 31 and got.filter("v = 5").count() == 21


def test_a_job_that_fails_leaves_the_table_whole(spark, tmp_path):
    path = table(spark, str(tmp_path / "t"), 400)
    before = stamps(path)
    bad = rows(spark, 400, 2.0).withColumn("v", F.when(F.col("date") == F.lit(dt.date(2010, 12, 3)), F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        parts.merge_parts(spark, path, bad, ["date"], ["v"], "month", SCHEMA)
    assert stamps(path) == before and parts.read_parts(spark, path, SCHEMA, "month").filter("v = 1").count() == 400
    parts.clear_leftovers(spark, path)
    assert all(n.startswith("month=") for n in os.listdir(path))
    with pytest.raises(ValueError):
        parts.replace_parts(rows(spark, 60, 2.0), path, "month", ["2010-01"])
    assert stamps(path) == before


@pytest.mark.parametrize("moves", range(0, 7))
def test_a_swap_that_was_cut_off_is_finished(spark, tmp_path, monkeypatch, moves):
    path = table(spark, str(tmp_path / "t"), 120)
    source = rows(spark, 120, 3.0).filter("month in ('2010-01', '2010-02', '2010-04')").select(SCHEMA.fieldNames())
    real, left = parts.Files.move, [moves]

    def cut(self, name, to):
        if left[0] == 0:
            raise RuntimeError("cut off")
        left[0] -= 1
        real(self, name, to)

    monkeypatch.setattr(parts.Files, "move", cut)
    if moves < 6:
        with pytest.raises(RuntimeError):
            parts.replace_parts(source, path, "month", ["2010-01", "2010-02", "2010-04"])
    else:
        parts.replace_parts(source, path, "month", ["2010-01", "2010-02", "2010-04"])
    monkeypatch.setattr(parts.Files, "move", real)
    got = parts.read_parts(spark, path, SCHEMA, "month")
    assert got.count() == 120 and got.filter("v = 3").count() == 89 and got.filter("v = 1").count() == 31
    assert sorted(n for n in os.listdir(path) if not n.startswith(("month=", "."))) == []


def test_parts_become_empty_and_null_parts_are_parts(spark, tmp_path):
    path = table(spark, str(tmp_path / "t"), 60)
    parts.replace_parts(rows(spark, 60, 1.0).filter("false").select(SCHEMA.fieldNames()), path, "month", ["2010-02"])
    assert parts.read_parts(spark, path, SCHEMA, "month").count() == 32
    odd = spark.createDataFrame([(None, 1.0, "a", None), (FIRST, 9.0, "b", "2010-01")], SCHEMA)
    assert set(parts.merge_parts(spark, path, odd, ["date"], ["v"], "month", SCHEMA)) == {None, "2010-01"}
    got = parts.read_parts(spark, path, SCHEMA, "month")
    assert got.count() == 33 and got.filter("month is null").count() == 1 and got.filter("v = 9").first()["other"] == "x"
    assert parts.merge_parts(spark, path, odd.limit(0), ["date"], ["v"], "month", SCHEMA) == []
    assert parts.read_parts(spark, str(tmp_path / "none"), SCHEMA, "month").count() == 0


def test_a_pointer_names_the_last_folder(spark, tmp_path):
    at = str(tmp_path / "p")
    assert parts.current(spark, at) is None
    for target in ("one", "two"):
        parts.set_current(spark, at, target)
        assert parts.current(spark, at) == target
    assert [n for n in os.listdir(at) if not n.startswith(".")] == ["CURRENT"]
