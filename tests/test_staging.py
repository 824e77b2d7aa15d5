"""Compaction of micro-batch folders, and freshness from figures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import values
from dayloom.sources.tables import VALID_FLAG
from dayloom.streaming.staging import Staging

SCHEMA = T.StructType([T.StructField("v", T.LongType()), T.StructField("ingestion_time", T.TimestampType()), T.StructField("errors", T.StringType())])
BEGIN = dt.datetime(2024, 1, 1)


def batch(spark, number, rows=4):
    """Rows of one minute each, one of them rejected; every tenth batch has rejected rows only."""
    stamp = lambda i: BEGIN + dt.timedelta(minutes=number, seconds=i)
    told = [(number * 100 + i, stamp(i), None, number % 10 != 9) if i and number % 10 != 9 else (number * 100 + i, None, "bad", False) for i in range(rows)]
    return spark.createDataFrame(told, T.StructType([*SCHEMA, T.StructField(VALID_FLAG, T.BooleanType())]))


def expected(numbers, valid=True):
    rows = [(n * 100 + i) for n in numbers for i in range(4) if (i > 0 and n % 10 != 9) == valid]
    return sorted((r,) for r in rows)


def told(staging, valid=True):
    return sorted(tuple(r) for r in staging.read(valid).select("v").collect())


def folders(path):
    return [n for n in os.listdir(path) if n.startswith("batch_id=")]


def files(path):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(path) for n in names)


def test_many_batches_leave_a_handful_of_files(spark, tmp_path):
    staging = Staging(spark, str(tmp_path), SCHEMA)
    for number in range(24):
        staging.write_batch(batch(spark, number).coalesce(1), number)
        if number in (9, 17):
            assert staging.compact() == {9: 9, 17: 8}[number]
    before = staging.read(True)
    assert staging.compact() == 6 and staging.compact() == 0
    # A reader that began before still finds its folders, until they are removed.
    assert before.count() == len(expected(range(24)))
    assert staging.vacuum() > 0 and folders(tmp_path) == ["batch_id=23"] and files(tmp_path) < 20
    assert told(staging) == expected(range(24)) and told(staging, False) == expected(range(24), False)
    # The running query goes on, and repeats a batch after a lost answer.
    for number in (23, 24):
        staging.write_batch(batch(spark, number), number)
    staging.write_batch(batch(spark, 5), 5)
    assert told(staging) == expected(range(25)) and sorted(folders(tmp_path)) == ["batch_id=23", "batch_id=24"]


def test_a_batch_or_compaction_that_was_cut_off_is_not_read(spark, tmp_path):
    staging = Staging(spark, str(tmp_path), SCHEMA)
    for number in range(4):
        staging.write_batch(batch(spark, number), number)
    os.remove(tmp_path / "batch_id=3" / "_SUCCESS")
    assert told(staging) == expected(range(3))
    real = staging._files.write
    staging._files.write = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        staging.compact()
    staging._files.write = real
    assert told(staging) == expected(range(3))
    assert staging.compact() == 2 and staging.vacuum() > 0 and told(staging) == expected(range(3))
    staging.write_batch(batch(spark, 3), 3)
    assert told(staging) == expected(range(4))


@pytest.mark.parametrize("compacted", [False, True])
def test_freshness_from_figures(spark, tmp_path, compacted):
    staging = Staging(spark, str(tmp_path), SCHEMA)
    assert staging.newest().first()["baseline"] is None and staging.new_rows(None).first()["new_rows"] == 0
    for number in range(12):
        staging.write_batch(batch(spark, number), number)
    if compacted:
        staging.compact()
        staging.vacuum()
    everything = staging.read(True)
    top = everything.agg(F.max("ingestion_time")).first()[0]
    assert staging.newest().first()["baseline"] == top
    for baseline in (None, BEGIN, BEGIN + dt.timedelta(minutes=4, seconds=2), BEGIN + dt.timedelta(minutes=8), top, top + dt.timedelta(1)):
        want = everything.count() if baseline is None else everything.filter(F.col("ingestion_time") > F.lit(baseline)).count()
        assert staging.new_rows(baseline).first()["new_rows"] == want


def test_no_staging_rows_are_read_where_figures_answer(spark, tmp_path):
    staging = Staging(spark, str(tmp_path), SCHEMA)
    for number in range(3):
        staging.write_batch(batch(spark, number), number)
    for folder, _, names in os.walk(tmp_path):
        for name in names:
            if "batch_id=" in folder and name.endswith(".parquet"):
                open(os.path.join(folder, name), "w").close()
    assert staging.newest().first()["baseline"] == BEGIN + dt.timedelta(minutes=2, seconds=3)
    assert staging.new_rows(BEGIN + dt.timedelta(minutes=1)).first()["new_rows"] == 6


def test_batches_without_figures_are_scanned(spark, tmp_path):
    staging = Staging(spark, str(tmp_path), SCHEMA)
    for number in range(3):
        staging.write_batch(batch(spark, number), number)
    staging._files.remove("_figures/to=1")
    assert staging.new_rows(BEGIN).first()["new_rows"] == 9 and staging.new_rows(None).first()["new_rows"] == 9
    assert values(staging.newest())[0][0] == BEGIN + dt.timedelta(minutes=2, seconds=3)
