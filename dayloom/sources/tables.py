"""Tables: curated, quarantine and marked writes, views and reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.operators.quality import to_quarantine

VALID_FLAG = "is_valid"


def write_curated(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Create or fully replace the table at ``path``, which ``df`` may read from.

    The new table is written aside, in a hidden folder next to it, and takes the name once it is
    complete; a write that fails leaves the old table as it was. A job that ends between the two
    renames leaves the old table under ``_<name>.old-...``, from which the next write puts it back.
    """
    fs, to_path = _file_system(df.sparkSession, path)
    target = to_path(path)
    parent, name, mark = target.getParent(), target.getName(), uuid.uuid4().hex
    fresh, old = to_path(parent, f"_{name}.new-{mark}"), to_path(parent, f"_{name}.old-{mark}")
    restore_table(df.sparkSession, path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(fresh.toString())
    except Exception:
        fs.delete(fresh, True)
        raise
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"{path} cannot be moved aside")
    if not fs.rename(fresh, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"the new table cannot be moved to {path}")
    if replaced:
        fs.delete(old, True)


def restore_table(spark: SparkSession, path: str) -> bool:
    """Puts back a table whose replacement was cut off between its two renames."""
    fs, to_path = _file_system(spark, path)
    target = to_path(path)
    if fs.exists(target) or not fs.exists(target.getParent()):
        return False
    left = [f.getPath() for f in fs.listStatus(target.getParent()) if f.getPath().getName().startswith(f"_{target.getName()}.old-")]
    return bool(left) and fs.rename(left[0], target)


def _file_system(spark: SparkSession, path: str):
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), to_path


def write_quarantine(df: DataFrame, path: str, errors: str = "errors") -> None:
    """Create or replace the quarantine table: every column as text, reasons joined."""
    write_curated(to_quarantine(df, errors=errors), path)


def write_marked(df: DataFrame, path: str, errors: str = "errors") -> None:
    """Both sides of a validated frame in one pass, split by partition folder.

    Filtering a frame twice scans its source twice; one write partitioned by the flag
    scans it once and lets each side be read alone through partition pruning.
    """
    write_curated(df.withColumn(VALID_FLAG, F.size(errors) == 0), path, [VALID_FLAG])


def read_marked(spark: SparkSession, path: str, valid: bool) -> DataFrame:
    return spark.read.parquet(path).filter(F.col(VALID_FLAG) == F.lit(valid)).drop(VALID_FLAG)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def create_table(spark: SparkSession, path: str, schema) -> None:
    """An empty table, so that appends have something to append to."""
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library has written and no longer needs."""
    fs, to_path = _file_system(spark, path)
    fs.delete(to_path(path), True)


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, to_path = _file_system(spark, path)
    return fs.exists(to_path(path))
