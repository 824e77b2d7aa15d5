"""Tables cut into parts, of which a merge rewrites those it touches.

A part is a folder named by the value of the part column, a function of the keys. New parts are
written aside as a whole; then a journal names them and each folder is swapped by renaming. A job
that fails while it writes leaves the table as it was, one that fails between two swaps is finished
from its journal by the next reader or writer that comes through here. One writer at a time; a
reader that lists the folder during the swaps may see some parts new and others old.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.operators.upsert import upsert

_JOURNAL, _STAGED, _OLD = "_swap", "_staged", "_old"
#: Folders that a read names one by one.
_NAMED = 16
# Fixed value: the folder of rows whose part is null.
_UNNAMED = "__HIVE_DEFAULT_PARTITION__"


class Files:
    """The few file operations that tables need, on whatever file system holds the table."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, root.rstrip("/")
        self._gateway, self._conf = spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))

    def move(self, name: str, to: str) -> None:
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(name), self._path(to)):
            raise OSError(f"could not rename {name} to {to} below {self.root}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        aside = f"{name}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(aside), True)
        out.write(bytearray(text.encode()))
        out.close()
        # Replaced in one step, so that a reader finds the text before or this one.
        options = self._jvm.org.apache.hadoop.fs.Options
        over = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = options.Rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        context.rename(self._fs.makeQualified(self._path(aside)), self._fs.makeQualified(self._path(name)), over)

    def read(self, name: str) -> str:
        source = self._fs.open(self._path(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


def finish_swap(spark: SparkSession, path: str) -> None:
    """Ends a swap that was cut off; nothing to do otherwise."""
    files = Files(spark, path)
    if not files.exists(_JOURNAL):
        return
    job = json.loads(files.read(_JOURNAL))
    staged, old = f"{_STAGED}-{job['id']}", f"{_OLD}-{job['id']}"
    for name in job["parts"]:
        fresh = files.exists(f"{staged}/{name}")
        # A part that is neither new nor gone was swapped before.
        if files.exists(name) and (fresh or name in job["emptied"]) and not files.exists(f"{old}/{name}"):
            files.move(name, f"{old}/{name}")
        if fresh:
            files.move(f"{staged}/{name}", name)
    files.remove(_JOURNAL)
    files.remove(staged)
    files.remove(old)


def _folder(spark: SparkSession, part: str, value) -> str:
    if value is None:
        return f"{part}={_UNNAMED}"
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{part}={escape(str(value))}"


def read_parts(spark: SparkSession, path: str, schema: T.StructType, part: str, values: list | None = None) -> DataFrame:
    """The table, or those parts of it, of which a few are named to Spark so that others are not even listed."""
    finish_swap(spark, path)
    files = Files(spark, path)
    wanted = files.names() if values is None else [_folder(spark, part, v) for v in values]
    found = [n for n in wanted if n.startswith(f"{part}=") and (values is None or files.exists(n))]
    if not found:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path)
    if len(found) <= _NAMED:
        return rows.parquet(*(f"{path}/{n}" for n in found)).select(schema.fieldNames())
    # Spark lists one folder faster than many; the filter names parts, so no file of another one is opened.
    rows = rows.parquet(path).select(schema.fieldNames())
    if values is None:
        return rows
    named = F.col(part).isin([v for v in values if v is not None])
    return rows.filter(named | F.col(part).isNull() if None in values else named)


def part_values(df: DataFrame, part: str) -> list:
    """Distinct parts of a frame, as many at most as the table has folders and the frame days to add."""
    return [r[0] for r in df.select(part).distinct().collect()]


def replace_parts(df: DataFrame, path: str, part: str, values: list) -> None:
    """The parts ``values`` become the rows of ``df``, which must have none of any other part.

    ``df`` may read the table: nothing of it is moved before the new parts are complete.
    """
    spark = df.sparkSession
    finish_swap(spark, path)
    files, job = Files(spark, path), uuid.uuid4().hex
    staged = f"{_STAGED}-{job}"
    # Few files for each part; adaptive execution splits a part of very many rows.
    df.hint("rebalance", part).write.partitionBy(part).parquet(f"{path}/{staged}")
    fresh = [n for n in files.names(staged) if n.startswith(f"{part}=")]
    named = [_folder(spark, part, v) for v in values]
    if stray := set(fresh) - set(named):
        files.remove(staged)
        raise ValueError(f"rows of other parts: {sorted(stray)[:3]}")
    files.write(_JOURNAL, json.dumps({"id": job, "parts": named, "emptied": sorted(set(named) - set(fresh))}))
    finish_swap(spark, path)


def merge_parts(spark: SparkSession, path: str, source: DataFrame, keys: list[str], columns: list[str], part: str,
                schema: T.StructType, **options) -> list:
    """Upserts ``source`` into the table at ``path`` and returns the parts that were rewritten.

    ``source`` has the part column, and one row for each key. Only parts that it has rows for are
    read and written; ``options`` are those of ``upsert``.
    """
    values = part_values(source, part)
    if values:
        existing = read_parts(spark, path, schema, part, values)
        carried = [c for c in schema.fieldNames() if c not in keys]
        updated = [*columns, *([part] if part not in columns else [])]
        assert set(updated) <= set(carried), "the part and all columns belong to the table"
        replace_parts(upsert(existing, source, keys, updated, **options), path, part, values)
    return values


def clear_leftovers(spark: SparkSession, path: str) -> list[str]:
    """Removes what jobs that failed have left beside the table; no writer may be running."""
    finish_swap(spark, path)
    files = Files(spark, path)
    gone = [n for n in files.names() if n.startswith((f"{_STAGED}-", f"{_OLD}-", f"{_JOURNAL}."))]
    for name in gone:
        files.remove(name)
    return gone


def set_current(spark: SparkSession, path: str, target: str) -> None:
    """Points the name ``path`` at a folder; readers see the folder before or this one."""
    files = Files(spark, path)
    files.write("CURRENT", json.dumps({"target": target}))


def current(spark: SparkSession, path: str) -> str | None:
    """The folder that ``path`` points at, if any."""
    files = Files(spark, path)
    return json.loads(files.read("CURRENT"))["target"] if files.exists("CURRENT") else None


def month_of(date: str):
    """The usual part of a daily table."""
    return F.date_format(date, "yyyy-MM")
