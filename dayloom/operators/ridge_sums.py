"""Sums of a ridge regression that are kept by batch and merged, so that a refit reads no rows.

A batch is summed about its own means (its reference): counts, sums and cross products of the
values that are present, sums for each category value, counts for each pair of values. Sums of
any batches move to a common reference by the usual shift of means, which adds exactly what the
rows would; so batches add up, and rows that go are a batch of negative sign.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.functions.numbers import finite
from dayloom.operators.ridge import DEFAULT_L2, entries, solve_cells
from dayloom.sources.tables import table_exists

_CELL = ["_kind", "_left", "_right"]


def _columns(width: int) -> dict[str, str]:
    """Names of a cell's numbers and how each is summed."""
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    return {
        "n": "rows",
        **{f"k{i}": "values present" for i in range(width)},
        **{f"s{i}": "sum about the reference" for i in range(width)},
        **{f"nb{i}_{j}": "rows with both" for i, j in pairs},
        **{f"b{i}_{j}": "sum of the first where both are present" for i, j in pairs},
        **{f"d{i}_{j}": "sum of the second where both are present" for i, j in pairs},
        **{f"a{i}_{j}": "cross products" for i, j in pairs},
    }


def ridge_sums(
    df: DataFrame,
    numeric: list[str],
    label: str,
    categorical: list[str] | None = None,
    by: list[str] | None = None,
    batch: list[str] | None = None,
    sign: int = 1,
) -> DataFrame:
    """Sums of the labelled rows: one row for each key, batch column, category value and pair of values.

    Everything is summed within tasks before the shuffle. ``c{i}`` is the reference, the mean of
    the key and batch.
    """
    by, batch, categorical = list(by or []), list(batch or []), list(categorical or [])
    names = [*numeric, label]
    width = range(len(names))
    keys = [*by, *batch]
    train = df.filter(finite(F.col(label).cast("double")).isNotNull()).select(
        *keys, *categorical, *[finite(F.col(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(names)]
    )
    # Any reference is right; a mean keeps digits. One per key and batch, from rows summed within tasks.
    means = train.groupBy(*keys).agg(*[F.coalesce(F.avg(f"_v{i}"), F.lit(0.0)).alias(f"c{i}") for i in width])
    centred = _join(train, means, keys).select(
        *keys, *categorical, *[f"c{i}" for i in width], *[(F.col(f"_v{i}") - F.col(f"c{i}")).alias(f"_x{i}") for i in width]
    )
    cells = centred.select("*", F.inline(entries(categorical)))
    whole = F.col("_kind") == ""
    x = [F.col(f"_x{i}") for i in width]
    both = lambda i, j: whole & x[i].isNotNull() & x[j].isNotNull()
    sums: dict[str, Column] = {"n": F.count(F.lit(1)).cast("double")}
    for i in width:
        sums[f"k{i}"] = F.count(x[i]).cast("double")
        sums[f"s{i}"] = F.sum(x[i])
        for j in range(i, len(names)):
            sums[f"nb{i}_{j}"] = F.count_if(both(i, j)).cast("double")
            sums[f"b{i}_{j}"] = F.sum(F.when(both(i, j), x[i]))
            sums[f"d{i}_{j}"] = F.sum(F.when(both(i, j), x[j]))
            sums[f"a{i}_{j}"] = F.sum(F.when(both(i, j), x[i] * x[j]))
    signed = [(F.lit(float(sign)) * F.coalesce(sums[c], F.lit(0.0))).alias(c) for c in _columns(len(names))]
    return cells.groupBy(*keys, *_CELL).agg(*[F.max(f"c{i}").alias(f"c{i}") for i in width], *signed)


def _join(rows: DataFrame, means: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        return rows.withColumn("_m", means.select(F.struct("*")).scalar()).select("*", "_m.*").drop("_m")
    renamed = means.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], *[c for c in means.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(keys)]
    condition = on[0]
    for clause in on[1:]:
        condition = condition & clause
    return rows.join(renamed, condition).drop(*[f"_k{n}" for n in range(len(keys))])


def merged_sums(sums: DataFrame, width: int, by: list[str]) -> DataFrame:
    """One set of sums per key, about the mean of all batches.

    Adds about c, with d = c - m, as the rows would about m: s + k d; and for products
    a + d_j b_i + d_i b_j + n d_i d_j over the rows that have both values.
    """
    span = range(width)
    spec = Window.partitionBy(*by)
    only = F.col("_kind") == ""
    mean = lambda i: F.try_divide(
        F.sum(F.when(only, F.col(f"k{i}") * F.col(f"c{i}") + F.col(f"s{i}"))).over(spec), F.sum(F.when(only, F.col(f"k{i}"))).over(spec))
    about = sums.withColumns({f"m{i}": F.coalesce(mean(i), F.lit(0.0)) for i in span}).withColumns(
        {f"g{i}": F.col(f"c{i}") - F.col(f"m{i}") for i in span})
    col = F.col
    moved = {"n": col("n")}
    for i in span:
        moved[f"k{i}"] = col(f"k{i}")
        moved[f"s{i}"] = col(f"s{i}") + col(f"k{i}") * col(f"g{i}")
        for j in range(i, width):
            p = f"{i}_{j}"
            moved[f"nb{p}"] = col(f"nb{p}")
            moved[f"b{p}"] = col(f"b{p}") + col(f"nb{p}") * col(f"g{i}")
            moved[f"d{p}"] = col(f"d{p}") + col(f"nb{p}") * col(f"g{j}")
            moved[f"a{p}"] = (col(f"a{p}") + col(f"g{j}") * col(f"b{p}") + col(f"g{i}") * col(f"d{p}")
                              + col(f"nb{p}") * col(f"g{i}") * col(f"g{j}"))
    return about.groupBy(*by, *_CELL).agg(
        *[F.max(f"m{i}").alias(f"c{i}") for i in span], *[F.sum(v).alias(c) for c, v in moved.items()])


def model_from_sums(
    sums: DataFrame,
    numeric: list[str],
    label: str,
    categorical: list[str] | None = None,
    l2: float = DEFAULT_L2,
    by: list[str] | None = None,
) -> DataFrame:
    """The model that ``fit_ridge`` makes of the rows, from their sums alone."""
    by, categorical = list(by or []), list(categorical or [])
    names = [*numeric, label]
    width = len(names)
    merged = merged_sums(sums, width, by).filter(F.col("n") > 0.5)
    cells = merged.select(
        *by, *_CELL, F.round("n").cast("bigint").alias("_n"), *[F.col(f"c{i}").alias(f"_m_{c}") for i, c in enumerate(names)],
        *[F.col(f"s{i}").alias(f"_s{i}") for i in range(width)],
        *[F.col(f"a{i}_{j}").alias(f"_p{i}_{j}") for i in range(width) for j in range(i, width)],
    )
    return solve_cells(cells, [sums.schema[k] for k in by], numeric, label, categorical, l2, by)


class RidgeState:
    """Sums in a folder, one sub-folder for each batch, counted once its mark is written."""

    def __init__(self, spark: SparkSession, folder: str, numeric: list[str], label: str,
                 categorical: list[str] | None = None, by: list[str] | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.numeric, self.label, self.categorical, self.by = list(numeric), label, list(categorical or []), list(by or [])

    def batches(self) -> list[int]:
        if not table_exists(self.spark, f"{self.folder}/marks"):
            return []
        marks = self.spark.read.schema("batch long").option("recursiveFileLookup", True).parquet(f"{self.folder}/marks")
        return sorted(r["batch"] for r in marks.distinct().collect())

    def apply(self, batch: int, added: DataFrame | None = None, removed: DataFrame | None = None) -> bool:
        """Sums the rows that came and those that went; False for a batch that is there already."""
        if batch in self.batches():
            return False
        sums = None
        for rows, sign in ((added, 1), (removed, -1)):
            if rows is not None:
                own = ridge_sums(rows, self.numeric, self.label, self.categorical, self.by, sign=sign)
                sums = own if sums is None else sums.unionByName(own)
        if sums is not None:
            sums.write.mode("overwrite").parquet(f"{self.folder}/sums/batch={batch}")
            marked = self.spark.range(batch, batch + 1, 1, 1).toDF("batch")
            marked.write.mode("overwrite").parquet(f"{self.folder}/marks/mark-{batch}")
        return sums is not None

    def sums(self) -> DataFrame:
        """Sums of all marked batches; one that was cut off is not among them."""
        paths = [f"{self.folder}/sums/batch={b}" for b in self.batches()]
        if not paths:
            raise ValueError("no batch has been applied")
        return self.spark.read.parquet(*paths)

    def model(self, l2: float = DEFAULT_L2) -> DataFrame:
        return model_from_sums(self.sums(), self.numeric, self.label, self.categorical, l2, self.by)

