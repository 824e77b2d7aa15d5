"""Ridge regression from sums that Spark computes, one model or one per key.

Minimises the squared error plus l2 times the squared weights; the intercept is not
penalised, a missing number counts as its mean, and text columns become one indicator per
value (a null has none).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dayloom.functions.numbers import finite
from dayloom.operators.skew import salted_join

DEFAULT_L2 = 1.0
_N, _KIND, _LEFT, _RIGHT, _ALL = "_n", "_kind", "_left", "_right", ""


def _pairs(categorical: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(categorical) for b in categorical[i + 1 :]]


def _pair_name(a: str, b: str) -> str:
    return f"{a}\n{b}"


def entries(categorical: list[str]) -> Column:
    """What a row is summed into: the key, each of its category values, each pair of them."""
    def entry(kind: str, left: Column, right: Column) -> Column:
        return F.struct(F.lit(kind).alias(_KIND), left.cast("string").alias(_LEFT), right.cast("string").alias(_RIGHT))

    none = F.lit(None)
    found = [entry(_ALL, none, none)]
    found += [F.when(F.col(c).isNotNull(), entry(c, F.col(c), none)) for c in categorical]
    found += [
        F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), entry(_pair_name(a, b), F.col(a), F.col(b)))
        for a, b in _pairs(categorical)
    ]
    return F.array_compact(F.array(*found))


def _name(i: int) -> str:
    return f"_x{i}"


def _means(numeric: list[str], label: str, over: Window | None = None) -> list[Column]:
    out = []
    for c in (*numeric, label):
        mean = F.avg(c) if over is None else F.avg(c).over(over)
        out.append(F.coalesce(mean, F.lit(0.0)).alias(f"_m_{c}"))
    return out


def _centred(
    train: DataFrame, numeric: list[str], label: str, by: list[str], salts: int | None
) -> DataFrame:
    names = [f"_m_{c}" for c in (*numeric, label)]
    if not by:
        means = train.agg(F.struct(*_means(numeric, label)).alias("m")).scalar()
        return train.withColumn("_means", means).select(
            "*", *[F.col(f"_means.{n}").alias(n) for n in names]
        ).drop("_means")
    if salts is None:
        spec = Window.partitionBy(*by)
        return train.select("*", *_means(numeric, label, spec))
    return salted_join(train, train.groupBy(*by).agg(*_means(numeric, label)), by, salts)


def _solver(by, numeric, categorical, label, l2, schema):
    columns = [*numeric, label]
    width = len(columns)

    def solve(cells: pd.DataFrame) -> pd.DataFrame:
        """``cells``: the sums of the key, of each category value, and counts of pairs of values."""
        kind = cells[_KIND].to_numpy()
        whole = cells[kind == _ALL]
        n = float(whole[_N].iloc[0])
        sums = whole[[f"_s{i}" for i in range(width)]].to_numpy(dtype=float)
        gram = np.zeros((width, width))
        for i in range(width):
            for j in range(i, width):
                gram[i, j] = gram[j, i] = whole[f"_p{i}_{j}"].iloc[0]
        names, place = list(numeric), {}
        count, level_sums = [], []
        for c in categorical:
            own = cells[kind == c].sort_values(_LEFT)
            for level, m, s in zip(own[_LEFT], own[_N], own[[f"_s{i}" for i in range(width)]].to_numpy(dtype=float)):
                place[c, level] = len(count)
                names.append(f"{c}={level}")
                count.append(float(m))
                level_sums.append(s)
        count = np.array(count)
        both = np.diag(count) if len(count) else np.zeros((0, 0))
        for a, b in _pairs(categorical):
            met = cells[kind == _pair_name(a, b)]
            for x, y, m in zip(met[_LEFT], met[_RIGHT], met[_N]):
                both[place[a, x], place[b, y]] = both[place[b, y], place[a, x]] = float(m)
        level_sums = np.array(level_sums).reshape(len(count), width)
        total = sums.sum(axis=0)
        gram -= np.outer(total, total) / n
        share = count / n
        cross = level_sums - np.outer(share, total)
        indicator = both - n * np.outer(share, share)
        d = len(numeric)
        a = np.block([[gram[:d, :d], cross[:, :d].T], [cross[:, :d], indicator]])
        b = np.concatenate([gram[:d, d], cross[:, d]])
        a += l2 * np.eye(len(b))
        # Unit diagonal: features of very different size must not look degenerate.
        size = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
        weights = np.linalg.lstsq(a / np.outer(size, size), b / size, rcond=None)[0] / size
        means = whole[[f"_m_{c}" for c in columns]].iloc[0].to_numpy(dtype=float) + total / n
        intercept = means[d] - weights @ np.concatenate([means[:d], share])
        row = {k: whole[k].iloc[0] for k in by}
        row["n"] = int(n)
        row["intercept"] = float(intercept)
        row["names"] = names
        row["values"] = weights.tolist()
        row["means"] = means[:d].tolist()
        return pd.DataFrame([row], columns=schema.names)

    return solve


def fit_ridge(
    df: DataFrame,
    numeric: list[str],
    label: str,
    categorical: list[str] | None = None,
    l2: float = DEFAULT_L2,
    by: list[str] | None = None,
    salts: int | None = None,
) -> DataFrame:
    """One model row (per key): n, intercept, weights and means. Rows without label are unused.

    Numbers are centred first, because sums of raw squares lose digits, and then summed as
    cross products per key, as sums per category value, and as counts per pair of values of
    two categories, before anything is shuffled. The solve step sees those sums, never the
    rows: as many as its matrix has entries, however many categories there are. NaN and the
    infinities count as missing. Keyed fits take the means by a window over the key,
    which needs no shuffle when the rows are series already gathered by key; for keys with
    unbounded rows give ``salts``, and the means are joined back over that many parts.
    """
    by, categorical = list(by or []), list(categorical or [])
    columns = [*numeric, label]
    train = df.filter(finite(F.col(label).cast("double")).isNotNull()).select(
        *by, *categorical, *[finite(F.col(c).cast("double")).alias(c) for c in columns]
    )
    x = {c: F.coalesce(F.col(c) - F.col(f"_m_{c}"), F.lit(0.0)) for c in columns}
    centred = _centred(train, numeric, label, by, salts).select(
        *by,
        *categorical,
        *[f"_m_{c}" for c in columns],
        *[x[c].alias(_name(i)) for i, c in enumerate(columns)],
    )
    width = range(len(columns))
    # Sums of a value are needed for the key and for single values, products for the key alone.
    single, whole = F.col(_RIGHT).isNull(), F.col(_KIND) == _ALL
    spread = centred.select("*", F.inline(entries(categorical))) if categorical else centred.select(
        "*", F.lit(_ALL).alias(_KIND), *(F.lit(None).cast("string").alias(c) for c in (_LEFT, _RIGHT))
    )
    cells = spread.groupBy(*by, _KIND, _LEFT, _RIGHT).agg(
        F.count(F.lit(1)).alias(_N),
        *[F.max(f"_m_{c}").alias(f"_m_{c}") for c in columns],
        *[F.sum(F.when(single, F.col(_name(i)))).alias(f"_s{i}") for i in width],
        *[
            F.sum(F.when(whole, F.col(_name(i)) * F.col(_name(j)))).alias(f"_p{i}_{j}")
            for i in width
            for j in width
            if i <= j
        ],
    ).filter(F.col(_N) > 0)
    return solve_cells(cells, [df.schema[k] for k in by], numeric, label, categorical, l2, by)


def solve_cells(cells: DataFrame, keys: list[T.StructField], numeric: list[str], label: str, categorical: list[str],
                l2: float, by: list[str]) -> DataFrame:
    """Models from the sums of each key: see ``fit_ridge``."""
    numbers = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [
            *keys,
            T.StructField("n", T.LongType()),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("names", T.ArrayType(T.StringType())),
            T.StructField("values", numbers),
            T.StructField("means", numbers),
        ]
    )
    solved = cells.groupBy(*by).applyInPandas(
        _solver(by, numeric, categorical, label, l2, schema), schema
    )
    return solved.select(
        *by,
        "n",
        "intercept",
        F.map_from_arrays("names", "values").alias("weights"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in numeric]), "means").alias("means"),
    )


def predict(
    df: DataFrame,
    model: DataFrame,
    numeric: list[str],
    output: str,
    categorical: list[str] | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Adds the estimate, keeping the input columns. A key without a model is left out."""
    by, categorical = list(by or []), list(categorical or [])
    parts = ["intercept", "weights", "means"]
    if by:
        joined = df.join(model.select(*by, F.struct(*parts).alias("_model")), by, "inner")
    else:
        one = model.select(F.struct(*parts).alias("m")).scalar()
        joined = df.withColumn("_model", one)
    weight = lambda k: F.try_element_at("_model.weights", k)
    estimate = F.col("_model.intercept")
    for c in numeric:
        mean = F.try_element_at("_model.means", F.lit(c))
        estimate = estimate + weight(F.lit(c)) * F.coalesce(finite(F.col(c).cast("double")), mean)
    for c in categorical:
        level = F.concat(F.lit(f"{c}="), F.col(c))
        estimate = estimate + F.coalesce(weight(level), F.lit(0.0))
    return joined.select(*df.columns, estimate.alias(output))
