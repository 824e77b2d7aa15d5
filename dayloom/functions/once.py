"""Computed columns that a later filter does not compute again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW = "_computed"


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns behind a one-row generator.

    The optimizer moves a filter below a projection by copying the projected expressions
    into it, once for every use. That is right for cheap expressions; a parser would be
    run dozens of times per row. A filter is not moved below a generator. The expressions
    are computed in the projection under it, where equal parts are shared.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select(*kept, row.alias(_ROW)).select(*kept, F.inline(F.array(_ROW)))
