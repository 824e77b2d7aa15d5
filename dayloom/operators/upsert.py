"""Merge a keyed source into a keyed target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.operators.quality import failing
from dayloom.operators.skew import DEFAULT_SALTS, content_hash, salt, salted_join


_SPREAD = "_spread"


def _spread(df: DataFrame, keys: list[str]) -> Column:
    """Zero for complete keys; rows whose key has a null never match, so they may go anywhere."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return F.when(complete, F.lit(0)).otherwise(salt(content_hash(df), DEFAULT_SALTS))


def _one_row_per_key(source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Fails on a key that occurs twice: which of its rows should win is not for a merge to say."""
    rows = source.select(*keys, *columns)
    counted = rows.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys, _spread(rows, keys))))
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return failing(counted, complete & (F.col("_rows") > 1), "a key of the source occurs twice").drop("_rows")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    columns: list[str],
    keep_existing_on_null: bool = False,
    drop_null_keys: bool = False,
    target_salts: int | None = None,
) -> DataFrame:
    """Matched rows take the source's columns, unmatched source rows are added.

    ``source`` holds one row per key; a key that occurs twice ends the job. By default a null in the source replaces a value, and
    a null key never matches, so such a row is added on every run; both can be switched off.
    Target columns outside ``keys`` and ``columns`` keep their value, and are null in added
    rows. A target holds a key once; where one key may hold very many target rows, give
    ``target_salts`` and they are spread over that many parts.
    """
    if drop_null_keys:
        source = source.dropna(subset=keys)
    source = _one_row_per_key(source, keys, columns)
    if target_salts:
        return _upsert_spread(target, source, keys, columns, keep_existing_on_null, target_salts)
    incoming = source.withColumns({"_incoming": F.lit(True), _SPREAD: _spread(source, keys)})
    existing = target.withColumns({"_existing": F.lit(True), _SPREAD: _spread(target, keys)})
    incoming, existing = incoming.alias("s"), existing.alias("t")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in (*keys, _SPREAD)]
    condition = on[0]
    for clause in on[1:]:
        condition = condition & clause
    both = existing.join(incoming, condition, "full_outer")
    arrived, known = F.col("s._incoming").isNotNull(), F.col("t._existing").isNotNull()

    def merged(name: str) -> Column:
        old, new = F.col(f"t.{name}"), F.col(f"s.{name}")
        if name in keys:
            return F.when(known, old).otherwise(new)
        if name not in columns:
            return old
        if keep_existing_on_null:
            new = F.coalesce(new, old)
        return F.when(arrived, new).otherwise(old)

    return both.select(*[merged(c).alias(c) for c in target.columns])


def _upsert_spread(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    columns: list[str],
    keep_existing_on_null: bool,
    salts: int,
) -> DataFrame:
    """The same in two joins: a salted one for target rows, one for keys the target lacks."""
    both = salted_join(target, _renamed(source, keys, columns), keys, salts, "left")
    known = target.select(*keys).distinct()
    added = source.select(*keys, *columns).join(known, keys, "left_anti")
    return _updated(both, target, columns, keep_existing_on_null).unionByName(
        added, allowMissingColumns=True
    )


def _renamed(source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    new = [F.col(c).alias(f"_new_{c}") for c in columns]
    return source.select(*keys, *new, F.lit(True).alias("_incoming"))


def _updated(
    both: DataFrame, target: DataFrame, columns: list[str], keep_existing_on_null: bool
) -> DataFrame:
    def merged(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        value = F.col(f"_new_{name}")
        if keep_existing_on_null:
            value = F.coalesce(value, F.col(name))
        return F.when(F.col("_incoming"), value).otherwise(F.col(name))

    return both.select(*[merged(c).alias(c) for c in target.columns])
