"""Newest row per key, and the two policies for rows that share a key.

One key may hold a large share of all rows, and a group of exact copies likewise, so no
step here brings a whole group to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.functions.numbers import finite
from dayloom.operators.quality import DUPLICATE_DATE, DUPLICATE_RECORD
from dayloom.operators.skew import DEFAULT_SALTS, content_hash, salt

_HASH, _SALT, _PLACE, _MORE, _MEET = "_hash", "_salt", "_place", "_more", "_meet"


def _descending(order: list[Column | str]) -> list[Column]:
    return [F.col(c).desc() if isinstance(c, str) else c for c in order]


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The newest row of each key; plain names in ``order`` sort descending.

    The rank filter is pushed below the shuffle (a window group limit), so each task sends
    at most one row per key and a key with very many rows costs no more than any other.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*_descending(order)))
    return df.withColumn(_PLACE, place).filter(F.col(_PLACE) == 1).drop(_PLACE)


def any_value_by_key(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One non-null value per key and column, each column for itself.

    Any value will do; the greatest is taken, so that a rerun gives the same rows. A finite
    number goes before NaN and the infinities, which stand only where there is no other.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def best(c: str) -> Column:
        if kinds[c] in ("double", "float"):
            return F.coalesce(F.max(finite(c)), F.max(c)).alias(c)
        return F.max(c).alias(c)

    return df.groupBy(*keys).agg(*[best(c) for c in columns])


def mark_duplicates(
    df: DataFrame,
    keys: list[str],
    order: list[Column | str],
    salts: int = DEFAULT_SALTS,
    first: str = "is_first",
    alone: str = "is_alone",
) -> DataFrame:
    """Adds whether a row is the first of its key, and whether it is the only one.

    Two rounds: rows are ranked within (key, salt), then only the first row of each salt
    meets the others of its key, at most ``salts`` rows. The salt mixes row content and
    input partition, so distinct rows of a hot key spread and so do exact copies. The
    order is made total by the row content; which of several exact copies comes first
    does not show in the result, so the salt does not either.
    """
    total = [*order, _HASH]
    hashed = df.withColumn(_HASH, content_hash(df))
    salted = hashed.withColumn(_SALT, salt(F.col(_HASH), salts))
    inner = Window.partitionBy(*keys, _SALT).orderBy(*total)
    ranked = salted.withColumns(
        {_PLACE: F.row_number().over(inner), _MORE: F.lead(F.lit(True)).over(inner)}
    ).withColumn(_MEET, F.when(F.col(_PLACE) == 1, F.lit(-1)).otherwise(F.col(_SALT)))
    outer = Window.partitionBy(*keys, _MEET).orderBy(*total)
    met = ranked.withColumns(
        {"_outer_place": F.row_number().over(outer), "_outer_more": F.lead(F.lit(True)).over(outer)}
    )
    is_first = (F.col(_PLACE) == 1) & (F.col("_outer_place") == 1)
    return met.select(
        *df.columns,
        is_first.alias(first),
        (is_first & F.col(_MORE).isNull() & F.col("_outer_more").isNull()).alias(alone),
    )


def _duplicate_reason(date: str | None) -> Column:
    if date is None:
        return F.lit(DUPLICATE_DATE)
    return F.concat(F.lit(DUPLICATE_RECORD), F.col(date).cast("string"))


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in ascending ``order``."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, content_hash(df)))
    return df.withColumn(_PLACE, place).filter(F.col(_PLACE) == 1).drop(_PLACE)


def keep_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once.

    Two rows per key and task are enough to tell whether a key repeats, so at most two
    are sent; the count over what arrives needs no further shuffle.
    """
    hashed = content_hash(df)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(hashed))
    two = df.withColumn(_PLACE, place).filter(F.col(_PLACE) <= 2)
    return (
        two.withColumn(_MORE, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        .filter(F.col(_MORE) == 1)
        .drop(_PLACE, _MORE)
    )


def _of_repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once; nulls match nulls.

    Counts are partial, so a hot key collapses before the shuffle; rows meet one row per
    repeated key, and adaptive execution splits a key that holds very many of them.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_MORE)).filter(F.col(_MORE) > 1)
    listed = counted.select(*[F.col(k).alias(f"_l_{k}") for k in keys])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_l_{key}"))
    return df.join(listed, same, "left_semi")


def dedup(
    df: DataFrame,
    keys: list[str],
    policy: str,
    order: list[Column | str] | None = None,
    reason_date: str | None = None,
    errors: str = "errors",
    salts: int = DEFAULT_SALTS,
) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rejected rows with their reason.

    ``keep_first`` keeps one row per key and rejects the rest; ``reject_all`` rejects every
    row of a key that occurs more than once. The two frames are planned apart, because the
    kept side needs far less data moved than the rejected side: for that, keys are counted
    before the shuffle and only rows of keys that repeat are ranked.
    """
    if policy not in ("keep_first", "reject_all"):
        raise ValueError(f"unknown policy: {policy}")
    order = list(order or [])
    marked = mark_duplicates(_of_repeated_keys(df, keys), keys, order, salts)
    if policy == "keep_first":
        kept, bad = keep_first(df, keys, order), marked.filter(~F.col("is_first"))
    else:
        kept, bad = keep_unique(df, keys), marked.filter(~F.col("is_alone"))
    reasons = F.array(_duplicate_reason(reason_date))
    return kept, bad.drop("is_first", "is_alone").withColumn(errors, reasons)
