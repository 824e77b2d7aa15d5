"""Rows and cells of page markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.functions import date_from_dmy, safe_double, strip_thousands
from dayloom.operators.dedup import latest_per_key

# Table rows with a "table_" id, and their cells.
TABLE_ROW = r"(?s)<tr[^>]*\sid=[\"']?table_[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?s)<td[^>]*>(.*?)</td>"
_TAG = r"<[^>]*>"

# Entities that stand for a character; the ampersand's own comes last.
ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&amp;": "&",
}


def cell_text(cell: Column) -> Column:
    """Text of a cell: tags out, entities resolved, blanks at both ends trimmed."""
    text = F.regexp_replace(cell, _TAG, "")
    for entity, character in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(text)


def extract_markup_rows(
    df: DataFrame,
    html: str,
    row_re: str = TABLE_ROW,
    cell_re: str = TABLE_CELL,
    min_cells: int = 6,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per markup row with at least ``min_cells`` cells: position and cell texts.

    Group 1 of each pattern is taken, over the whole text of the page.
    """
    rows = df.select(
        *keep, F.posexplode(F.regexp_extract_all(html, F.lit(row_re), 1)).alias("row_no", "_row")
    )
    cells = rows.select(
        *keep, "row_no", F.regexp_extract_all("_row", F.lit(cell_re), 1).alias("_raw")
    ).filter(F.size("_raw") >= min_cells)
    return cells.select(*keep, "row_no", F.transform("_raw", cell_text).alias("cells"))


def require_rows(df: DataFrame, found: str, message: str = "price rows not found") -> DataFrame:
    """Fails the job on a page in which no row was found (``found`` is the count column)."""
    checked = F.when(
        F.col(found) == 0, F.raise_error(F.lit(message)).cast("bigint")
    ).otherwise(F.col(found))
    return df.withColumn(found, checked)


def dated_prices(cells: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Second cell as the date, last cell as the price; rows without a date are left out."""
    return cells.select(
        *keep,
        "row_no",
        date_from_dmy(F.trim(F.try_element_at("cells", F.lit(2)))).alias("date"),
        safe_double(strip_thousands(F.trim(F.try_element_at("cells", F.lit(-1))))).alias("price"),
    ).filter(F.col("date").isNotNull())


def markup_latest_row(prices: DataFrame, by: list[str], tie_break: list[str]) -> DataFrame:
    """Newest dated row per key; among rows of one date the first in ``tie_break`` order."""
    first = [F.col(c).asc() for c in tie_break]
    return latest_per_key(prices, by, [F.col("date").desc(), *first])
