"""Text files read line by line, and the two line formats of the batch feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.functions import compute_once, null_if_token, parse_double, safe_double, strip_quotes
from dayloom.functions.numbers import MISSING_TOKEN

# No line holds this, so the whole line comes back as one field.
NO_SEPARATOR = "\u0001\u0002\u0001"
# Added as one more field: where it turns up tells how many fields a line really has,
# since the CSV reader gives null for an absent field and for an empty one alike.
_END = "\u0001end"

# A buffer is held by every running parser; longer lines refill it.
_CSV_OPTIONS = {"escape": '"', "inputBufferSize": "16384"}


def read_lines(spark: SparkSession, path: str, skip_header: bool = False) -> DataFrame:
    """One row per line in column ``line``. Files are split among tasks.

    With ``skip_header`` the first line of every file is left out; the reader then also
    leaves out blank lines.
    """
    if not skip_header:
        return spark.read.text(path).withColumnRenamed("value", "line")
    return (
        spark.read.schema("line string")
        .option("header", True)
        .option("sep", NO_SEPARATOR)
        .option("quote", "")
        .option("maxCharsPerColumn", -1)
        .csv(path)
    )


def parse_csv_line(line: Column | str, pick: dict[str, int]) -> Column:
    """Quoted CSV text to a struct of the picked fields; null when a picked field is absent."""
    text = F.col(line) if isinstance(line, str) else line
    width = max(pick.values()) + 1
    schema = ", ".join(f"f{i} string" for i in range(width))
    fields = F.from_csv(F.concat(text, F.lit(f",{_END}")), schema, _CSV_OPTIONS)
    cells = [fields.getField(f"f{i}") for i in range(width)]
    cut_short = F.lit(False)
    for cell in cells:
        cut_short = cut_short | F.coalesce(cell.contains(_END), F.lit(False))
    picked = [strip_quotes(F.coalesce(cells[i], F.lit(""))).alias(n) for n, i in pick.items()]
    return F.when(text.isNotNull() & ~cut_short, F.struct(*picked))


def parse_plain_line(
    df: DataFrame,
    line: str = "line",
    integers: tuple[str, ...] = ("year", "doy"),
    numbers: tuple[str, ...] = ("precipitation", "soil_moisture"),
    missing_token: str | None = MISSING_TOKEN,
    allow_non_finite: bool = False,
) -> DataFrame:
    """Unquoted CSV lines to typed columns; a line with too few or unreadable fields is left out.

    The missing marker gives null, which does not leave the line out.
    """
    to_number = parse_double if allow_non_finite else safe_double
    names = (*integers, *numbers)
    cells = df.withColumn("_cells", F.split(F.col(line), ",")).filter(
        F.size("_cells") >= len(names)
    )
    values, readable = {}, F.lit(True)
    for i, name in enumerate(names):
        cell = F.get("_cells", F.lit(i))
        if name in integers:
            values[name] = cell.try_cast("int")
            readable = readable & F.col(name).isNotNull()
        else:
            text = cell if missing_token is None else null_if_token(cell, missing_token)
            values[name] = to_number(text)
            missing = text.isNull()
            readable = readable & (missing | F.col(name).isNotNull())
    kept = [c for c in df.columns if c != line]
    return compute_once(cells, values).filter(readable).select(*kept, *names)
