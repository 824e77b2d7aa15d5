"""Rows and cells of nested tables in page markup, by a fold over their tags.

The fold runs over every tag of a table, row or cell and keeps the open row and cell of each open
table as a stack, so that a cell ends at its own end tag and not at that of a table inside it. End
tags that are left out are implied: a new cell ends the open one, a new row ends the open row, the
end of a table ends all in it, the end of the page ends everything. Stray end tags change nothing.
Comments, scripts and style sheets are no markup.

A page stays in its row: nothing is shuffled. The fold takes each tag once and goes through Arrow in
batches of pages; counts, cells and cells of inner tables come from one pass (``page_rows``).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.sources.markup import ENTITIES

# Letters of names are those of ASCII in either case; what ends a name is judged in all of Unicode.
NOT_MARKUP = re.compile(r"(?s:<!--.*?-->)|<(?ai:(script|style))\b(?s:.*?)</(?ai:\1\s*)>")
CUT = re.compile(r"<(?ai:(/?(?:table|tr|td|th)))\b")
#: A tag; quoted values may hold ">".
TAG = re.compile(r"""</?[A-Za-z!](?:"[^"]*"|'[^']*'|[^'">])*+>""")
#: The opening tag of a row whose id starts with "table_" (a pattern of Python's).
ROW_TAG = r"""(?ai)\sid\s*=\s*["']?table_"""

_CELL = pa.struct([("text", pa.string()), ("own", pa.bool_())])
_ROW = pa.struct([("row_no", pa.int32()), ("cells", pa.list_(_CELL))])
_KIND = "struct<found:bigint,rows:array<struct<row_no:int,cells:array<struct<text:string,own:boolean>>>>>"


def plain_text(markup: str) -> str:
    """Text of a piece of markup: tags out, entities resolved, blanks at both ends trimmed."""
    text = TAG.sub("", markup)
    if "&" in text:
        for entity, character in ENTITIES.items():
            text = text.replace(entity, character)
    return text.strip(" ")


def _elements(tags: list[tuple[int, str]], size: int) -> tuple[list[tuple[int, int, bool]], list[int], list[int]]:
    """Rows and cells in the order in which they open: (tag, open tables, is a row), and for each
    where it ends and how many elements were opened until then."""
    opened: list[tuple[int, int, bool]] = []
    ends: list[int] = []
    until: list[int] = []
    # Open row and cell of each open table, and of the page outside all tables.
    stack = [(None, None)]

    def close(element, at):
        if element is not None:
            ends[element], until[element] = at, len(opened)

    for number, (at, name) in enumerate(tags):
        row, cell = stack[-1]
        if name == "table":
            stack.append((None, None))
        elif name == "/table":
            if len(stack) > 1:
                close(cell, at)
                close(row, at)
                stack.pop()
        elif name == "tr" or name == "/tr":
            if name == "tr" or row is not None:
                close(cell, at)
                close(row, at)
                row = cell = None
            if name == "tr":
                row = len(opened)
                opened.append((number, len(stack), True))
                ends.append(size)
                until.append(0)
            stack[-1] = row, cell
        else:
            close(cell, at)
            cell = None
            if name[0] != "/":
                cell = len(opened)
                opened.append((number, len(stack), False))
                ends.append(size)
                until.append(0)
            stack[-1] = row, cell
    for row, cell in stack:
        close(cell, size)
        close(row, size)
    return opened, ends, until


def _page(html: str | None, row_tag: re.Pattern, own: bool, inner: bool) -> tuple[int, list[list[tuple[str, bool]]]]:
    """Number of matching rows of a page, and if asked for the cells of each: text, and whether it is the row's own."""
    html = NOT_MARKUP.sub("", html or "")
    tags = [(m.start(), m[1].lower()) for m in CUT.finditer(html)]
    opened, ends, until = _elements(tags, len(html))
    found = []
    for place, (number, depth, is_row) in enumerate(opened):
        if not is_row:
            continue
        # The opening tag ends before the next cut.
        bound = tags[number + 1][0] if number + 1 < len(tags) else len(html)
        tag = TAG.match(html, tags[number][0], bound)
        if row_tag.search(tag[0] if tag else ""):
            inside = range(place + 1, until[place]) if own else ()
            cells = [e for e in inside if not opened[e][2] and (inner or opened[e][1] == depth)]
            found.append([(plain_text(html[tags[opened[e][0]][0]:ends[e]]), opened[e][1] == depth) for e in cells])
    return len(found), found if own else []


def page_rows(
    df: DataFrame, html: str, row_tag: str = ROW_TAG, nested_cells: bool = False, keep: tuple[str, ...] = (), cells: bool = True
) -> DataFrame:
    """``keep`` and, for each page, ``found`` (its matching rows) and ``rows``: position and ``cells``.

    A cell has its ``text`` and whether it is the row's ``own``; those of inner tables are listed with
    ``nested_cells`` only, and ``rows`` is empty without ``cells``.
    """

    @F.arrow_udf(_KIND)
    def scan(pages: pa.Array) -> pa.Array:
        wanted = re.compile(row_tag)
        found, pages_at, numbers, rows_at, texts, own = [], [0], [], [0], [], []
        for page in pages.to_pylist():
            n, rows = _page(page, wanted, cells, nested_cells)
            found.append(n)
            for number, row in enumerate(rows):
                numbers.append(number)
                for text, is_own in row:
                    texts.append(text)
                    own.append(is_own)
                rows_at.append(len(texts))
            pages_at.append(len(numbers))
        each = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(own, pa.bool_())], fields=list(_CELL))
        lists = pa.ListArray.from_arrays(pa.array(rows_at, pa.int32()), each)
        every = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), lists], fields=list(_ROW))
        listed = pa.ListArray.from_arrays(pa.array(pages_at, pa.int32()), every)
        return pa.StructArray.from_arrays([pa.array(found, pa.int64()), listed], ["found", "rows"])

    names = [f"_keep_{i}" for i in range(len(keep))]
    kept = df.select(*(df[c].alias(n) for n, c in zip(names, keep)), scan(df[html]).alias("_scan"))
    return kept.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "_scan.found", "_scan.rows")


def extract_nested_rows(
    df: DataFrame,
    html: str,
    row_tag: str = ROW_TAG,
    min_cells: int = 6,
    nested_cells: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per table row whose opening tag holds ``row_tag``: position, cell texts, rows found.

    ``row_no`` counts the matching rows of a page from 0, rows of inner tables included, in the
    order in which they open. ``cells`` are the row's own; with ``nested_cells`` those of tables
    inside them follow in the order in which they open, and a cell's text holds all text inside
    it in both cases. Rows of fewer than ``min_cells`` cells are left out, but keep their number.
    A null or empty page has no rows; see ``count_rows`` for pages that must have some.
    """
    names = [f"_keep_{i}" for i in range(len(keep))]
    pages = df.select(*(df[c].alias(n) for n, c in zip(names, keep)), df[html].alias("_html"))
    rows = page_rows(pages, "_html", row_tag, nested_cells, tuple(names)).select(*names, F.explode("rows").alias("_row"))
    listed = rows.where(F.size("_row.cells") >= min_cells)
    return listed.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "_row.row_no", F.col("_row.cells.text").alias("cells"))


def count_rows(df: DataFrame, html: str, row_tag: str = ROW_TAG, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and the number of matching rows of each page, as ``found``; 0 for a null page."""
    return page_rows(df, html, row_tag, keep=keep, cells=False).drop("rows")
