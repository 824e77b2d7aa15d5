"""Nested table rows against a stack parser of its own."""

import re

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dayloom.catalog import QUERIES
from dayloom.sources.markup import require_rows
from dayloom.sources.markup_depth import count_rows, extract_nested_rows, page_rows
from support import values


def brute(html, nested=False):
    """Rows with an id "table_..." as (number, cell texts), by a plain parser over characters."""
    html = re.sub(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "", html or "")
    stack, every = [], []

    def close(to):
        while len(stack) > to:
            stack.pop()["end"] = position

    position = 0
    for match in re.finditer(r"(?i)<(/?)(table|tr|td|th)\b[^>]*>", html):
        position = match.start()
        end, name = match.group(1), match.group(2).lower().replace("th", "td")
        base = max((i + 1 for i, e in enumerate(stack) if e["name"] == "table"), default=0)
        above = [e["name"] for e in stack[base:]]
        if name == "table":
            if end and base:
                close(base - 1)
        elif name == "tr":
            if not end or "tr" in above:
                close(base)
        elif "td" in above:
            close(base + above.index("td"))
        if not end:
            element = {"name": name, "tag": match.group(0), "at": position, "end": None,
                       "depth": sum(e["name"] == "table" for e in stack)}
            stack.append(element)
            every.append(element)
    position = len(html)
    close(0)
    out = []
    for row in every:
        if row["name"] == "tr" and re.search(r"(?i)\sid=[\"']?table_", row["tag"]):
            cells = [e for e in every if e["name"] == "td" and row["at"] < e["at"] < row["end"]
                     and (nested or e["depth"] == row["depth"])]
            text = [re.sub(r"<[^>]*>", "", html[e["at"]:e["end"]]).strip(" ") for e in cells]
            out.append((len(out), text))
    return out


def got(spark, pages, nested=False):
    df = spark.createDataFrame(list(enumerate(pages)), "page int, html string")
    rows = extract_nested_rows(df, "html", min_cells=0, nested_cells=nested, keep=("page",)).collect()
    return sorted((r.page, r.row_no, r.cells) for r in rows)


def wanted(pages, nested=False):
    return sorted((i, n, cells) for i, page in enumerate(pages) for n, cells in brute(page, nested))


NESTED = """<table id=table_1><tbody><TR id="table_1_row_0"><td>1<td>02/01/2024
<td><table><tr><td>in</td><td>deep<table><tr id=table_x><td>z</table></td></tr></table></td>
<!-- <td>no</td> --><td>a &amp;lt; b</td><td title="x>y">q</td><script>var t="</td></tr>";</script><td>9</tr>
<tr id='table_1_row_1'><td>short</table><p>after</p>"""


@pytest.mark.parametrize("nested", [False, True])
def test_nested_and_unclosed(spark, nested):
    rows = got(spark, [NESTED], nested)
    own = ["1", "02/01/2024\n", "indeepz", "a &lt; b", "q", "9"]
    inner = ["1", "02/01/2024\n", "indeepz", "in", "deepz", "z", "a &lt; b", "q", "9"]
    assert rows == [(0, 0, inner if nested else own), (0, 1, ["z"]), (0, 2, ["short"])]


PIECES = ["<table>", "</table>", "<tr id=table_1>", "<tr>", "</tr>", "<td>", "</td>", "<TH x=1>", "</th>",
          "a", " b ", "<b>", "</b>", "<thead>", "<!-- <td> -->", "<", "é"]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), min_size=30, max_size=60), st.booleans())
def test_equals_stack_parser(spark, pages, nested):
    pages = [p.replace("<<", "<").replace("<a", "a").replace("<é", "é").replace("< b", " b") for p in pages]
    pages = [re.sub(r"<(?![/!a-zA-Z])|<$", "", p) for p in pages]
    assert got(spark, pages, nested) == wanted(pages, nested)


def test_page_of_many_rows_spans_blocks(spark):
    page = "<table>" + "".join(f"<tr id=table_{i}><td>{i}<td><table><tr><td>x{i}</table>" for i in range(700))
    assert got(spark, [page]) == wanted([page])
    assert got(spark, [page], True) == wanted([page], True)


def test_empty_null_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, NESTED, 7)], "row_no int, html string, _all int")
    counted = count_rows(df, "html", keep=("row_no", "_all"))
    assert values(counted) == [(1, 5, 0), (2, 6, 0), (3, 7, 3)]
    assert extract_nested_rows(df.select("html", "_all"), "html", keep=("_all",)).first()._all == 7
    with pytest.raises(Exception, match="price rows not found"):
        require_rows(counted, "found").collect()
    assert extract_nested_rows(df.where("false"), "html").count() == 0


def test_one_pass_gives_counts_and_cells(spark):
    df = spark.createDataFrame([(1, NESTED), (2, None), (3, "<table><tr><td>x</table>")], "page int, html string")
    one = {r.page: r for r in page_rows(df, "html", nested_cells=True, keep=("page",)).collect()}
    assert [one[p].found for p in (1, 2, 3)] == [3, 0, 0] and one[2].rows == []
    outer = one[1].rows[0]
    assert [c.text for c in outer.cells if c.own] == ["1", "02/01/2024\n", "indeepz", "a &lt; b", "q", "9"]
    assert [c.text for c in outer.cells if not c.own] == ["in", "deepz", "z"]
    checked = require_rows(page_rows(df, "html", keep=("page",)), "found").select("found", F.explode_outer("rows"))
    with pytest.raises(Exception, match="price rows not found"):
        checked.collect()


def test_query_folds_each_page_once(spark):
    plan = QUERIES["markup_nested_rows"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    # The lines of an order are its only join: no page is folded or sent again for its counts.
    assert sum("Join " in line for line in plan.split("== Initial Plan ==")[-1].splitlines()) == 1


def test_names_and_tags_at_their_edges(spark):
    pages = [
        "<table><tr id=table_1><td>a<tdé>b<TD_>c<Td>d",
        '<table><tr title="<td" id=table_1><td>a',
        "<table><tr ıd=table_1><td>a<tr ID = 'table_2'><td>&amp;nbsp;\u00a0</ſcript>",
        "<SCRIPT><td></script ><tr id=table_1><td>1<td",
    ]
    assert got(spark, pages) == [(0, 0, ["abc", "d"]), (2, 0, ["&nbsp;\u00a0</ſcript>"]), (3, 0, ["1", "<td"])]
