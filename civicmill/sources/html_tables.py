"""Rows of the largest table of a landed page."""

import re
from html import unescape

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = T.StructType(
    [
        T.StructField("row_no", T.LongType()),
        T.StructField("cells", T.MapType(T.StringType(), T.StringType())),
        T.StructField("second", T.StringType()),
    ]
)


# Comments, scripts and styles as a whole, then tags with their quoted attributes, then the rest.
TOKEN = re.compile(
    r"""<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>"""
    r"""|<(/?)([a-z][a-z0-9]*)\b((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""",
    re.S | re.I,
)
SUBMIT = re.compile(r"""\btype\s*=\s*["']?submit\b""", re.I)
VALUE = re.compile(r"""\bvalue\s*=\s*(?:"([^"]*)"|'([^']*)')""", re.I)
CELLS = ("td", "th")


def _close(stack, *names):
    """Close the innermost open cell or row of the current table."""
    while stack and stack[-1][0] in names:
        stack.pop()


def _open(stack, tables, tag):
    """Start a table, row or cell; one inside a nested table also counts for the outer ones."""
    if tag == "table":
        item = {"headings": [], "rows": []}
        tables.append(item)
    elif tag == "tr":
        _close(stack, *CELLS, "tr")
        item = []
        for kind, outer in stack:
            if kind == "table":
                outer["rows"].append(item)
    else:
        _close(stack, *CELLS)
        item = {"texts": [], "button": None, "empty": True}
        for kind, outer in stack:
            if tag == "td" and kind == "tr":
                outer.append(item)
            elif tag == "th" and kind == "table":
                outer["headings"].append(item)
    stack.append((tag, item))


def _tables(page):
    """Headings and rows of every table of a page."""
    tables, stack, at = [], [], 0
    for token in TOKEN.finditer(page):
        _text(stack, page[at : token.start()])
        at = token.end()
        ends, tag, attributes = token[1], (token[2] or "").lower(), token[3]
        if ends and tag in CELLS:
            _close(stack, *CELLS)
        elif ends and tag in ("tr", "table"):
            _close(stack, *CELLS, "tr")
            if tag == "table" and stack:
                stack.pop()
        elif tag in ("table", "tr", *CELLS):
            _open(stack, tables, tag)
        elif tag and not ends and stack and stack[-1][0] == "td":
            cell = stack[-1][1]
            if tag == "input" and cell["empty"] and SUBMIT.search(attributes):
                value = VALUE.search(attributes)
                cell["button"] = unescape(value[1] or value[2] or "") if value else None
            cell["empty"] = False
    _text(stack, page[at:])
    return tables


def _text(stack, data):
    if data and stack:
        for kind, item in stack:
            if kind in CELLS:
                item["texts"].append(unescape(data))
                item["empty"] = False


def largest_table(page):
    """(headings, rows) of the table with the most rows, the last one on ties."""
    tables = _tables(page)
    if not tables:
        return [], []
    best = max(enumerate(tables), key=lambda t: (len(t[1]["rows"]), t[0]))[1]
    return ["".join(h["texts"]) for h in best["headings"]], best["rows"]


def _records(html, separator, button):
    headings, rows = largest_table(html)
    number = 0
    for row in rows if headings else []:
        if len(row) != len(headings):
            continue
        cells = {}
        for name, cell in zip(headings, row):
            if cell["button"] is not None and button:
                cells[button] = cell["button"]
            else:
                cells[name] = separator.join(cell["texts"])
        yield number, cells, separator.join(row[1]["texts"]).strip() if len(row) > 1 else None
        number += 1


def html_table_rows(pages, html="html", separator="", button=None, total=None):
    """One row per well-formed row of each page's largest table.

    Adds ``row_no`` and ``cells``, a map from heading (spaces removed) to cell text; the
    other columns are kept.  ``separator`` joins the text nodes of a cell.  With ``button``,
    the value of a submit button that opens a cell is stored under that name.  Rows whose
    second cell reads ``total`` are dropped.
    """
    kept = [c for c in pages.columns if c != html]

    @F.pandas_udf(T.ArrayType(ROWS))
    def extract(page: pd.Series) -> pd.Series:
        return pd.Series([list(_records(p or "", separator, button)) for p in page], dtype=object)

    rows = pages.select(*kept, F.inline(extract(F.col(html))))
    if total is not None:
        rows = rows.where(F.col("second").isNull() | (F.col("second") != total))
    names = F.transform_keys("cells", lambda k, v: F.replace(k, F.lit(" "), F.lit("")))
    return rows.select(*kept, "row_no", names.alias("cells"))
