"""Results-table extraction from HTML pages.

Only the parser runs in Python (``mapInPandas`` over Arrow batches of
``(page_id, html)``); it emits a page's headers and rows of texts, and the
wide rows are native Spark, with one shuffle for pages that share an id.
Rules: headers are the ``thead th`` texts; body rows are ``tbody tr``; a
short row yields '' for the missing cells; a header containing "driver"
(case-insensitive) has its cells cleaned like driver names; duplicate
headers collapse to the last cell.
"""

from __future__ import annotations

import html.parser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions.scalars import clean_driver_name
from pitwall.session import ensure_python_package

PAGE_SCHEMA = "page_id long, headers array<string>, rows array<array<string>>"


class _TableParser(html.parser.HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.headers, self.rows = [], []
        self._in_thead = self._in_tbody = False
        self._cell = None
        self._row = None

    def handle_starttag(self, tag, attrs):
        if tag == "thead":
            self._in_thead = True
        elif tag == "tbody":
            self._in_tbody = True
        elif tag == "tr" and self._in_tbody:
            self._row = []
        elif tag in ("th", "td"):
            self._cell = []

    def handle_endtag(self, tag):
        if tag == "thead":
            self._in_thead = False
        elif tag == "tbody":
            self._in_tbody = False
        elif tag == "tr" and self._in_tbody and self._row is not None:
            self.rows.append(self._row)
            self._row = None
        elif tag in ("th", "td") and self._cell is not None:
            text = "".join(self._cell).strip()
            if tag == "th" and self._in_thead:
                self.headers.append(text)
            elif self._row is not None:
                self._row.append(text)
            self._cell = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


def _parse(batches):
    for pdf in batches:
        out = []
        for pid, doc in zip(pdf["page_id"], pdf["html"]):
            p = _TableParser()
            p.feed(doc or "")
            out.append((int(pid), p.headers, p.rows))
        yield pd.DataFrame(out, columns=["page_id", "headers", "rows"])


def extract_pages(pages: DataFrame) -> DataFrame:
    ensure_python_package(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), "html").mapInPandas(_parse, PAGE_SCHEMA)


def extract_tables(pages: DataFrame, headers: list[str]) -> DataFrame:
    """Wide rows ``(page_id, row, *headers)`` with the driver-cleaning rule."""
    rows = extract_pages(pages).where(F.size("headers") > 0).select(
        "page_id", "headers", F.posexplode("rows").alias("row", "_cells"))
    found = []
    for i, h in enumerate(headers):
        # duplicate headers collapse: the last column with that header wins
        at = F.size("headers") + 1 - F.array_position(F.reverse("headers"), h)
        text = F.coalesce(F.get("_cells", (at - 1).cast("int")), F.lit(""))
        if "driver" in h.lower():
            text = clean_driver_name(text)
        found += [F.when(F.array_contains("headers", h), at).alias(f"_at{i}"),
                  F.when(F.array_contains("headers", h), text).alias(f"_t{i}")]
    return rows.select("page_id", "row", *found).groupBy("page_id", "row").agg(*[
        F.max_by(f"_t{i}", f"_at{i}").alias(h) for i, h in enumerate(headers)])


def table_html(rows: DataFrame, page_id_col: str, order_col: str, headers: list[str]) -> DataFrame:
    """Render one HTML results table per page from long rows (test fixture
    builder; one page = one race grid, a bounded group)."""
    th = "".join(f"<th>{h}</th>" for h in headers)
    tr = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.coalesce(F.col(f"`{h}`").cast("string"), F.lit("")),
                                            F.lit("</td>")) for h in headers], F.lit("</tr>"))
    body = rows.groupBy(page_id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), tr.alias("t")))),
                                 lambda s: s["t"]), "").alias("_b"))
    return body.select(F.col(page_id_col).alias("page_id"),
                       F.concat(F.lit(f"<html><body><table><thead><tr>{th}</tr></thead><tbody>"), F.col("_b"),
                                F.lit("</tbody></table></body></html>")).alias("html"))
