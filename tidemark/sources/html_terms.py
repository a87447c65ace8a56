"""Term-table extraction from HTML pages (SRC-9, UDF-4).

One of the two Python stages of the engine: each page is parsed inside
its task by ``mapInArrow`` with the standard-library HTML parser (pages
are independent, so the work is partitioned like the pages table). Pages are
taken from their batch one by one, and rows are handed back ``ROWS_AT_ONCE`` at a
time, whatever the number of pages in a batch.
A row whose link text contains ``Term Name`` opens a term (name = text
after the last ``:``, stripped); every following two-cell row gives an
attribute (first cell without ``:``, lower-cased) and its text plus a
trailing space; a ``Details:`` row's link is rebuilt as a URL.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_by_value

ROWS_AT_ONCE = 10_000  # attribute rows of a batch, about
SCHEMA = "page_id long, seq long, ord int, term string, attr string, value string"


class _Rows(HTMLParser):
    """Collects table rows as lists of (text, first href) cells plus the
    texts of the row's links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows = []
        self._row = None
        self._cell = None
        self._a = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self._row = {"cells": [], "links": []}
        elif tag in ("td", "th") and self._row is not None:
            self._cell = {"text": [], "href": None}
        elif tag == "a" and self._row is not None:
            self._a = []
            href = dict(attrs).get("href")
            if self._cell is not None and self._cell["href"] is None and href is not None:
                self._cell["href"] = href

    def handle_endtag(self, tag):
        if tag == "a" and self._a is not None:
            self._row["links"].append("".join(self._a))
            self._a = None
        elif tag in ("td", "th") and self._cell is not None:
            self._row["cells"].append(("".join(self._cell["text"]), self._cell["href"]))
            self._cell = None
        elif tag == "tr" and self._row is not None:
            self.rows.append(self._row)
            self._row = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell["text"].append(data)
        if self._a is not None:
            self._a.append(data)


def parse_page(page_id: int | None, html: str, details_base: str = "") -> list[tuple]:
    """Attribute rows of one page (small per-row helper)."""
    p = _Rows()
    p.feed(html or "")
    out, term, n_terms, ord_ = [], None, -1, 0
    for row in p.rows:
        opened = False
        for text in row["links"]:
            if "Term Name" in text:
                term = text.split(":")[-1].strip()
                n_terms += 1
                ord_ = 0
                opened = True
        if opened or term is None or len(row["cells"]) < 2:
            continue
        (t0, _), (t1, href) = row["cells"][0], row["cells"][1]
        label = t0.replace(":", "").lower()
        value = t1 + " "
        if href is not None and t0 == "Details:":
            detail = href.rsplit("./")[-1]
            value = f"{details_base.rstrip('/')}/{detail}" if details_base else detail
        out.append((page_id, n_terms, ord_, term, label, value))
        ord_ += 1
    return out


def extract_terms(pages: DataFrame, details_base: str = "", id_col: str = "page_id",
                  html_col: str = "html") -> DataFrame:
    """(page_id, seq, ord, term, attr, value) for every page; ``seq`` is the
    number of the term in its page."""
    ship_by_value(sys.modules[__name__])
    pairs = pages.select(F.col(id_col).cast("long"), F.col(html_col).cast("string"))
    return pairs.mapInArrow(lambda batches: term_rows(batches, details_base), SCHEMA)


def term_rows(batches: Iterator[pa.RecordBatch], details_base: str = "") -> Iterator[pa.RecordBatch]:
    """Attribute rows of batches of (page_id, html), in batches of about ``ROWS_AT_ONCE``."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
    names, rows = ["page_id", "seq", "ord", "term", "attr", "value"], []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        for page_id, html in zip(*batch.columns):
            rows.extend(parse_page(page_id.as_py(), html.as_py(), details_base))
            if len(rows) >= ROWS_AT_ONCE:
                yield packed()
                rows = []
    if rows:
        yield packed()
