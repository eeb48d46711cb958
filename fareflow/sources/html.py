"""HTML table/list rows from a table of pages (A17): each row element
becomes one output row with its cells as stripped text.  List rows are native;
table rows come from a Python table function, as spans need a parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

LINK_ROW = r'<li><a href="([^"]*)">(.*?)</a></li>'


def strip_tags(c) -> F.Column:
    return F.trim(F.regexp_replace(c, r"<[^>]+>", ""))


def link_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page_id, pos, href, text)`` for every ``<li><a href>`` item."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(LINK_ROW), 1)
    texts = F.regexp_extract_all(F.col(html_col), F.lit(LINK_ROW), 2)
    z = pages.select(id_col, F.arrays_zip(hrefs.alias("href"), texts.alias("text")).alias("z"))
    return z.select(id_col, F.posexplode("z").alias("pos", "r")).select(
        id_col, "pos", F.col("r.href").alias("href"), strip_tags(F.col("r.text")).alias("text"))


class _Tables(HTMLParser):
    """Rows of all tables of a page, (table, row, cells); cells that span
    columns or rows stand in each place that they cover.  A table inside a cell
    is a table of its own and no text of that cell."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, list[str]]] = []
        self.open: list[dict] = []
        self.count = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.open.append({"no": self.count, "row": -1, "cells": None, "text": None, "over": {}})
            self.count += 1
        elif self.open and tag == "tr":
            self._end_row()
            self.open[-1] |= {"cells": [], "row": self.open[-1]["row"] + 1}
        elif self.open and tag in ("td", "th") and self.open[-1]["cells"] is not None:
            self._end_cell()
            size = {k: int(v) if (v or "").isdigit() else 1 for k, v in attrs if k in ("colspan", "rowspan")}
            self.open[-1] |= {"text": [], "span": (max(1, size.get("colspan", 1)), max(1, size.get("rowspan", 1)))}

    def handle_endtag(self, tag: str) -> None:
        if not self.open:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag == "table":
            self._end_row()
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1]["text"] is not None:
            self.open[-1]["text"].append(data)

    def close(self) -> None:
        super().close()
        while self.open:
            self.handle_endtag("table")

    def _covered(self, t: dict) -> None:
        """Places of the row that cells of rows above cover."""
        while (left := t["over"].get(len(t["cells"]))) is not None:
            text, rows = left
            t["over"].pop(len(t["cells"])) if rows == 1 else t["over"].update({len(t["cells"]): (text, rows - 1)})
            t["cells"].append(text)

    def _end_cell(self) -> None:
        t = self.open[-1]
        if t["text"] is None:
            return
        text, (columns, rows) = " ".join("".join(t["text"]).split()), t["span"]
        t["text"] = None
        self._covered(t)
        for _ in range(min(columns, 1000)):
            if rows > 1:
                t.setdefault("new", {})[len(t["cells"])] = (text, rows - 1)
            t["cells"].append(text)

    def _end_row(self) -> None:
        t = self.open[-1]
        self._end_cell()
        if t["cells"] is None:
            return
        self._covered(t)
        self.rows.append((t["no"], t["row"], t["cells"]))
        t["over"] |= t.pop("new", {})
        t["cells"] = None


@udtf(returnType="table int, row int, cells array<string>")
class TableRows:
    """Table function: the rows of all tables of a page."""

    def eval(self, html: str | None) -> Iterator[tuple[int, int, list[str]]]:
        parser = _Tables()
        parser.feed(html or "")
        parser.close()
        yield from parser.rows


def table_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page_id, table, row, cells array<string>)`` for every ``<tr>`` (the
    original holiday-table scrape): character references decoded, white space
    as one blank, spanning cells repeated where they stand (a span of columns
    up to HTML's own limit of 1000).  Missing end tags close with the next row
    or cell; a null or tableless page has no rows."""
    return pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html")) \
        .lateralJoin(TableRows(F.col("_html").outer())).select(F.col("_id").alias(id_col), "table", "row", "cells")
