"""Tables inside HTML pages as rows."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

# tags written plainly: no attributes, or quoted ones that hold no brackets
PLAIN = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9-]*="[^"<>]*")*[ \t\n\r\f]*)>""")
# elements whose content is no markup
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
CELLS = pa.list_(pa.string())
ROWS = "table_no int, row_no int, is_header boolean, cells array<string>"


class _Tables(HTMLParser):
    """Collects (table, row, header?, cells) of a page; cells hold their text with spaces collapsed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.open, self.count = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"no": self.count, "row": -1, "cells": None, "text": None, "heads": 0})
            self.count += 1
        elif self.open:
            t = self.open[-1]
            if tag == "tr":
                self.flush(t)
                t.update(row=t["row"] + 1, cells=[], heads=0)
            elif tag in ("td", "th") and t["cells"] is not None:
                self.close_cell(t)
                t["text"] = []
                t["heads"] += tag == "th"

    def handle_endtag(self, tag):
        if not self.open:
            return
        t = self.open[-1]
        if tag in ("td", "th"):
            self.close_cell(t)
        elif tag == "tr":
            self.flush(t)
        elif tag == "table":
            self.flush(t)
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["text"] is not None:
            self.open[-1]["text"].append(data)

    def close_cell(self, t):
        if t["text"] is not None:
            t["cells"].append(" ".join("".join(t["text"]).split()))
            t["text"] = None

    def flush(self, t):
        self.close_cell(t)
        if t["cells"]:
            self.rows.append((t["no"], t["row"], t["heads"] == len(t["cells"]), t["cells"]))
        t["cells"] = None


def _rows(text: str) -> list[tuple]:
    """The rows of a page; where all of its brackets are plain tags, without the parser's search for other markup."""
    page = _Tables()
    parts = PLAIN.split(text)
    tags = {t.lower() for t in set(parts[2::4])}
    plain = text.count("<") == len(parts) // 4 and tags.isdisjoint(RAW) and not any(slash and rest.strip() for slash, rest in zip(parts[1::4], parts[3::4]))
    if not plain:
        page.feed(text)
        page.close()
        return page.rows
    for slash, tag, data in zip(parts[1::4], parts[2::4], parts[4::4]):
        if slash:
            page.handle_endtag(tag.lower())
        else:
            page.handle_starttag(tag.lower(), None)
        if data:
            page.handle_data(unescape(data) if "&" in data else data)
    return page.rows


def html_tables(df: DataFrame, key: str, html: str) -> DataFrame:
    """One row per table row of each page: key, table and row number, whether all cells are headings, cell texts."""
    kind = df.schema[key].dataType

    def parse(batches):
        for batch in batches:
            pages = [_rows(text or "") for text in batch.column(1).to_pylist()]
            rows = [row for page in pages for row in page]
            at = pa.array([i for i, page in enumerate(pages) for _ in page], pa.int64())
            number, row, head, cells = zip(*rows) if rows else ((), (), (), ())
            made = [pa.array(number, pa.int32()), pa.array(row, pa.int32()), pa.array(head, pa.bool_()), pa.array(cells, CELLS)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at).cast(to_arrow_type(kind)), *made], [key, "table_no", "row_no", "is_header", "cells"])

    return df.select(key, html).mapInArrow(parse, f"`{key}` {kind.simpleString()}, {ROWS}")
