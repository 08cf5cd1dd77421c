"""Small helper that takes the tables of one page apart with the standard library's HTML tokenizer."""

from __future__ import annotations

import re
from html.parser import HTMLParser

#: The bounds that the HTML standard sets on spans.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
#: What one page may ask for: cells with their spans spread out, and tables within tables.
MOST_CELLS, MOST_DEEP = 2_000_000, 256
CELL_SPACE = re.compile(r"[\r\n]+|\s{2,}")
SPAN = re.compile(r"[\t\n\f\r ]*\+?(\d+)")
HIDDEN = ("script", "style", "template")


def span(attrs: dict[str, str | None], name: str, most: int) -> int:
    """A span as the standard reads it: leading digits, 1 without any, bounded; 0 rows reach to the end."""
    found = SPAN.match(attrs.get(name) or "")
    if not found:
        return 1
    digits = found[1].lstrip("0")
    value = most if len(digits) > 6 else min(int(digits or 0), most)
    return value or (most if name == "rowspan" else 1)


class TooMuch(Exception):
    """A page asks for more than its bounds."""


class _Table:
    def __init__(self):
        self.rows: list[list] = []  # [in thead, [(is th, text, columns, rows)]]
        self.cell: list | None = None  # [is th, texts, columns, rows]
        self.open_row = self.thead = False

    def end_cell(self):
        if self.cell:
            is_th, texts, columns, rows = self.cell
            text = CELL_SPACE.sub(" ", "".join(texts).strip())
            self.rows[-1][1].append((is_th, text, columns, rows))
            self.cell = None

    def end_row(self):
        self.end_cell()
        self.open_row = False


class Tables(HTMLParser):
    """All tables of a page in the order of their start tags; nested ones are tables of their own.

    End tags of rows and cells may be missing. The text of a nested table is part of the cell that holds it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self.open: list[_Table] = []
        self.hidden = ""

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            return
        if tag in HIDDEN:
            self.hidden = tag
        elif tag == "table":
            if len(self.open) == MOST_DEEP:
                raise TooMuch("tables too deep")
            self.tables.append(_Table())
            self.open.append(self.tables[-1])
        elif tag == "br":
            self.handle_data("\n")
        elif self.open:
            table = self.open[-1]
            if tag == "tr":
                table.end_row()
                table.rows.append([table.thead, []])
                table.open_row = True
            elif tag in ("td", "th"):
                if not table.open_row:
                    self.handle_starttag("tr", [])
                table.end_cell()
                given = dict(reversed(attrs))  # of a repeated attribute the first counts
                table.cell = [tag == "th", [], span(given, "colspan", MOST_COLUMNS), span(given, "rowspan", MOST_ROWS)]
            elif tag in ("thead", "tbody", "tfoot"):
                table.end_row()
                table.thead = tag == "thead"

    def parse_html_declaration(self, i):
        """HTML knows no marked sections: as the standard says, what looks like one is a comment."""
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML knows no self-closing cells

    def handle_endtag(self, tag):
        if self.hidden:
            self.hidden = "" if tag == self.hidden else self.hidden
        elif self.open:
            table = self.open[-1]
            if tag == "table":
                table.end_row()
                self.open.pop()
            elif tag in ("tr", "thead", "tbody", "tfoot"):
                table.end_row()
                table.thead &= tag == "tr"
            elif tag in ("td", "th"):
                table.end_cell()

    def handle_data(self, data):
        if not self.hidden:
            for table in self.open:
                if table.cell:
                    table.cell[1].append(data)


def _filled(rows: list[list], room: int) -> list[list[str]]:
    """Texts of each row with spans spread out to the right and downwards, ``room`` cells at most."""
    out, held = [], {}  # held: column -> (text, rows left)
    for _, cells in rows:
        row, below = [], {}

        def put(text, left, row=row, below=below):
            if left > 1:
                below[len(row)] = (text, left - 1)
            row.append(text)

        for _, text, columns, deep in cells:
            while len(row) in held:
                put(*held.pop(len(row)))
            for _ in range(columns):
                put(text, deep)
        for column in sorted(held):
            if column >= len(row):
                put(*held[column])
        held = below
        out.append(row)
        room -= len(row)
        if room < 0:
            raise TooMuch("too many cells")
    return out


def page_tables(html: str | None) -> list[list[dict]] | None:
    """``[[{head, cells}, ..], ..]`` of a page; NULL for NULL. Rows in a thead are header rows; without
    a thead, the leading rows of only th cells are."""
    if html is None:
        return None
    parser = Tables()
    parser.feed(html)
    parser.close()
    for table in reversed(parser.open):
        table.end_row()
    out, room = [], MOST_CELLS
    for table in parser.tables:
        heads = [thead for thead, _ in table.rows]
        if not any(heads):
            lead = True
            for i, (_, cells) in enumerate(table.rows):
                lead = lead and all(c[0] for c in cells)
                heads[i] = lead
        texts = _filled(table.rows, room)
        room -= sum(map(len, texts))
        out.append([{"head": h, "cells": t} for h, t in zip(heads, texts, strict=True)])
    return out


def read_page(html: str | None) -> dict:
    """``{reason, tables}``: a page's tables, or why it is set aside; nothing in a page stops the others."""
    try:
        return {"reason": None, "tables": page_tables(html)}
    except TooMuch as bound:
        return {"reason": str(bound), "tables": None}
    except Exception as fault:  # whatever the tokenizer stumbles on
        return {"reason": f"unreadable: {type(fault).__name__}", "tables": None}
