"""Tables in raw pages: ``(page_id, html)`` in, one row of cell texts per table row out."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.numeric import strip_thousands
from statloom.functions.text import strip
from statloom.storage import materialize

COMMENT = r"(?s)<!--(.*?)-->"
ROWS = "page_id bigint, row_ord int, cells array<string>"
NAMED_ROWS = "page_id bigint, row_ord int, names array<string>, cells array<string>"
BREAKS = {"br", "div", "p", "li", "ul"}
#: Rows that a task gathers before it hands them on.
FLUSH_ROWS = 5_000


class _RowReader(HTMLParser):
    """Collects the rows of the first element that has the wanted attribute value."""

    def __init__(self, attribute: str, value: str, cell_tags: tuple[str, ...], keep_lines: bool):
        super().__init__(convert_charrefs=True)
        self.attribute, self.value = attribute, value
        self.cell_tags, self.keep_lines = cell_tags, keep_lines
        self.rows: list[list[str]] = []
        self.element = ""
        self.depth = 0
        self.done = False
        self.text: list[str] | None = None
        self.span = (1, 1)
        self.below: dict[int, tuple[str, int]] = {}  # column -> cell that reaches down, rows left
        self.fresh: dict[int, tuple[str, int]] = {}  # the same, from the row being read

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        given = dict(attrs)
        if not self.depth:
            # an id is one value, a class attribute a list of them
            held = (given.get(self.attribute) or "").split()
            wanted = self.value in held and (self.attribute != "id" or tag == "table")
            if wanted:
                self.element, self.depth = tag, 1
            return
        if tag == self.element:
            self.depth += 1
        if tag == "tr":
            self._close_row()
            self.rows.append([])
        elif tag in self.cell_tags and self.rows:
            self._close_cell()
            self.text = []
            self.span = tuple(_span(given.get(name)) for name in ("colspan", "rowspan"))
        elif tag in BREAKS and self.text is not None:
            self.text.append("\n")

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag in self.cell_tags or tag == "tr":
            self._close_cell()
        elif tag in BREAKS and self.text is not None:
            self.text.append("\n")
        if tag == self.element:
            self.depth -= 1
            if not self.depth:
                self.finish()
                self.done = True

    def handle_data(self, data):
        if self.text is not None:
            # line ends of the source are plain spaces; only tags break lines
            self.text.append(" ".join(data.splitlines()) if "\n" in data else data)

    def _close_cell(self):
        if self.text is None:
            return
        lines = [" ".join(line.split()) for line in "".join(self.text).split("\n")]
        lines = [line for line in lines if line]
        text = "\n".join(lines) if self.keep_lines else " ".join(lines)
        self.text = None
        if self.keep_lines:
            self.rows[-1].append(text)
            return
        across, down = self.span
        for _ in range(across):
            self._carry_down()
            if down > 1:
                self.fresh[len(self.rows[-1])] = (text, down - 1)
            self.rows[-1].append(text)

    def _carry_down(self):
        """Puts in the cells of rows above that reach into the next columns of this row."""
        row = self.rows[-1]
        while len(row) in self.below:
            row.append(self.below[len(row)][0])

    def _close_row(self):
        self._close_cell()
        if self.rows and self.rows[-1]:
            self._carry_down()
        if self.rows:
            self.below = {c: (t, n - 1) for c, (t, n) in self.below.items() if n > 1} | self.fresh
        self.fresh = {}

    def finish(self):
        self._close_row()


def _span(given: str | None) -> int:
    return max(1, int(given)) if given and given.isdigit() else 1


def _rows(html: str, attribute: str, value: str, cell_tags: tuple[str, ...], keep_lines: bool):
    reader = _RowReader(attribute, value, cell_tags, keep_lines)
    reader.feed(html)
    reader.close()
    if not reader.done:
        reader.finish()
    return reader.depth > 0 or reader.done, reader.rows


def comments(html: Column) -> Column:
    """Bodies of all comments of a page, in page order."""
    return F.regexp_extract_all(html, F.lit(COMMENT), 1)


def _frames(rows: Iterator[tuple], schema: str) -> Iterator[pd.DataFrame]:
    """Rows in frames of bounded size."""
    names, held = [c.split()[0] for c in schema.split(", ")], []
    for row in rows:
        held.append(row)
        if len(held) >= FLUSH_ROWS:
            yield pd.DataFrame(held, columns=names)
            held = []
    yield pd.DataFrame(held, columns=names)


def commented_table_rows(pages: DataFrame, table_id: str) -> DataFrame:
    """Rows of ``<table id=...>`` inside the comments of each page, with the column names of its page.

    Per page the first comment that mentions the id and holds the table counts. Header cells and
    data cells both appear; a cell that spans columns or rows is repeated in all of them. The names
    come from row 0 of the page's own table; columns beyond it are named by position. Only comments
    that mention the id leave the JVM.
    """
    mentioned = F.filter(comments(F.col("html")), lambda c: c.contains(table_id))
    wanted = pages.select("page_id", mentioned.alias("bodies")).filter(F.size("bodies") > 0)

    def of_page(page_id: int, bodies: list[str]) -> Iterator[tuple]:
        for body in bodies:
            found, rows = _rows(body, "id", table_id, ("td", "th"), False)
            if found:
                if not rows:
                    return
                width = max(map(len, rows))
                names = header_names(rows[0] + [""] * (width - len(rows[0])))
                yield from ((page_id, i, names, row) for i, row in enumerate(rows) if row)
                return

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = zip(batch["page_id"], batch["bodies"], strict=True)
            yield from _frames((r for p in pairs for r in of_page(*p)), NAMED_ROWS)

    return wanted.mapInPandas(read, NAMED_ROWS)


def class_table_rows(pages: DataFrame, css_class: str, min_cells: int = 2) -> DataFrame:
    """Data-cell rows of the first element with a CSS class on each page.

    Lines inside a cell are kept apart by newlines. Rows with fewer than ``min_cells`` are dropped.
    """
    wanted = pages.filter(F.col("html").contains(css_class)).select("page_id", "html")

    def of_page(page_id: int, html: str) -> Iterator[tuple]:
        _, rows = _rows(html, "class", css_class, ("td",), True)
        yield from ((page_id, i, row) for i, row in enumerate(rows))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = zip(batch["page_id"], batch["html"], strict=True)
            yield from _frames((r for p in pairs for r in of_page(*p)), ROWS)

    return wanted.mapInPandas(read, ROWS).filter(F.size("cells") >= min_cells)


def header_names(cells: list[str]) -> list[str]:
    """Column names of a header row: blanks by position, repeats numbered ``.1``, ``.2``, ..."""
    names: list[str] = []
    seen: dict[str, int] = {}
    for i, cell in enumerate(cells):
        base = cell or f"Unnamed: {i}"
        count = seen.get(base, 0)
        seen[base] = count + 1
        names.append(f"{base}.{count}" if count else base)
    return names


def table_columns(rows: DataFrame) -> list[str]:
    """Column names of all pages' tables, in the order of the first page that has each."""
    named = rows.filter("row_ord = 0").select("page_id", F.posexplode("names").alias("pos", "name"))
    firsts = named.groupBy("name").agg(F.min(F.struct("page_id", "pos")).alias("first"))
    return [r["name"] for r in firsts.orderBy("first").collect()]  # the columns of one table


def commented_table(
    pages: DataFrame, table_id: str, header: list[str] | None = None
) -> DataFrame | None:
    """A commented table as named text columns plus the order columns ``page_id, row_ord``.

    Row 0 of each page is the header of that page's rows: pages may have their columns in different
    orders, and a column that a page lacks is NULL there. ``header`` holds the cells of the columns
    to read, by default all columns of all pages: then the pages are parsed once into a written
    table. Later header lines stay as data, as numbers they do not parse. None when no page has it.
    """
    rows = commented_table_rows(pages, table_id)
    if header is None:
        rows = materialize(rows, "table-rows")
        names = table_columns(rows)
        if not names:
            return None
    else:
        names = header_names(header)
    columns = [_cell(name).alias(name) for name in names]
    return rows.filter("row_ord > 0").select("page_id", "row_ord", *columns)


def _cell(name: str) -> Column:
    place = F.array_position("names", F.lit(name)).cast("int")
    text = strip(F.get("cells", place - 1))
    return strip_thousands(F.when(text != "", text))


class _LinkReader(HTMLParser):
    """Texts of the links inside the first element with a class."""

    def __init__(self, css_class: str):
        super().__init__(convert_charrefs=True)
        self.css_class = css_class
        self.element, self.depth, self.done = "", 0, False
        self.texts: list[str] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if not self.depth:
            if self.css_class in (dict(attrs).get("class") or "").split():
                self.element, self.depth = tag, 1
            return
        self.depth += tag == self.element
        if tag == "a":
            self.texts.append("")
            self.inside = True

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag == "a":
            self.inside = False
        if tag == self.element:
            self.depth -= 1
            self.done = not self.depth

    def handle_data(self, data):
        if self.inside and not self.done:
            self.texts[-1] += data


def _link_texts(html: str | None, css_class: str) -> list[str] | None:
    reader = _LinkReader(css_class)
    reader.feed(html or "")
    reader.close()
    return reader.texts if reader.depth or reader.done else None


def page_numbers(pages: DataFrame, default: int = 22, css_class: str = "pagination") -> DataFrame:
    """``(page_id, pages)``: the largest whole number among the links of each page's pagination.

    Only links inside the first element with the class count, with all of their text; links without
    a whole number count as page 1. A page without the element has the default.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for html in batch["html"]:
                texts = _link_texts(html, css_class)
                numbers = [int(t) for t in texts or () if t.strip().isdecimal()]
                found.append(default if texts is None else max([1, *numbers]))
            yield pd.DataFrame({"page_id": batch["page_id"], "pages": found})

    return pages.select("page_id", "html").mapInPandas(read, "page_id bigint, pages bigint")


def max_page(pages: DataFrame, default: int = 22) -> DataFrame:
    """``(pages)`` as the pagination of the first page tells; the default without any page."""
    first = pages.agg(F.min("page_id")).first()[0]
    known = page_numbers(pages.filter(F.col("page_id") == F.lit(first)), default)
    return known.agg(F.coalesce(F.max("pages"), F.lit(default)).cast("bigint").alias("pages"))
