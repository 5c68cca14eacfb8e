"""Tables and single elements of HTML pages as rows.

Pages are dealt to tasks by a hash, since a file of few row groups (or short rows that pages are made of) would
leave all of them to a few; a page is worked on by itself, in Arrow batches of a bounded number of bytes. Pages
without the wanted tag never leave the JVM and take no part in the shuffle.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import bound_batches
from starloom.sources.markup import scan

# Tasks get these functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


def _has_class(attributes: str, name: str | None) -> bool:
    if name is None:
        return True
    found = _CLASS.search(attributes)
    return bool(found) and name in next(filter(None, found.groups()), "").split()


# Start tags that end an open element of these kinds, if no element of the second kind was opened since.
_CLOSES = {
    "li": (("li",), ("ul", "ol")), "p": (("p",), ()), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)),
    "option": (("option",), ("select",)),
    **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "div", "table", "dl", "blockquote", "pre", "form",
                     "section", "article", "header", "footer"), (("p",), ())),
}
_BOUNDS = frozenset(bound for _, bounds in _CLOSES.values() for bound in bounds)


def _elements(page: str, tags: frozenset, css_class: str | None) -> Iterator[tuple[str, int, str]]:
    """``(tag, number, text)`` of the wanted elements.

    One runs to its end tag, to a start tag that ends it, to the end of an element
    around it, or to the end of the page. The text of a page is kept once: an
    element notes where its own begins and ends.
    """
    parts: list[str] = []
    length = 0
    found: list[list] = []  # tag or nothing, begin, end
    opened: list[tuple[str, int]] = []  # wanted elements and those that bound them

    # Of each kind, where its open elements stand in ``opened``: the last one is found at once, however deep a page is.
    places: dict[str, list[int]] = {name: [] for name in tags | _BOUNDS}

    def close(at: int) -> None:
        for name, i in opened[at:]:
            places[name].pop()
            if i >= 0:
                found[i][2] = length
        del opened[at:]

    def last(names: Iterable[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    for text, tag, is_end, attributes in scan(page):
        parts.append(text)
        length += len(text)
        if is_end:
            if places.get(tag):
                close(places[tag][-1])
            continue
        if tag in _CLOSES:
            ends, bounds = _CLOSES[tag]
            ended = last(ends)
            if ended > last(n for n in bounds if n not in ends):
                close(ended)
        if tag in places:
            places[tag].append(len(opened))
            opened.append((tag, len(found) if tag in tags else -1))
        if tag in tags:
            found.append([tag if _has_class(attributes, css_class) else "", length, length])
    close(0)
    whole = "".join(parts)
    number = dict.fromkeys(tags, -1)
    for tag, begin, end in found:  # one by one, since an element's text holds that of all within
        if tag:
            number[tag] += 1
            yield tag, number[tag], whole[begin:end].strip()


_SPAN = {name: re.compile(rf"""\b{name}\s*=\s*["']?\s*(\d+)""", re.IGNORECASE) for name in ("rowspan", "colspan")}
_WIDEST, _TO_THE_END = 1000, 1 << 30  # fixed values of the standard: columns of a cell; a row span of 0


def _span(attributes: str, name: str) -> int:
    found = _SPAN[name].search(attributes) if name in attributes.lower() else None
    if found is None:
        return 1
    n = int(found[1][:9])
    return min(max(n, 1), _WIDEST) if name == "colspan" else n or _TO_THE_END


class _Grid:
    """The rows of a table as a grid: a cell takes the places that its spans give it, and others go beside them."""

    def __init__(self):
        self.below: dict[int, tuple[str, int]] = {}  # by column, what comes down from above, and for how many rows
        self.start()

    def start(self) -> None:
        self.row: list = []  # the parts of a cell's text, or its text if it is done
        self.text: list[str] | None = None  # of the cell that is open
        self.own: list[tuple[int, list[str], int, int]] = []

    def _carry(self) -> None:
        while len(self.row) in self.below:
            self.row.append(self.below[len(self.row)][0])

    def cell(self, rows: int, columns: int) -> None:
        self._carry()
        self.text = []
        self.own.append((len(self.row), self.text, rows, columns))
        self.row += [self.text, *[""] * (columns - 1)]  # the text stands in the first of its columns

    def end(self) -> list[str] | None:
        """The finished row; None if it has no cell of its own."""
        while any(at >= len(self.row) for at in self.below):
            self._carry()
            if any(at >= len(self.row) for at in self.below):
                self.row.append("")
        found = [x if isinstance(x, str) else "".join(x).strip() for x in self.row]
        self.below = {at: (text, n - 1) for at, (text, n) in self.below.items() if n > 1}
        for at, _, rows, columns in self.own:
            if rows > 1:
                self.below.update({at + i: (found[at + i], rows - 1) for i in range(columns)})
        own = bool(self.own)
        self.start()
        return found if own else None


def _table_rows(page: str, css_class: str | None, caption: tuple[str, str] | None) -> list[tuple]:
    """``(caption, table, row, cells, header)`` of the body rows of the tables of a class.

    Rows end where the next one starts if they lack an end tag. A table inside
    of a cell counts as text of the cell. A cell of several rows is in each of
    them; one of several columns has its text in the first and '' in the others.
    """
    rows, captions = [], []
    depth, table, row = 0, -1, -1
    wanted = in_body = in_caption = bold = in_row = False
    grid = _Grid()

    def end_row():
        nonlocal row, in_row
        cells = grid.end() if in_row else None
        if cells:
            row += 1
            rows.append((table, row, cells, bold))
        in_row = False

    for text, tag, is_end, attributes in scan(page):
        if text:
            if in_caption:
                captions[-1].append(text)
            if grid.text is not None:
                grid.text.append(text)
        if not tag:
            continue
        if caption and tag == caption[0]:
            in_caption = not is_end and _has_class(attributes, caption[1])
            if in_caption:
                captions.append([])
        elif tag == "table":
            if is_end:
                if depth == 1:
                    end_row()
                depth = max(depth - 1, 0)
            else:
                depth += 1
                if depth == 1:
                    end_row()
                    wanted, in_body, row, grid = _has_class(attributes, css_class), True, -1, _Grid()
                    table += wanted
        elif depth == 1 and wanted:
            if tag == "tr":
                end_row()
                if in_body and not is_end:
                    in_row, bold = True, False
            elif tag in ("thead", "tbody", "tfoot"):
                end_row()
                grid = _Grid()  # spans end with their group
                in_body = tag == "tbody" or is_end
            elif in_row and not is_end:
                if tag == "td":
                    grid.cell(_span(attributes, "rowspan"), _span(attributes, "colspan"))
                elif tag == "b" and len(grid.own) == 1 and grid.own[0][0] == 0:
                    bold = True
    end_row()
    texts = ["".join(c).strip() for c in captions]
    return [(texts[t] if t < len(texts) else None, t, *rest) for t, *rest in rows]


_OUT = 4 << 20  # characters that are handed back at once


def _parsed(pages: DataFrame, key: str, html: str, tags: Iterable[str], parse, columns: str) -> DataFrame:
    """Key and the rows ``parse`` finds in each page that can hold one of the tags."""
    names = [key, *(column.split()[0] for column in columns.split(", "))]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, size = [], 0
            for ident, page in zip(batch[key], batch[html], strict=True):
                for row in parse(page):
                    found.append((ident, *row))
                    size += sum(len(x) if isinstance(x, str) else sum(map(len, x)) for x in row if isinstance(x, (str, list)))
                    if size > _OUT:  # a text that spans many rows is in all of them
                        yield pd.DataFrame(found, columns=names)
                        found, size = [], 0
            yield pd.DataFrame(found, columns=names)

    bound_batches(pages.sparkSession)
    kind = pages.schema[key].dataType.simpleString()
    candidates = pages.select(key, html).where(F.col(html).rlike(f"(?i)<({'|'.join(sorted(tags))})"))
    # Pages shrink well, so their bytes in the shuffle are no measure of the work: a number of tasks, not merged by AQE.
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = candidates.repartition(tasks, F.xxhash64(*(F.col(f"`{c}`") for c in candidates.columns)))
    return dealt.mapInPandas(rows, f"`{key}` {kind}, {columns}")


def html_rows(
    pages: DataFrame, key: str, html: str, css_class: str | None = None, caption: tuple[str, str] | None = None
) -> DataFrame:
    """One row per body row of each table of a class.

    Columns: key, ``caption``, ``table_no``, ``row_no``, ``cells``, ``is_header``.
    A row is a header if its first cell holds bold text; numbers count from 0.
    ``caption`` is (tag, class) of the elements that name the tables of a page.
    """
    return _parsed(
        pages, key, html, ["table"], lambda page: _table_rows(page, css_class, caption),
        "caption string, table_no int, row_no int, cells array<string>, is_header boolean",
    )


def html_elements(
    pages: DataFrame, key: str, html: str, tags: Sequence[str], css_class: str | None = None
) -> DataFrame:
    """One row per element with one of ``tags``: key, ``tag``, ``element_no`` (from 0 per page and tag), ``text``."""
    wanted = frozenset(tags)
    return _parsed(
        pages, key, html, wanted, lambda page: _elements(page, wanted, css_class),
        "tag string, element_no int, text string",
    )
