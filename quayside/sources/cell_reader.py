"""Cells of a grid by a pattern, and the parser for pages that patterns cannot cut.

Runs in Python workers. They need not have this package: the module travels with the job.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable
from html import escape, unescape
from html.parser import HTMLParser

import pyarrow as pa

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class _CellReader(HTMLParser):
    """Collects (row, col, text, icon) of the elements whose id is a cell of ``grid``.

    A cell lasts until its own end tag, or the end of the page; text inside it counts at
    any depth. Cells come in document order.
    """

    def __init__(self, grid: str) -> None:
        super().__init__(convert_charrefs=True)
        self.pattern = re.compile(re.escape(grid) + r"(0|[1-9][0-9]*)_(0|[1-9][0-9]*)")
        self.open: list[tuple[str, dict | None]] = []
        self.cells: list[dict] = []
        self.piece: list[str] = []

    def finish_piece(self) -> None:
        text = "".join(self.piece).strip()
        self.piece.clear()
        if text:
            for _, cell in self.open:
                if cell is not None:
                    cell["text"] += text

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.finish_piece()
        named = dict(reversed(attrs))
        if tag == "img":
            for _, cell in self.open:
                if cell is not None and cell["icon"] is None:
                    cell["icon"] = named.get("src") or ""
        match = self.pattern.fullmatch(named.get("id") or "")
        cell = None
        if match:
            cell = {"row": int(match[1]), "col": int(match[2]), "text": "", "icon": None}
            self.cells.append(cell)
        if tag not in _VOID_TAGS:
            self.open.append((tag, cell))

    def handle_endtag(self, tag: str) -> None:
        self.finish_piece()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                break

    def handle_data(self, data: str) -> None:
        self.piece.append(data)

    def handle_comment(self, data: str) -> None:
        self.finish_piece()


def read_cells(html: str, grid: str) -> list[dict]:
    reader = _CellReader(grid)
    reader.feed(html)
    reader.close()
    reader.finish_piece()
    return reader.cells


def plain_cells(html: str, grid: str) -> list[str]:
    """The cells of a page, each written the plain way: one element, icon first, no other tags."""
    return [
        f'<td id="{grid}{cell["row"]}_{cell["col"]}">'
        + ("" if cell["icon"] is None else f'<img src="{escape(cell["icon"])}">')
        + f"{escape(cell['text'], quote=False)}</td>"
        for cell in read_cells(html, grid)
    ]


# Tags as pages write them nearly always: closed, with quoted attributes in which nothing stands for anything else.
_PLAIN = r"""(?:\s+[a-zA-Z][a-zA-Z0-9-]*=(?:"[^"<>&]*"|'[^'<>&]*'))"""
_PLAIN_TAG = re.compile(rf"</?[a-zA-Z][a-zA-Z0-9]*{_PLAIN}*\s*/?>", re.ASCII)
# Comments, and elements whose content is no markup.
_NO_MARKUP = re.compile(r"<(?:[!?]|(?:script|style|textarea|title|xmp|iframe|noembed|noframes|plaintext)\b)", re.IGNORECASE)
_IMAGE = re.compile(r"<img\b", re.IGNORECASE)
_SOURCE = re.compile(r"""\ssrc=["']([^"']*)""")
_SHOWN_SOURCE = re.compile(r"""[^"'\s>]*""")
_MOST_ROW, _MOST_COL = 2**63 - 1, 2**31 - 1
# Of a batch of pages.
PAGES_AT_A_TIME = 64


def _plain_cell(grid: str) -> re.Pattern[str]:
    """A whole ``td`` named as a cell, in plain tags, with its id before its other attributes but the class."""
    number = "(0|[1-9][0-9]*)"
    return re.compile(
        rf"""<td(?: class="[^"<>&]*")? id="{re.escape(grid)}{number}_{number}"{_PLAIN}*\s*>"""
        rf"((?:[^<]|<(?!/?td\b))*)</td\s*>", re.ASCII)


def _found_cells(html: str, grid: str, cell: re.Pattern[str]) -> Iterable[tuple[int, int, str, str | None]]:
    """What ``read_cells`` finds. A page of plain tags, all of whose cells are plain ones, is cut by patterns."""
    found = cell.findall(html)
    if (
        len(found) != html.count(grid) or _NO_MARKUP.search(html) or "<TD" in html or "<Td" in html or "<tD" in html
        or len(_PLAIN_TAG.findall(html)) != html.count("<")
    ):
        for odd in read_cells(html, grid):
            yield odd["row"], odd["col"], odd["text"], odd["icon"]
        return
    for row, col, body in found:
        icon = None
        if "<" in body:
            image = _IMAGE.search(body)
            if image:
                source = _SOURCE.search(body[image.start():body.index(">", image.start())])
                icon = source[1] if source else ""
            body = "".join(unescape(piece).strip() for piece in _PLAIN_TAG.split(body))
        else:
            body = unescape(body).strip()
        yield int(row), int(col), body, icon


def _cells_of_some(pages: pa.Array, grid: str, cell: re.Pattern[str]) -> pa.Array:
    ends, rows, cols, texts, icons = [0], [], [], [], []
    for html in pages.to_pylist():
        if html is not None and grid in html:
            for row, col, text, icon in _found_cells(html, grid, cell):
                rows.append(row if row <= _MOST_ROW else None)
                cols.append(col if col <= _MOST_COL else None)
                texts.append(text)
                icons.append(icon if icon is None else _SHOWN_SOURCE.match(escape(icon))[0])
        ends.append(len(rows))
    found = pa.StructArray.from_arrays(
        [pa.array(rows, pa.int64()), pa.array(cols, pa.int32()), pa.array(texts, pa.string()), pa.array(icons, pa.string())],
        ["row", "col", "text", "icon"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)


def cells_of(pages: pa.Array, grid: str) -> pa.Array:
    """The cells of each page, a list of ``row, col, text, icon``; numbers too big for their type are NULL.

    Only ``PAGES_AT_A_TIME`` are Python objects at once: as such, pages and cells take several times what they do in Arrow.
    """
    cell = _plain_cell(grid)
    return pa.concat_arrays([
        _cells_of_some(pages.slice(at, PAGES_AT_A_TIME), grid, cell) for at in range(0, max(1, len(pages)), PAGES_AT_A_TIME)])


class _TableReader(HTMLParser):
    """Headers and rows of the first element of class ``control``; rows and cells at any depth.

    A cell or row that is not closed ends where the next one of its table begins.
    """

    def __init__(self, control: str, header: str, row: str, cell: str) -> None:
        super().__init__(convert_charrefs=True)
        self.classes = {"control": control, "header": header, "row": row, "cell": cell}
        self.open: list[tuple[str, list[tuple[str, list]]]] = []
        self.inside, self.done = False, False
        self.headers: list[list[str]] = []
        self.rows: list[list[list[str]]] = []

    def _close(self, depth: int) -> None:
        for _, roles in self.open[depth:]:
            if any(role == "control" for role, _ in roles):
                self.inside, self.done = False, True
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("td", "th", "tr"):
            ended = ("td", "th") if tag != "tr" else ("td", "th", "tr")
            for depth in range(len(self.open) - 1, -1, -1):
                if self.open[depth][0] == "table":
                    break
                if self.open[depth][0] in ended:
                    self._close(depth)
        if tag in _VOID_TAGS:
            return
        named = (dict(reversed(attrs)).get("class") or "").split()
        roles: list[tuple[str, list]] = []
        if not self.done and not self.inside and self.classes["control"] in named:
            self.inside = True
            roles.append(("control", []))
        elif self.inside:
            if self.classes["header"] in named:
                self.headers.append([])
                roles.append(("text", self.headers[-1]))
            if self.classes["row"] in named:
                self.rows.append([])
                roles.append(("row", self.rows[-1]))
            if self.classes["cell"] in named:
                text: list[str] = []
                for _, above in self.open:
                    for role, cells in above:
                        if role == "row":
                            cells.append(text)
                roles.append(("text", text))
        self.open.append((tag, roles))

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self._close(depth)
                break

    def handle_data(self, data: str) -> None:
        for _, roles in self.open:
            for role, text in roles:
                if role == "text":
                    text.append(data)


def read_table(html: str, control: str, header: str, row: str, cell: str) -> tuple[list[str], list[list[str]]]:
    """Shown texts of the headers, and of the cells of each row."""
    reader = _TableReader(control, header, row, cell)
    reader.feed(html)
    reader.close()

    def shown(text: list[str]) -> str:
        return " ".join("".join(text).split())

    return [shown(x) for x in reader.headers], [[shown(x) for x in cells] for cells in reader.rows]
