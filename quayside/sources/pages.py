"""Cells, rows and links out of scraped pages.

``pages`` has ``crawl_id, page_no, url, html``. Pages of one crawl read as one document in
page order. Cells of grids are cut in Arrow batches, by a pattern where a page is plain, else by a parser.
Tables with headers are cut by column expressions; a page on which those could
go wrong (a cell with another of the same tag inside, an open cell, a rare entity) is
recognised, and only such a page is given to the parser.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.prefix import contiguous_prefix
from quayside.schemas import EVENT_TITLES, MILE_TITLES, STATUS_TITLES
from quayside.sources.cell_reader import cells_of, read_table

# Ids and classes on the pages, icons and the flags they stand for.
STATUS_GRID = "ASPx_船舶即時動態_tccell"
EVENT_GRID = "ASPx_船舶事件_tccell"
MILE_GRID = "ASPx_港外船舶進港_tccell"
MILE_COLUMNS = (2, 3)
CONTROL_CLASS = "dxgvControl_PlasticBlue"
HEADER_CLASS = "dxgvHeader_PlasticBlue"
ROW_CLASS = "dxgvDataRow_PlasticBlue"
CELL_CLASS = "dxgv"
ICON_FLAGS = (("ok.png", "YES"), ("red.gif", "RED"))
EMPTY_FLAG = "NO"
MISSING = "null"

# Bytes of pages that one task cuts. Of more tasks than the second, a shuffle holds its rows in memory to sort them.
TASK_BYTES, MOST_TASKS = 8 << 20, 200

# All blanks, as a pattern and as characters.
_SPACE = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# Possessive throughout: what one of these has taken is never tried again in another way.
_ATTRIBUTES = r"""[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+"""
_TAG = rf"<(?:/?[a-zA-Z]{_ATTRIBUTES}|[!?/][^<>]*+)>"
# A tag that is not closed before the next one opens, or at all.
_BROKEN_TAG = r"<[a-zA-Z/!?][^<>]*+(?:<|$)"
_UNSEEN = r"(?s)<(?:!--.*?--|(?i:script)\b.*?</(?i:script)\s*|(?i:style)\b.*?</(?i:style)\s*)>"
_MAY_BE_UNSEEN = r"<(?:!--|[sS][cCtT])"
# What stands for a removed comment: it ends a piece of text like any tag, but shows nothing.
_BREAK = "<wbr>"
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}
_RARE_ENTITY = r"&(?!(?:amp|lt|gt|quot|apos|nbsp|#39);)[#a-zA-Z]"


def page_bytes(html: Column) -> Column:
    """Bytes of all pages together, for ``spread_pages``."""
    return F.coalesce(F.sum(F.octet_length(html)), F.lit(0))


def spread_pages(pages: DataFrame, size: int) -> DataFrame:
    """The same pages, dealt to tasks by what there is to cut: about ``TASK_BYTES`` of their ``size`` bytes to each.

    Stored pages are packed many times smaller than they are, so files alone give a few tasks far too much. Equal
    pages stay together, and keys do not matter.
    """
    tasks = min(MOST_TASKS, max(1, -(-size // TASK_BYTES)))
    return pages.repartition(tasks, F.xxhash64(*(name for name in pages.columns)))


def spread_crawls(pages: DataFrame, sizes: Mapping[int, int]) -> DataFrame:
    """Pages of several crawls dealt as by ``spread_pages``, with the ``sizes`` of the crawls in bytes. A crawl has tasks
    of its own, so that written to a folder of its own it is no more files than that."""
    share = max(TASK_BYTES, -(-sum(sizes.values()) // MOST_TASKS))
    mixed, part, tasks = F.xxhash64(*(name for name in pages.columns)), F.when(F.lit(False), F.lit(0)), 0
    for crawl, size in sizes.items():
        own = max(1, -(-size // share))
        part = part.when(F.col("crawl") == crawl, F.lit(tasks) + F.pmod(mixed, F.lit(own)))
        tasks += own
    tasks = min(MOST_TASKS, max(1, tasks))
    return pages.repartitionById(tasks, F.pmod(part.otherwise(0), F.lit(tasks)).cast("int"))


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, _UNSEEN, _BREAK)


def node_text(fragment: Column) -> Column:
    """Text of a fragment: each piece between tags stripped, then joined with nothing."""
    text = F.replace(fragment, F.lit("&nbsp;"), F.lit("\u00a0"))
    text = F.regexp_replace(text, f"{_SPACE}*(?:{_TAG}){_SPACE}*", "")
    for entity, character in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    # Most cells are plain text and skip all that.
    text = F.when(fragment.contains("<") | fragment.contains("&"), text).otherwise(fragment)
    return F.btrim(text, F.lit(_BLANKS))


def shown_text(fragment: Column) -> Column:
    """Text as a browser shows it: tags gone, runs of blanks as one, ends stripped."""
    text = F.replace(F.regexp_replace(fragment, _TAG, ""), F.lit("&nbsp;"), F.lit("\u00a0"))
    for entity, character in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    text = F.when(fragment.contains("<") | fragment.contains("&"), text).otherwise(fragment)
    return F.btrim(F.regexp_replace(text, f"{_SPACE}+", " "))


def _cells(html: Column, grid: str) -> Column:
    @F.arrow_udf("array<struct<row: bigint, col: int, text: string, icon: string>>")
    def cut(pages: pa.Array) -> pa.Array:
        return cells_of(pages, grid)

    return cut(html)


def grid_cells(pages: DataFrame, grid: str) -> DataFrame:
    """``crawl_id, page_no, position, row, col, text, icon``; a page without cells gives one
    row with NULL cells, so that its crawl is not forgotten.

    A number too big for its type is NULL: it is beyond any grid, which has no gaps before it.
    """
    html = F.col("html")
    # A page that does not name the grid has no cells and is not sent to be cut.
    page = F.when(html.contains(grid), F.when(html.rlike(_MAY_BE_UNSEEN), visible(html)).otherwise(html))
    return (
        pages.select("crawl_id", "page_no", _cells(page, grid).alias("_cells"))
        .select("crawl_id", "page_no", F.posexplode_outer("_cells").alias("position", "_cell"))
        .select("crawl_id", "page_no", "position", "_cell.row", "_cell.col", "_cell.text", "_cell.icon")
    )


def flagged(text: Column, icon: Column) -> Column:
    """Cell value of the ship list: the text, then the flag of its icon; nothing at all is a flag too."""
    flag = F.lit("")
    for part, name in reversed(ICON_FLAGS):
        flag = F.when(icon.contains(part), name).otherwise(flag)
    value = F.concat(text, F.coalesce(flag, F.lit("")))
    return F.when(value == "", EMPTY_FLAG).otherwise(value)


def _first_on(column: Column, value: Column) -> Column:
    """The value of the first cell of a column: repeated ids keep their first place."""
    return F.min(F.when(column, F.struct("page_no", "position", value.alias("value"))))["value"]


def grid_rows(cells: DataFrame, names: Sequence[str], value: Column) -> DataFrame:
    """Cells put together to rows ``crawl_id, row, <names>``, up to the first incomplete row.

    One shuffle does both the choice among repeated cells and the pivot.
    """
    present = cells.filter(F.col("row").isNotNull() & (F.col("col") < len(names)))
    rows = present.groupBy("crawl_id", "row").agg(
        *(_first_on(F.col("col") == i, value).alias(name) for i, name in enumerate(names)))
    complete = F.lit(True)
    for name in names:
        complete &= F.col(name).isNotNull()
    whole = contiguous_prefix(rows.withColumn("_complete", complete), "crawl_id", "row", "_complete")
    # All of these are complete. Asked for it, each use of the rows in that plan needs every cell, so that a caller who
    # wants few columns does not have the pages cut once for these and once more for the whole rows.
    return whole.filter("_complete").drop("_complete")


def status_rows(pages: DataFrame) -> DataFrame:
    """The ship list, titles as column names; flags for icons and empty cells."""
    return grid_rows(grid_cells(pages, STATUS_GRID), STATUS_TITLES, flagged(F.col("text"), F.col("icon")))


def event_rows(pages: DataFrame) -> DataFrame:
    """A voyage's events; the time and content still as text."""
    return grid_rows(grid_cells(pages, EVENT_GRID), tuple(EVENT_TITLES.values()), F.col("text"))


def mile_rows(pages: DataFrame) -> DataFrame:
    """The two mile passages of each crawled page, ``null`` where missing or empty."""
    first_row = F.col("row") == 0
    return grid_cells(pages, MILE_GRID).groupBy("crawl_id").agg(*(
        F.coalesce(
            F.nullif(_first_on(first_row & (F.col("col") == col), F.col("text")), F.lit("")), F.lit(MISSING),
        ).alias(name)
        for col, name in zip(MILE_COLUMNS, MILE_TITLES.values(), strict=True)
    ))


def _element(tags: str, css_class: str) -> str:
    return (
        rf"""(?is)<(?:{tags})\b[^<>]*?\sclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["'][^<>]*>"""
    )


def _up_to(tag: str) -> str:
    """Pattern of all up to the first end tag of that name, as ``.*?`` before it, without a step per character."""
    return rf"[^<]*+(?:<(?!/{tag}\s*>)[^<]*+)*+"


def _read_tables(html: Column) -> Column:
    @F.pandas_udf("header array<string>, rows array<array<string>>")
    def read(pages: pd.Series) -> pd.DataFrame:
        found = [
            (None, None) if page is None else read_table(page, CONTROL_CLASS, HEADER_CLASS, ROW_CLASS, CELL_CLASS)
            for page in pages]
        return pd.DataFrame(found, columns=["header", "rows"])

    return read(html)


def _flat_tables(page: Column) -> Column:
    """Whether cells hold no tables, rows only cells and tables only rows, all of them closed."""
    tags = F.lower(F.array_join(F.regexp_extract_all(page, F.lit(r"(?i)</?t(?:able|[rdh])\b"), 0), ""))
    rest = F.replace(tags, F.lit("th"), F.lit("td"))
    for tag in ("td", "tr", "table"):
        rest = F.replace(rest, F.lit(f"<{tag}</{tag}"), F.lit(""))
    return rest == ""


def header_table_rows(pages: DataFrame, titles: dict[str, str]) -> DataFrame:
    """Rows of tables whose columns are known by their header: ``crawl_id, page_no, row`` and
    one column per entry of ``titles``.

    Only the first grid of a page counts, and a page without one has no rows. Headers pair with
    cells from the left; surplus ones on either side are dropped, a repeated header takes its last
    cell, a title without a header is NULL. As with cells, a page on which patterns could go wrong (several
    grids, tables in tables, rows after an end tag of the grid's name, rare entities, broken tags) is recognised and
    given to a parser.
    """
    control = _element("([a-z][a-z0-9]*)", CONTROL_CLASS)
    header = _element("t[hd]", HEADER_CLASS) + f"({_up_to('t[hd]')})" + r"</t[hd]\s*>"
    row = _element("tr", ROW_CLASS) + f"({_up_to('tr')})" + r"</tr\s*>"
    cell = _element("td", CELL_CLASS) + f"({_up_to('td')})" + r"</td\s*>"
    page = F.col("_page")
    # The pattern of grids looks at every tag, so it is only counted where the class is named again.
    low = F.lower(page)
    named_once = F.instr(F.substring(low, F.instr(low, CONTROL_CLASS.lower()) + 1, F.lit(2**30)), CONTROL_CLASS.lower()) == 0
    grids = F.when(named_once, page.rlike(control).cast("int")).otherwise(F.regexp_count(page, F.lit(control)))
    # What comes after the first end tag that may be the grid's own.
    after = F.regexp_extract(page, rf"{control}{_up_to(r'\1')}</\1\s*>(.*)$", 2)
    odd = (
        (F.col("_grids") > 1) | ~_flat_tables(page) | after.contains(HEADER_CLASS) | after.contains(ROW_CLASS)
        | (page.contains("&") & page.rlike(_RARE_ENTITY)) | page.rlike(_BROKEN_TAG))
    plain = F.when(~F.col("_odd"), page)

    def places_of(title: str) -> Column:
        return F.array_compact(F.transform("_header", lambda t, i: F.when(t == title, i)))

    def value_of(name: str) -> Column:
        return F.get("_cells", F.array_max(F.filter(F.col(f"_places.{name}"), lambda i: i < F.size("_cells"))))

    rows = (
        pages.withColumn("_page", F.when(F.col("html").contains(CONTROL_CLASS), F.when(
            F.col("html").rlike(_MAY_BE_UNSEEN), visible(F.col("html"))).otherwise(F.col("html"))))
        .withColumn("_grids", grids)
        # NULL for a page without a grid, which then goes neither way. A filter here, or the one that Spark makes
        # from an explode that is not outer, would sink below the page and cut it again for each use of it.
        .withColumn("_odd", F.when(F.col("_grids") > 0, odd))
        .select("crawl_id", "page_no", _read_tables(F.when(F.col("_odd"), page)).alias("_read"), plain.alias("_page"))
        # A plain page is one grid from its first tag on.
        .withColumn("_grid", F.regexp_extract("_page", rf"{control}(.*)$", 2))
        .select(
            "crawl_id", "page_no",
            F.coalesce("_read.header", F.transform(F.regexp_extract_all("_grid", F.lit(header), 1), shown_text)).alias("_header"),
            F.coalesce("_read.rows", F.transform(
                F.regexp_extract_all("_grid", F.lit(row), 1),
                lambda body: F.transform(F.regexp_extract_all(body, F.lit(cell), 1), shown_text))).alias("_rows"),
        )
        .select("crawl_id", "page_no", F.struct(*(places_of(t).alias(n) for t, n in titles.items())).alias("_places"), "_rows")
        .select("crawl_id", "page_no", "_places", F.posexplode_outer("_rows").alias("row", "_cells"))
        .filter(F.col("row").isNotNull())
    )
    return rows.select(
        "crawl_id", "page_no", F.col("row").cast("bigint").alias("row"), *(value_of(name).alias(name) for name in titles.values()))


def list_links(pages: DataFrame) -> DataFrame:
    """Links that are list entries: ``position, href, text`` next to the columns of ``pages``."""
    link = r"""(?is)<li>\s*<a\s+href="([^"]*)"[^<>]*>(.*?)</a>"""
    others = [name for name in pages.columns if name != "html"]
    return (
        pages.withColumn("_page", visible(F.col("html")))
        .select(*others, F.posexplode(F.arrays_zip(
            F.regexp_extract_all("_page", F.lit(link), 1).alias("href"),
            F.regexp_extract_all("_page", F.lit(link), 2).alias("body"),
        )).alias("position", "_link"))
        .select(*others, F.col("position").cast("bigint").alias("position"), "_link.href",
                node_text(F.col("_link.body")).alias("text"))
    )
